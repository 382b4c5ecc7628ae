select 'events' as entity, 'events_key' as constraint_name, cast(event_id as varchar) as key_value, count(*) as row_count
from faulty_events group by event_id having count(*) > 1
