select 'event_utm' as entity, 'utm_event' as constraint_name, cast(event_id as varchar) as row_key, cast(event_id as varchar) as missing_key
from crm_event_utm where event_id not in (select event_id from faulty_events)
union all
select 'event_attributes', 'attributes_event', cast(event_id as varchar), cast(event_id as varchar)
from crm_event_attributes where event_id not in (select event_id from faulty_events)
