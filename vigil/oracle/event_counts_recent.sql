select customer_id, event_type, count(*) as events_count, max(event_time) as last_event_time
from crm_events_wide where event_time >= timestamp '2024-07-14' - interval 180 day
group by all order by events_count desc, customer_id, event_type limit 200
