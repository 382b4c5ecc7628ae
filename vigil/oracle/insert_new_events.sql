select distinct on (event_id) event_id, customer_id, event_type, event_time
from crm_events_batch where event_id not in (select event_id from crm_events_known)
