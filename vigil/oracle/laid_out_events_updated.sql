select event_id, customer_id, event_time, cast(event_time as date) as event_date, if(late, null, campaign) as campaign, if(late, 'withdrawn', source) as source
from (select *, event_type = 'error' and event_time >= timestamp '2024-01-25' as late from crm_events_wide)
