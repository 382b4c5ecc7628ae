select event_id, customer_id, event_type, event_time, cast(event_time as date) as event_date from crm_events_wide
