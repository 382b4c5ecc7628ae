select * from crm_events_wide
