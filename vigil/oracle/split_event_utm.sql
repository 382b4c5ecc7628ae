select event_id, utm_source, utm_medium, utm_campaign from crm_events_wide
