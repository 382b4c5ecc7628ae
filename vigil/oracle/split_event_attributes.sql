select event_id, columns('attr_.*') from crm_events_wide
