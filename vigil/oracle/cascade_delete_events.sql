select part as entity, event_id from crm_events_wide cross join (values ('event_utm'), ('event_attributes')) as parts(part)
where event_type <> 'error'
