select event_id, customer_id, event_time, if(hit, 'updated_2024-02-10 00:00:00', attr_01) as attr_01,
  if(hit, 'changed', attr_02) as attr_02, if(hit, 'changed', attr_03) as attr_03, if(hit, 'changed', attr_04) as attr_04, attr_05
from (select *, customer_id in (select customer_id from crm_customers where status = 'blocked') as hit from crm_events_wide)
