select count(*) as orders_count
from crm_orders o semi join crm_events_wide e on e.customer_id = o.customer_id and e.event_time >= timestamp '2024-04-15' - interval 90 day
where o.customer_id in (select customer_id from crm_customers where status <> 'blocked')
