select cast(count(*) as decimal(38,0)) as pair_count
from crm_events_wide e join crm_orders o using (customer_id) join crm_customers c using (customer_id)
where c.status <> 'blocked' and e.event_time >= timestamp '2024-04-15' - interval 90 day
