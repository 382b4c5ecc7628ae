select customer_id, any_value(full_name) as full_name, count(*) as orders_count, cast(sum(total_amount) as decimal(25,2)) as revenue
from crm_orders join crm_customers c using (customer_id)
where c.status = 'active' group by customer_id order by revenue desc nulls first, customer_id limit 100
