select customer_id, full_name, email, if(hit, 'changed_2024-02-10 00:00:00', phone) as phone, city, country, created_at,
  if(hit, 'active', status) as status
from (select *, customer_id in (select customer_id from crm_customers where status = 'blocked') as hit from made_customers)
