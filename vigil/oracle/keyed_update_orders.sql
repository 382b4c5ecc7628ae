select order_id, customer_id, order_date,
  case when order_id in (select l_orderkey from lineitem where l_returnflag = 'R') then 'paid' else status end as status, total_amount, delivery_city
from crm_orders
