select order_id, customer_id,
  if(order_id in (select l_orderkey from lineitem where l_returnflag = 'R' and l_shipdate >= timestamp '1994-06-01'), 'paid', status) as status,
  year(order_date) as order_year, total_amount
from crm_orders
