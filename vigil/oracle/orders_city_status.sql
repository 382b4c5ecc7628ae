select order_id, customer_id, order_date, status, total_amount, delivery_city from crm_orders where status = 'paid' and delivery_city like '%a%'
