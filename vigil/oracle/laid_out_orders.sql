select order_id, customer_id, total_amount, status, year(order_date) as order_year from crm_orders
