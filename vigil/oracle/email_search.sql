select customer_id, full_name, email, status from crm_customers where email like '%gmail%'
