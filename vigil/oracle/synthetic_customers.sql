select * from made_customers
