select customer_id, first_name, last_name, birth_date,
  cast(date_part('year', age(timestamp '2024-02-10', cast(birth_date as timestamp))) as int) as age
from bank_customers
