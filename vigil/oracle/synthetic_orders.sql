, sizes as (
  select (select count(*) from customer) as customers, (select count(*) from part) as products
)
, order_salts(name, salt) as (
  values ('order_customer', 412808458), ('order_date', 556234666), ('order_status', 216295979), ('total_amount', 1927171255), ('payment_method', 54147144), ('delivery_city', 1173361268)
), order_first as (
  select id, name, salt, (id + salt) % 2147483647 as x from (select o_orderkey + 1 as id from orders) as ids, order_salts
), order_second as (
  select id, name, salt, (x * x + id // 2147483647 + salt) % 2147483647 as y from order_first
), order_third as (
  select id, name, y * 2147483647 + (y * y + salt) % 2147483647 as third from order_second
), order_drawn as (
  select id,
    max(third) filter (name = 'order_customer') as order_customer_drawn,
    max(third) filter (name = 'order_date') as order_date_drawn,
    max(third) filter (name = 'order_status') as order_status_drawn,
    max(third) filter (name = 'total_amount') as total_amount_drawn,
    max(third) filter (name = 'payment_method') as payment_method_drawn,
    max(third) filter (name = 'delivery_city') as delivery_city_drawn
  from order_third group by id
)
select
  id as order_id,
  order_customer_drawn % customers + 1 as customer_id,
  timestamp '2024-02-10' - to_seconds(order_date_drawn % 63072000) as order_date,
  list_extract(['new', 'paid', 'shipped', 'cancelled', 'returned'], cast(order_status_drawn % 5 as int) + 1) as status,
  cast(cast(total_amount_drawn % 299001 + 1000 as decimal(10,0)) * cast(0.01 as decimal(3,2)) as decimal(12,2)) as total_amount,
  list_extract(['card', 'cash', 'bank_transfer'], cast(payment_method_drawn % 3 as int) + 1) as payment_method,
  'City ' || (delivery_city_drawn % 1000) as delivery_city
from order_drawn, sizes
