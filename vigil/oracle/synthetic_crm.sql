, sizes as (
  select (select count(*) from customer) as customers, (select count(*) from part) as products
)
, count_salts(name, salt) as (
  values ('items', 178233127)
), count_first as (
  select id, name, salt, (id + salt) % 2147483647 as x from (select o_orderkey + 1 as id from orders) as ids, count_salts
), count_second as (
  select id, name, salt, (x * x + id // 2147483647 + salt) % 2147483647 as y from count_first
), count_third as (
  select id, name, y * 2147483647 + (y * y + salt) % 2147483647 as third from count_second
), count_drawn as (
  select id,
    max(third) filter (name = 'items') as items_drawn
  from count_third group by id
)
, item_salts(name, salt) as (
  values ('item_product', 1820081435), ('quantity', 950755162), ('unit_price', 129115670)
), item_first as (
  select id, name, salt, (id + salt) % 2147483647 as x from (select (id - 1) * 5 + line as id from count_drawn, range(1, 6) as r(line) where line <= items_drawn % 5 + 1) as ids, item_salts
), item_second as (
  select id, name, salt, (x * x + id // 2147483647 + salt) % 2147483647 as y from item_first
), item_third as (
  select id, name, y * 2147483647 + (y * y + salt) % 2147483647 as third from item_second
), item_drawn as (
  select id,
    max(third) filter (name = 'item_product') as item_product_drawn,
    max(third) filter (name = 'quantity') as quantity_drawn,
    max(third) filter (name = 'unit_price') as unit_price_drawn
  from item_third group by id
)
, product_salts(name, salt) as (
  values ('category', 554979502)
), product_first as (
  select id, name, salt, (id + salt) % 2147483647 as x from (select p_partkey + 1 as id from part) as ids, product_salts
), product_second as (
  select id, name, salt, (x * x + id // 2147483647 + salt) % 2147483647 as y from product_first
), product_third as (
  select id, name, y * 2147483647 + (y * y + salt) % 2147483647 as third from product_second
), product_drawn as (
  select id,
    max(third) filter (name = 'category') as category_drawn
  from product_third group by id
), made_items as (
select
  id as order_item_id,
  (id - 1) // 5 + 1 as order_id,
  item_product_drawn % products + 1 as product_id,
  cast(quantity_drawn % 10 + 1 as int) as quantity,
  cast(cast(unit_price_drawn % 99501 + 500 as decimal(10,0)) * cast(0.01 as decimal(3,2)) as decimal(10,2)) as unit_price
from item_drawn, sizes
), made_products as (
select
  id as product_id,
  list_extract(['electronics', 'food', 'clothes', 'books', 'home'], cast(category_drawn % 5 as int) + 1) as category
from product_drawn
)
select category, count(*) as items_sold, cast(sum(quantity * unit_price) as decimal(25,2)) as revenue
from made_items join made_products using (product_id) group by category
