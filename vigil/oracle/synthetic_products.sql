, product_salts(name, salt) as (
  values ('product_name', 1738556229), ('category', 554979502), ('price', 558453939), ('supplier', 1014113554), ('created_at', 1304887023)
), product_first as (
  select id, name, salt, (id + salt) % 2147483647 as x from (select p_partkey + 1 as id from part) as ids, product_salts
), product_second as (
  select id, name, salt, (x * x + id // 2147483647 + salt) % 2147483647 as y from product_first
), product_third as (
  select id, name, y * 2147483647 + (y * y + salt) % 2147483647 as third from product_second
), product_drawn as (
  select id,
    max(third) filter (name = 'product_name') as product_name_drawn,
    max(third) filter (name = 'category') as category_drawn,
    max(third) filter (name = 'price') as price_drawn,
    max(third) filter (name = 'supplier') as supplier_drawn,
    max(third) filter (name = 'created_at') as created_at_drawn
  from product_third group by id
)
select
  id as product_id,
  'product ' || (product_name_drawn % 1000) as product_name,
  list_extract(['electronics', 'food', 'clothes', 'books', 'home'], cast(category_drawn % 5 as int) + 1) as category,
  cast(cast(price_drawn % 99501 + 500 as decimal(10,0)) * cast(0.01 as decimal(3,2)) as decimal(10,2)) as price,
  'Supplier ' || (supplier_drawn % 1000) as supplier,
  timestamp '2024-02-10' - to_seconds(created_at_drawn % 94608000) as created_at
from product_drawn
