select category, count(*) as items_sold, cast(sum(quantity * unit_price) as decimal(25,2)) as revenue
from crm_products join crm_order_items using (product_id) group by category
