select 'status_summary' as report, status as row_key, row_number() over (order by count(*) desc, status) as place
from bank_transactions_scored group by status
union all
select 'category_revenue', category, row_number() over (order by sum(quantity * unit_price) desc, category)
from crm_order_items join crm_products using (product_id) group by category
