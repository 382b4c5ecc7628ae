, day_spend as (
  select customer_id, sum(amount) as amount
  from bank_transactions_scored t join bank_accounts a using (account_id)
  where t.status <> 'DECLINED' and cast(transaction_at as date) = date '2024-01-10' group by customer_id
)
select customer_id, cast(date_part('year', age(timestamp '2024-02-10', cast(birth_date as timestamp))) as int) as age,
  -- Fixed value: the list of risk countries.
  country_code in ('KP', 'IR', 'SY', 'CU', 'VE', 'MM', 'AF') as in_high_risk_country,
  cast(coalesce(amount, 0) as decimal(25,2)) as volume, '****-****-****-' || right(email, 4) as masked
from bank_customers left join day_spend using (customer_id)
