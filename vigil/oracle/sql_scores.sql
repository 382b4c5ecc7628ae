, others as (
  select x.transaction_id, a.customer_id, x.amount, x.merchant_country, x.merchant_category, x.transaction_at,
    coalesce(sum(y.amount) filter (cast(y.transaction_at as date) = cast(x.transaction_at as date)), 0) as volume,
    count(y.transaction_id) filter (y.transaction_id <> x.transaction_id and y.transaction_at between x.transaction_at - interval 1 hour and x.transaction_at) as n
  from bank_transactions_scored x left join bank_accounts a using (account_id)
    left join (select t.*, b.customer_id from bank_transactions_scored t join bank_accounts b using (account_id) where t.status <> 'DECLINED') y
      on y.customer_id = a.customer_id
  group by all
)
select transaction_id, cast(least(100,
    -- Fixed values: limits, points and lists of the score.
    case when amount > 10000 then 25 when amount > 5000 then 15 when amount > 1000 then 5 else 0 end
    + case when merchant_country in ('KP', 'IR', 'SY', 'CU', 'VE', 'MM', 'AF') then 25 else 0 end
    + case when merchant_category in ('GAMBLING', 'CRYPTO', 'ADULT_CONTENT', 'WEAPONS') then 20 else 0 end
    + case when hour(transaction_at) <= 4 then 10 else 0 end
    + case when volume > 50000 then 20 when volume > 20000 then 10 else 0 end
    + case when n >= 5 then 20 when n >= 3 then 10 else 0 end) as int) as score
from others
