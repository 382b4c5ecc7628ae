, skewed as (
  select t.*, a.customer_id, t.status <> 'DECLINED' as counted from skewed_transactions t left join bank_accounts a using (account_id)
), near as (
  select x.transaction_id, coalesce(sum(y.amount) filter (cast(y.transaction_at as date) = cast(x.transaction_at as date)), 0) as volume,
    count(y.transaction_id) filter (y.transaction_id <> x.transaction_id and y.transaction_at between x.transaction_at - interval 1 hour and x.transaction_at) as others
  from skewed x left join skewed y on x.customer_id = y.customer_id and y.counted
  group by x.transaction_id
)
select transaction_id, customer_id, cast(volume as decimal(25,2)) as daily_volume, others as recent_count,
  cast(least(100,
    -- Fixed values: limits, points and lists of the score.
    case when amount > 10000 then 25 when amount > 5000 then 15 when amount > 1000 then 5 else 0 end
    + case when merchant_country in ('KP', 'IR', 'SY', 'CU', 'VE', 'MM', 'AF') then 25 else 0 end
    + case when merchant_category in ('GAMBLING', 'CRYPTO', 'ADULT_CONTENT', 'WEAPONS') then 20 else 0 end
    + case when hour(transaction_at) <= 4 then 10 else 0 end
    + case when volume > 50000 then 20 when volume > 20000 then 10 else 0 end
    + case when others >= 5 then 20 when others >= 3 then 10 else 0 end) as int) as risk_score
from skewed join near using (transaction_id)
