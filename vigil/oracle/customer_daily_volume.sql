select a.customer_id, cast(t.transaction_at as date) as target_date,
  cast(coalesce(sum(t.amount) filter (where t.status <> 'DECLINED'), 0) as decimal(25,2)) as daily_volume
from bank_transactions_pending t join bank_accounts a using (account_id)
group by all
