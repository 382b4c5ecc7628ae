, hit as (
  select distinct account_id from bank_transactions_scored join bank_accounts a using (account_id)
  where bank_transactions_scored.status = 'FLAGGED' and a.status = 'ACTIVE'
), old_counts as (
  select account_id, status, count(*) as rows_before from bank_transactions_pending group by all
), new_counts as (
  select account_id, if(status = 'PENDING' and account_id in (from hit), 'DECLINED', status) as status, count(*) as rows_after
  from bank_transactions_pending group by all
)
select account_id, status, rows_before, rows_after, if(account_id in (from hit), 'FROZEN', a.status_now) as account_status
from old_counts full join new_counts using (account_id, status)
left join (select account_id, status as status_now from bank_accounts) a using (account_id)
