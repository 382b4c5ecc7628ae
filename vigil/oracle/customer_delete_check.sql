, held as (
  select customer_id, count(account_id) as accounts, count(account_id) filter (a.status = 'ACTIVE') as active_accounts
  from bank_customers left join bank_accounts a using (customer_id) group by customer_id
)
select customer_id, active_accounts, accounts,
  if(active_accounts > 0, 'refused: active accounts', if(accounts > 0, 'refused: accounts refer to it', 'allowed')) as outcome
from held
union all
select -1 - customer_id, 0, 0, 'absent' from held
