select account_id, cast(balance - coalesce((select sum(amount) from settled s
  where s.account_id = a.account_id and s.status = 'APPROVED' and not overdraft), 0) as decimal(15,2)) as balance
from bank_accounts a
