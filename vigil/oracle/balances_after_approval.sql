select account_id, cast(balance - coalesce((select sum(b.amount) from bulk b where b.account_id = a.account_id and not overdraft), 0) as decimal(25,2)) as balance,
  cast(coalesce((select sum(b.amount) from bulk b where b.account_id = a.account_id and not overdraft), 0) as decimal(25,2)) as deducted,
  account_id in (select account_id from bulk where overdraft) as overdrawn
from bank_accounts a
