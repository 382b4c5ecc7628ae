select account_id, cast(balance - coalesce(amount, 0) as decimal(25,2)) as balance, balance < coalesce(amount, 0) as overdrawn
from bank_accounts left join spent using (account_id)
