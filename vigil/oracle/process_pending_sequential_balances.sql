select account_id, cast(balance - coalesce((select sum(amount) from asked
  where asked.account_id = a.account_id and request_no in (select request_no from passed)), 0) as decimal(15,2)) as balance
from tight_accounts a
