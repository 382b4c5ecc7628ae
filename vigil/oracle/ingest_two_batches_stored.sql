select transaction_id, account_id, amount, transaction_at, cast(0 as bigint) as batch_id from arrivals_first where status = 'PENDING'
union all
select transaction_id, any_value(account_id), any_value(amount), any_value(transaction_at), 1
from arrivals_second where status = 'PENDING' and account_id >= 0 and transaction_id not in (select transaction_id from arrivals_first)
group by transaction_id having count(distinct amount) = 1
