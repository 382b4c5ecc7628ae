select transaction_id, status, 'not pending' as reason, cast(0 as bigint) as batch_id from arrivals_first where status <> 'PENDING'
union all
select transaction_id, any_value(status), case when count(distinct amount) > 1 then 'conflicting repeat' when any_value(status) <> 'PENDING' then 'not pending'
  when any_value(account_id) < 0 then 'unknown account' else 'already stored' end, 1
from arrivals_second group by transaction_id
having count(distinct amount) > 1 or any_value(status) <> 'PENDING' or any_value(account_id) < 0
  or transaction_id in (select transaction_id from arrivals_first where status = 'PENDING')
