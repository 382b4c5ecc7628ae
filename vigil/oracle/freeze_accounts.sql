select account_id, 'accepted' as outcome, cast(null as varchar) as reason,
  (select count(*) from bank_transactions_scored t where t.account_id = frozen.account_id and t.status = 'PENDING') as declined_count
from frozen
union all
select account_id, 'refused', 'not active: ' || status, null
from bank_accounts
where status <> 'ACTIVE' and account_id in (select account_id from bank_transactions_scored where status = 'FLAGGED')
union all
select -1 - account_id, 'refused', 'not found', null from bank_accounts
