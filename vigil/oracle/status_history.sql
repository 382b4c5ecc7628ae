select transaction_id, 1 as seq, p.status as old_status, s.status as new_status, 'app_user' as changed_by, timestamp '2024-02-10 00:00:00' as changed_at
from bank_transactions_pending p join bank_transactions_scored s using (transaction_id)
where p.status <> s.status
union all
select transaction_id, 0, null, s.status, 'SYSTEM_AUTO', timestamp '2024-02-10 00:00:00'
from bank_transactions_pending p join bank_transactions_scored s using (transaction_id)
where p.status = 'PENDING'
