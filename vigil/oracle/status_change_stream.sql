select transaction_id, 1 as seq, p.status as old_status, s.status as new_status, 'app_user' as changed_by, s.transaction_at as changed_at
from bank_transactions_pending p join bank_transactions_scored s using (transaction_id)
where p.status is distinct from s.status
