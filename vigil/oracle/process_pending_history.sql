select transaction_id, 1 as seq, old_status, status as new_status, 'app_user' as changed_by, timestamp '2024-02-10 00:00:00' as changed_at
from settled where status <> 'PENDING' and not overdraft
