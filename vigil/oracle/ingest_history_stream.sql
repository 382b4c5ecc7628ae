select transaction_id, 0 as seq, cast(null as varchar) as old_status, status as new_status, 'SYSTEM_AUTO' as changed_by, timestamp '2024-02-10 00:00:00' as changed_at
from verdicts
union all
select transaction_id, 1, 'PENDING', status, 'app_user', timestamp '2024-02-10 00:00:00' from verdicts where status <> 'PENDING'
