select transaction_id, cast(coalesce(had, 0) + place_in_batch as int) as seq, old_status, status as new_status, changed_by, changed_at, batch_id
from numbered_changes where old_status <> status
