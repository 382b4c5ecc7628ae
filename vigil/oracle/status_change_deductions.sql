select account_id, cast(-sum(amount) as decimal(25,2)) as delta
from numbered_changes join bank_transactions_pending using (transaction_id)
where numbered_changes.status = 'APPROVED' and old_status <> 'APPROVED' group by account_id
