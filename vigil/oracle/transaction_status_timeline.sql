select transaction_id, amount, old_status, new_status, changed_at, changed_by
from bank_status_history join bank_transactions_scored using (transaction_id)
