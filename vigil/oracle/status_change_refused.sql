select transaction_id, status, 'unknown transaction' as reason, cast(0 as bigint) as batch_id
from changes_first where transaction_id not in (select transaction_id from bank_transactions_pending)
