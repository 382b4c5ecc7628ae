select transaction_id, status, 'not pending' as reason from bank_transactions_pending where status <> 'PENDING'
