select transaction_id, account_id, amount, transaction_at, cast(transaction_at as date) as tx_date from bank_transactions_scored
