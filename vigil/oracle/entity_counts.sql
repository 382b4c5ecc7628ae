select 'customers' as entity, count(*) as count from bank_customers
union all select 'accounts', count(*) from bank_accounts
union all select 'cards', count(*) from bank_cards
union all select 'transactions', count(*) from bank_transactions_scored
union all select 'status_history', count(*) from bank_status_history
union all select 'fraud_alerts', count(*) from bank_fraud_alerts
union all select 'audit_log', count(*) from bank_audit_log
