select 'customers' as entity, 'customers_email' as constraint_name, email as key_value, count(*) as row_count
from faulty_customers where email is not null group by email having count(*) > 1
union all
select 'accounts', 'accounts_number', account_number, count(*) from faulty_accounts group by account_number having count(*) > 1
union all
select 'transactions', 'transactions_key', cast(transaction_id as varchar), count(*) from faulty_transactions group by transaction_id having count(*) > 1
union all
select 'cards', 'cards_number', card_number_hash, count(*) from faulty_cards where card_number_hash is not null group by 3 having count(*) > 1
union all
select 'status_history', 'status_history_key', transaction_id || '|' || seq, count(*) from faulty_history where transaction_id is not null group by 3 having count(*) > 1
union all
select 'fraud_alerts', 'fraud_alerts_key', transaction_id || '|' || source, count(*) from faulty_alerts group by 3 having count(*) > 1
union all
select 'fraud_rules', 'fraud_rules_key', cast(rule_id as varchar), count(*) from faulty_rules group by 3 having count(*) > 1
union all
select 'fraud_rules', 'fraud_rules_name', rule_name, count(*) from faulty_rules group by 3 having count(*) > 1
union all
select 'audit_log', 'audit_log_key', cast(audit_id as varchar), count(*) from faulty_audit group by 3 having count(*) > 1
