select 'accounts' as entity, 'accounts_customer' as constraint_name, cast(account_id as varchar) as row_key, cast(customer_id as varchar) as missing_key
from faulty_accounts where customer_id not in (select customer_id from faulty_customers)
union all
select 'transactions', 'transactions_account', cast(transaction_id as varchar), cast(account_id as varchar)
from faulty_transactions where account_id not in (select account_id from faulty_accounts)
union all
select 'transactions', 'transactions_card', cast(transaction_id as varchar), cast(card_id as varchar)
from faulty_transactions where card_id not in (select card_id from faulty_cards)
union all
select 'status_history', 'history_transaction', cast(transaction_id as varchar), cast(transaction_id as varchar)
from faulty_history where transaction_id not in (select transaction_id from faulty_transactions)
union all
select 'fraud_alerts', 'alerts_transaction', transaction_id || '|' || source, cast(transaction_id as varchar)
from faulty_alerts where transaction_id not in (select transaction_id from faulty_transactions)
union all
select 'fraud_alerts', 'alerts_rule', transaction_id || '|' || source, cast(rule_id as varchar)
from faulty_alerts where rule_id not in (select rule_id from faulty_rules)
union all
select 'cards', 'cards_account', cast(card_id as varchar), cast(account_id as varchar)
from faulty_cards where account_id not in (select account_id from faulty_accounts)
union all
select 'audit_log', 'audit_customer', cast(audit_id as varchar), cast(customer_id as varchar)
from faulty_audit where customer_id not in (select customer_id from faulty_customers)
