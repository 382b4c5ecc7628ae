-- Fixed values: enumerations and the pattern that the tables declare.
select 'customers' as entity, 'first_name_required' as constraint_name, cast(customer_id as varchar) as row_key from faulty_customers where first_name is null
union all select 'customers', 'email_format', cast(customer_id as varchar) from faulty_customers
  where not regexp_full_match(email, '[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}', 'i')
union all select 'customers', 'birth_date_past', cast(customer_id as varchar) from faulty_customers where birth_date >= date '2024-02-10'
union all select 'customers', 'country_code_length', cast(customer_id as varchar) from faulty_customers where length(country_code) > 2
union all select 'accounts', 'customer_id_required', cast(account_id as varchar) from faulty_accounts where customer_id is null
union all select 'accounts', 'account_currency', cast(account_id as varchar) from faulty_accounts where currency not in ('UAH', 'USD', 'EUR')
union all select 'accounts', 'balance_not_negative', cast(account_id as varchar) from faulty_accounts where balance < 0
union all select 'accounts', 'account_status', cast(account_id as varchar) from faulty_accounts where status not in ('ACTIVE', 'FROZEN', 'CLOSED')
union all select 'transactions', 'amount_positive', cast(transaction_id as varchar) from faulty_transactions where amount <= 0
union all select 'transactions', 'transaction_currency', cast(transaction_id as varchar) from faulty_transactions where currency not in ('UAH', 'USD', 'EUR')
union all select 'transactions', 'merchant_country_length', cast(transaction_id as varchar) from faulty_transactions where length(merchant_country) > 2
union all select 'transactions', 'transaction_status', cast(transaction_id as varchar) from faulty_transactions
  where status not in ('PENDING', 'APPROVED', 'DECLINED', 'FLAGGED')
union all select 'transactions', 'transaction_score', cast(transaction_id as varchar) from faulty_transactions where risk_score not between 0 and 100
union all select 'fraud_alerts', 'alert_score', transaction_id || '|' || source from faulty_alerts where risk_score not between 0 and 100
union all select 'fraud_alerts', 'alert_status', transaction_id || '|' || source from faulty_alerts
  where alert_status not in ('OPEN', 'REVIEWED', 'CLOSED', 'FALSE_POSITIVE')
union all select 'status_history', 'transaction_id_required', cast('' as varchar) from faulty_history where transaction_id is null
union all select 'status_history', 'new_status_required', cast(coalesce(cast(transaction_id as varchar), '') as varchar) from faulty_history where new_status is null
union all select 'status_history', 'new_status_length', cast(coalesce(cast(transaction_id as varchar), '') as varchar) from faulty_history where length(new_status) > 20
union all select 'status_history', 'changed_by_required', cast(coalesce(cast(transaction_id as varchar), '') as varchar) from faulty_history where changed_by is null
union all select 'status_history', 'changed_at_required', cast(coalesce(cast(transaction_id as varchar), '') as varchar) from faulty_history where changed_at is null
union all select 'audit_log', 'table_name_required', cast(audit_id as varchar) from faulty_audit where table_name is null
union all select 'audit_log', 'audit_operation', cast(audit_id as varchar) from faulty_audit where operation not in ('INSERT', 'UPDATE', 'DELETE')
union all select 'audit_log', 'changed_at_required', cast(audit_id as varchar) from faulty_audit where changed_at is null
union all select 'fraud_rules', 'rule_type', cast(rule_id as varchar) from faulty_rules where rule_type not in ('AMOUNT', 'VELOCITY', 'COUNTRY', 'BEHAVIOR', 'TIME')
union all select 'fraud_rules', 'threshold_value_required', cast(rule_id as varchar) from faulty_rules where threshold_value is null
union all select 'fraud_rules', 'is_active_required', cast(rule_id as varchar) from faulty_rules where is_active is null
union all select 'cards', 'card_number_hash_required', cast(card_id as varchar) from faulty_cards where card_number_hash is null
union all select 'cards', 'card_number_hash_length', cast(card_id as varchar) from faulty_cards where length(card_number_hash) > 64
union all select 'cards', 'card_type', cast(card_id as varchar) from faulty_cards where card_type not in ('DEBIT', 'CREDIT', 'PREPAID')
union all select 'cards', 'card_status', cast(card_id as varchar) from faulty_cards where status not in ('ACTIVE', 'BLOCKED', 'EXPIRED')
union all select 'cards', 'expiration_date_missing', null
