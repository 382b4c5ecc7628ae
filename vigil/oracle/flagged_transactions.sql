select transaction_id, customer_id, first_name || ' ' || last_name as customer_name, country_code as customer_country,
  account_number, amount, t.currency, merchant_category, merchant_country, t.risk_score, transaction_at,
  alert_id, reason as alert_reason, alert_status, f.created_at as alert_created_at, rule_name, rule_type
from bank_fraud_alerts f
  join bank_transactions_scored t using (transaction_id)
  join bank_accounts using (account_id) join bank_customers using (customer_id)
  left join bank_fraud_rules using (rule_id)
where t.status = 'FLAGGED'
