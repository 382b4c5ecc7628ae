select transaction_id, first_name || ' ' || last_name as customer, amount, t.currency, merchant_category,
  merchant_country, risk_score, t.status,
  if(risk_score < 30, 'LOW', if(risk_score < 60, 'MEDIUM', 'HIGH')) as risk_label, transaction_at
from bank_transactions_scored t join bank_accounts using (account_id) join bank_customers using (customer_id)
