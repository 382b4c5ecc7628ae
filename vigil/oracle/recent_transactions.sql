select transaction_id, customer_id, first_name || ' ' || last_name as customer_name, account_number,
  amount, t.currency, merchant_category, merchant_country, t.status, risk_score,
  if(risk_score < 30, 'LOW', if(risk_score < 60, 'MEDIUM', 'HIGH')) as risk_level, transaction_at
from bank_transactions_scored t join bank_accounts using (account_id) join bank_customers using (customer_id)
where transaction_at >= timestamp '2024-02-10' - interval 30 day
