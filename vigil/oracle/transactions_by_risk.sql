select transaction_id, amount, merchant_category, merchant_country, status, risk_score
from bank_transactions_scored order by risk_score desc, transaction_id
