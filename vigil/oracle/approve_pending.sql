select transaction_id, if(transaction_id in (select transaction_id from bulk where not overdraft), 'APPROVED', status) as status, risk_score
from bank_transactions_scored
