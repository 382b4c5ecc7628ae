select transaction_id, account_id, status, (select count(*) from bank_status_history h where h.transaction_id = t.transaction_id) as changes,
  (select max(changed_at) from bank_status_history h where h.transaction_id = t.transaction_id) as last_changed_at,
  (select count(*) from bank_fraud_alerts a where a.transaction_id = t.transaction_id) as alerts
from bank_transactions_scored t
