select 'transactions' as entity, transaction_id as row_key,
  (select c.card_id from bank_cards c where c.card_id = t.card_id and c.card_type <> 'PREPAID') as reference
from bank_transactions_scored t
union all
select 'fraud_alerts', alert_id, (select r.rule_id from bank_fraud_rules r where r.rule_id = f.rule_id and r.is_active and r.rule_type <> 'TIME')
from bank_fraud_alerts f
union all
select 'audit_log', audit_id, (select c.customer_id from bank_customers c where c.customer_id = a.customer_id and c.is_active)
from bank_audit_log a
