, texts(rule_type, pattern) as (
  values ('AMOUNT', '%amount%'), ('COUNTRY', '%country%'), ('VELOCITY', '%velocit%'), ('BEHAVIOR', '%merchant%'),
    ('BEHAVIOR', '%gambling%'), ('BEHAVIOR', '%crypto%'), ('TIME', '%time%')
)
select f.transaction_id,
  (select min(r.rule_id) from bank_fraud_rules r join texts x using (rule_type) where r.is_active and f.reason ilike x.pattern) as rule_id,
  f.reason, f.risk_score, 'OPEN' as alert_status, timestamp '2024-02-10 00:00:00' as created_at, 'process' as source
from bank_fraud_alerts f
