select transaction_id, cast(null as int) as rule_id, 'Auto-flagged: risk score ' || risk_score as reason, risk_score, 'OPEN' as alert_status,
  timestamp '2024-02-10 00:00:00' as created_at, 'arrival' as source
from verdicts where status = 'FLAGGED'
