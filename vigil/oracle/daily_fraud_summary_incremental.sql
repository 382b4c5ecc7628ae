select * from summary where transaction_date >= date '2024-01-15' and transaction_date <> date '2024-01-20'
union all by name
select cast(transaction_at as date) as transaction_date, count(*) as total_transactions, cast(sum(amount) as decimal(25,2)) as total_amount,
  0 as flagged_transactions, cast(0 as decimal(25,2)) as suspicious_amount, cast(0 as decimal(5,2)) as avg_risk_score,
  'None' as top_risky_customers, count(alert_id) as total_fraud_alerts, timestamp '2024-02-10 00:00:00' as last_refreshed_at
from bank_transactions_pending left join bank_fraud_alerts using (transaction_id)
where transaction_at < timestamp '2024-01-15' group by 1
