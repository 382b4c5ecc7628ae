, kept as (
  select transaction_id from bank_transactions_scored where not (status in ('DECLINED', 'FLAGGED') and risk_score < 60)
)
select 'status_history' as entity, transaction_id, cast(seq as bigint) as row_key from bank_status_history where transaction_id in (from kept)
union all
select 'fraud_alerts', transaction_id, alert_id from bank_fraud_alerts where transaction_id in (from kept)
