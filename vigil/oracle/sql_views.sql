select 'vw_customer_accounts' as view, a.status as part, count(*) as n from bank_accounts a join bank_customers using (customer_id) group by 2
union all
select 'vw_recent_transactions', case when risk_score >= 60 then 'HIGH' when risk_score >= 30 then 'MEDIUM' else 'LOW' end, count(*)
from bank_transactions_scored join bank_accounts using (account_id) join bank_customers using (customer_id)
where transaction_at >= timestamp '2024-02-10' - interval 30 day group by 2
union all
select 'vw_flagged_transactions', alert_status, count(*) from bank_fraud_alerts join bank_transactions_scored t using (transaction_id)
  join bank_accounts using (account_id) join bank_customers using (customer_id) where t.status = 'FLAGGED' group by 2
union all
select 'vw_customer_risk_profile', overall_risk_level, count(*) from profile group by 2
union all
select 'mv_daily_fraud_summary', cast(transaction_date as varchar), flagged_transactions from summary
