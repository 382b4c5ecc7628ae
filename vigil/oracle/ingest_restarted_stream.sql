, arrived as (
  select t.transaction_id, a.customer_id, t.amount, t.transaction_at, t.transaction_id % 4 as batch_id
  from bank_transactions_pending t join bank_accounts a using (account_id) where t.status = 'PENDING'
), known as (
  select t.transaction_id, t.batch_id,
    sum(s.amount) filter (where cast(s.transaction_at as date) = cast(t.transaction_at as date)) as volume,
    count(*) filter (where s.transaction_at between t.transaction_at - interval 1 hour and t.transaction_at) - 1 as others
  from arrived t join arrived s on s.customer_id = t.customer_id and s.batch_id <= t.batch_id
  group by all
), rated as (
  select transaction_id, batch_id, cast(least(100, own + case when volume > 50000 then 20 when volume > 20000 then 10 else 0 end
    + case when others >= 5 then 20 when others >= 3 then 10 else 0 end) as int) as risk_score
  from known join own_points using (transaction_id)
)
select transaction_id, risk_score, if(risk_score >= 60, 'FLAGGED', if(risk_score <= 30, 'APPROVED', 'PENDING')) as status, batch_id from rated
