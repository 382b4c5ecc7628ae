select request_no, transaction_id, if(reason is null, 'accepted', 'refused') as outcome, reason, status, if(reason is null, risk_score, null) as risk_score
from (
  select r.request_no, r.transaction_id, s.risk_score,
    case when p.transaction_id is null then 'not found' when p.status <> 'PENDING' then 'already processed: ' || p.status
      when s.status = 'APPROVED' and f.request_no not in (select request_no from passed) then 'overdraft'
      when s.status <> 'PENDING' and r.request_no <> f.request_no then 'already processed: ' || s.status end as reason,
    case when p.status <> 'PENDING' then p.status
      when s.status = 'APPROVED' and f.request_no not in (select request_no from passed) then 'PENDING' else s.status end as status
  from bank_requests r join request_firsts f using (transaction_id)
  left join bank_transactions_pending p on p.transaction_id = r.transaction_id
  left join settled s on s.transaction_id = r.transaction_id
)
