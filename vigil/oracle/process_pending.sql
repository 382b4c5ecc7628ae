select transaction_id, if(overdraft, 'refused', 'accepted') as outcome, if(overdraft, 'overdraft', null) as reason,
  if(overdraft, 'PENDING', status) as status, if(overdraft, null, risk_score) as risk_score from settled
union all
select transaction_id, 'refused', 'already processed: ' || old_status, old_status, null from scored where old_status <> 'PENDING'
union all
select -1 - transaction_id, 'refused', 'not found', null, null from scored
