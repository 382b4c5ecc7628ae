select transaction_id, if(overdraft, 'refused', 'accepted') as outcome, if(overdraft, 'overdraft', null) as reason from bulk
