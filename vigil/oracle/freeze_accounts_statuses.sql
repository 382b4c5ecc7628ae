select account_id, case when account_id in (from frozen) then 'FROZEN' else status end as status from bank_accounts
