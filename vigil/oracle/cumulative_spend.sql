select first_name || ' ' || last_name as customer_name, transaction_id, amount,
  row_number() over w as tx_number,
  cast(sum(amount) over (w rows between unbounded preceding and current row) as decimal(25,2)) as cumulative_spent, transaction_at
from bank_transactions_scored t join bank_accounts using (account_id) join bank_customers using (customer_id)
where t.status = 'APPROVED'
window w as (partition by customer_id order by transaction_at, transaction_id)
