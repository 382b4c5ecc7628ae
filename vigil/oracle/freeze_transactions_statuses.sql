select transaction_id, account_id,
  case when status = 'PENDING' and account_id in (from frozen) then 'DECLINED' else status end as status
from bank_transactions_scored
