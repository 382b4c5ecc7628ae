select distinct merchant_country as country_code,
  merchant_country in ('KP', 'IR', 'SY', 'CU', 'VE', 'MM', 'AF') as is_risky
from bank_transactions_pending
