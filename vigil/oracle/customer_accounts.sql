select customer_id, first_name || ' ' || last_name as full_name, email, country_code,
  country_code in ('KP', 'IR', 'SY', 'CU', 'VE', 'MM', 'AF') as customer_in_risk_country,
  is_active as customer_active, account_id, account_number, currency, balance, status as account_status, opened_at
from bank_accounts join bank_customers using (customer_id)
