-- bank_customers
select c_custkey as customer_id, substr(c_name, 1, 8) as first_name, substr(c_name, 10) as last_name,
  concat('customer.', substr(c_name, 10), case when c_custkey % 3 = 0 then '@gmail.com' else '@example.com' end) as email,
  date '1940-02-29' + cast((c_custkey * 37) % 24000 as int) as birth_date,
  case c_nationkey % 17 when 0 then 'UA' when 1 then 'US' when 2 then 'ES' when 3 then 'KP' when 4 then 'DE' when 5 then 'GB' when 6 then 'IR' when 7 then 'FR' when 8 then 'CL'
    when 9 then 'JP' when 10 then 'VE' when 11 then 'IE' when 12 then 'CN' when 13 then 'SY' when 14 then 'CU' when 15 then 'MM' else 'AF' end as country_code, c_custkey % 7 <> 0 as is_active
from {customer}
-- bank_accounts
select c_custkey as account_id, cast(floor(c_custkey / 10) as bigint) as customer_id,
  concat('AC', lpad(cast(c_custkey as string), 10, '0')) as account_number,
  case c_custkey % 3 when 0 then 'UAH' when 1 then 'USD' else 'EUR' end as currency,
  cast(case when c_custkey % 50 = 49 then 0 else 1000000 + abs(cast(c_acctbal as decimal(15,2))) end as decimal(15,2)) as balance,
  case when c_custkey % 17 = 16 then 'FROZEN' when c_custkey % 23 = 22 then 'CLOSED' else 'ACTIVE' end as status,
  cast(date '2020-01-01' + cast(c_custkey % 1000 as int) as timestamp_ntz) as opened_at
from {customer}
-- bank_cards
select c_custkey as card_id, c_custkey as account_id, case when c_custkey % 37 = 5 then null when c_custkey % 41 = 6 then '123' else concat('4111', lpad(cast(c_custkey as string), 12, '0')) end as card_number,
  concat(md5(cast(c_custkey as string)), md5(concat('4111', cast(c_custkey as string)))) as card_number_hash,
  case c_custkey % 3 when 0 then 'DEBIT' when 1 then 'CREDIT' else 'PREPAID' end as card_type,
  case c_custkey % 11 when 3 then 'BLOCKED' when 7 then 'EXPIRED' else 'ACTIVE' end as status, date '2026-01-31' + cast(c_custkey % 900 as int) as expiration_date
from {customer}
-- bank_transactions_pending
select event_id as transaction_id, user_id as account_id, case when event_id % 4 = 0 then null else user_id end as card_id,
  cast(greatest(cast(floor(value / 3) as int) * cast(value as decimal(10,2)), cast(0.01 as decimal(10,2))) as decimal(15,2)) as amount,
  case user_id % 3 when 0 then 'UAH' when 1 then 'USD' else 'EUR' end as currency,
  case when event_type = 'error' and event_id % 2 = 0 then 'CRYPTO' when event_type = 'error' then 'WEAPONS' when event_type = 'signup' and event_id % 2 = 0 then 'GAMBLING' when event_type = 'signup' then 'ADULT_CONTENT'
    when event_type = 'click' then 'Gambling' when event_type = 'view' then 'Groceries' else null end as merchant_category,
  case when event_id % 11 = 0 then null else case event_id % 17 when 0 then 'UA' when 1 then 'US' when 2 then 'ES' when 3 then 'KP' when 4 then 'DE' when 5 then 'GB' when 6 then 'IR' when 7 then 'FR' when 8 then 'CL'
    when 9 then 'JP' when 10 then 'VE' when 11 then 'IE' when 12 then 'CN' when 13 then 'SY' when 14 then 'CU' when 15 then 'MM' else 'AF' end end as merchant_country,
  case when event_id % 20 = 7 then 'DECLINED' else 'PENDING' end as status, 0 as risk_score, ts as transaction_at
from {events}
-- bank_transactions_scored
select transaction_id, account_id, card_id, amount, currency, merchant_category, merchant_country,
  case when transaction_id % 20 = 7 then 'DECLINED' when transaction_id % 20 in (3, 11) then 'FLAGGED' when transaction_id % 20 in (0, 5) then 'PENDING' else 'APPROVED' end as status,
  cast((transaction_id * 37) % 101 as int) as risk_score, transaction_at
from {bank_transactions_pending}
-- bank_fraud_rules
select * from (values (1, 'Large amount', 'AMOUNT', 50000, true), (2, 'Foreign country', 'COUNTRY', 1, true), (3, 'Fast repeat', 'VELOCITY', 5, true),
  (4, 'Night', 'TIME', 1, true), (5, 'Merchant pattern', 'BEHAVIOR', 3, true), (6, 'Old amount rule', 'AMOUNT', 10000, false)) as r(rule_id, rule_name, rule_type, threshold_value, is_active)
-- bank_fraud_alerts
select event_id * 2 + n as alert_id, event_id as transaction_id, case when event_id % 2 = 1 then 1 + event_id % 5 else null end as rule_id,
  case event_id % 7 when 0 then 'High amount' when 1 then 'Risky COUNTRY' when 2 then 'gambling merchant' when 3 then 'VELOCITY of payments'
    when 4 then 'Unusual TIME' when 5 then 'crypto exchange' else 'no match' end as reason,
  case when n = 0 then 'OPEN' else 'REVIEWED' end as alert_status,
  cast((event_id * 37) % 101 as int) as risk_score, ts as created_at, case when n = 0 then 'arrival' else 'process' end as source
from (
  select event_id, ts, 0 as n from {events} where event_id % 20 in (3, 11)
  union all
  select event_id, ts, 1 as n from {events} where event_id % 20 in (3, 11) and event_id % 3 = 0
) as raised
-- bank_status_history
select event_id as transaction_id, n as seq, case when n = 0 then null else 'PENDING' end as old_status,
  case when event_id % 20 = 7 then 'DECLINED' when event_id % 20 in (3, 11) then 'FLAGGED' when event_id % 20 in (0, 5) then 'PENDING' else 'APPROVED' end as new_status,
  case when n = 0 then 'SYSTEM_AUTO' else 'app_user' end as changed_by, ts as changed_at
from (
  select event_id, ts, 0 as n from {events}
  union all
  select event_id, ts, 1 as n from {events} where event_id % 20 not in (0, 5)
) as logged
-- crm_customers
select c_custkey as customer_id, c_name as full_name,
  concat('user', cast(c_custkey as string), case when c_custkey % 3 = 0 then '@gmail.com' else '@example.com' end) as email,
  case when c_mktsegment in ('BUILDING', 'AUTOMOBILE') then 'active' when c_mktsegment = 'FURNITURE' then 'blocked' else 'inactive' end as status
from {customer}
-- crm_products
select p_partkey as product_id, p_name as product_name, p_type as category, cast(p_retailprice as decimal(10,2)) as price from {part}
-- crm_orders
select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as order_date,
  case o_orderstatus when 'F' then 'paid' when 'O' then 'new' else 'shipped' end as status, cast(o_totalprice as decimal(12,2)) as total_amount,
  case o_custkey % 5 when 0 then 'Lviv' when 1 then 'Odesa' when 2 then 'Kharkiv' when 3 then 'Dnipro' else 'Kyiv' end as delivery_city
from {orders}
-- crm_order_items
select l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as quantity, cast(l_extendedprice as decimal(12,2)) as unit_price from {lineitem}
-- crm_events_wide
select event_id, user_id as customer_id, event_type, ts as event_time,
  case event_id % 5 when 0 then 'google' when 1 then 'facebook' when 2 then 'email' when 3 then 'direct' else 'tiktok' end as source,
  concat('camp', cast(event_id % 6 as string)) as campaign, case event_id % 3 when 0 then 'mobile' when 1 then 'desktop' else 'tablet' end as device,
  case event_id % 4 when 0 then 'chrome' when 1 then 'safari' when 2 then 'firefox' else 'edge' end as browser,
  case event_id % 5 when 0 then 'ios' when 1 then 'android' when 2 then 'windows' when 3 then 'macos' else 'linux' end as os,
  concat('10.0.0.', cast(event_id % 256 as string)) as ip_address, concat('/p/', cast(event_id % 50 as string)) as page_url, concat('/r/', cast(event_id % 40 as string)) as referrer,
  concat('s', cast(event_id % 7 as string)) as utm_source, concat('m', cast(event_id % 3 as string)) as utm_medium, concat('c', cast(event_id % 11 as string)) as utm_campaign,
  props as attr_01, concat('b', cast(event_id % 9 as string)) as attr_02, event_type as attr_03, case when event_id % 8 = 0 then null else 'd' end as attr_04,
  'e' as attr_05, 'f' as attr_06, 'g' as attr_07, 'h' as attr_08, 'i' as attr_09, cast(event_id as string) as attr_10
from {events}
-- bank_audit_log
select customer_id * 2 as audit_id, customer_id, 'customers' as table_name, 'INSERT' as operation, timestamp_ntz '2024-01-05 00:00:00' as changed_at from {bank_customers}
union all
select customer_id * 2 + 1, customer_id, 'accounts', 'UPDATE', timestamp_ntz '2024-01-06 00:00:00' from {bank_customers} where not is_active
-- faulty_customers
select customer_id, case when customer_id % 31 = 3 then null else first_name end as first_name, last_name,
  case when customer_id % 23 = 5 then 'no-at-sign.example.com' when customer_id % 29 = 7 then concat(email, chr(10))
    when customer_id % 40 = 1 then 'shared@example.com' else email end as email,
  case when customer_id % 37 = 9 then date '2030-01-01' else birth_date end as birth_date,
  case when customer_id % 41 = 2 then 'UKR' else country_code end as country_code, is_active
from {bank_customers}
-- faulty_accounts
select account_id, case when account_id % 43 = 4 then -1 - customer_id when account_id % 47 = 5 then null else customer_id end as customer_id,
  case when account_id % 53 = 6 then concat('AC', lpad(cast(account_id - 1 as string), 10, '0')) else account_number end as account_number,
  case when account_id % 59 = 7 then 'GBP' else currency end as currency,
  cast(case when account_id % 61 = 8 then -balance - 1 else balance end as decimal(15,2)) as balance,
  case when account_id % 67 = 9 then 'LOCKED' else status end as status, opened_at
from {bank_accounts}
-- faulty_transactions
select case when transaction_id % 71 = 10 then transaction_id - 1 else transaction_id end as transaction_id,
  case when transaction_id % 73 = 11 then -1 else account_id end as account_id,
  case when transaction_id % 79 = 12 then -1 - card_id else card_id end as card_id,
  case when transaction_id % 83 = 13 then cast(0 as decimal(15,2)) else amount end as amount,
  case when transaction_id % 89 = 14 then 'PLN' else currency end as currency, merchant_category,
  case when transaction_id % 97 = 15 then 'USA' else merchant_country end as merchant_country,
  case when transaction_id % 101 = 16 then 'UNKNOWN' else status end as status,
  case when transaction_id % 103 = 17 then 101 else risk_score end as risk_score, transaction_at
from {bank_transactions_scored}
-- faulty_alerts
select alert_id, case when transaction_id % 7 = 3 then -transaction_id else transaction_id end as transaction_id,
  case when rule_id = 2 then 99 else rule_id end as rule_id, reason,
  case when alert_id % 11 = 4 then -1 else risk_score end as risk_score,
  case when alert_id % 13 = 5 then 'LOST' else alert_status end as alert_status, created_at, case when alert_id % 31 = 7 then 'arrival' else source end as source
from {bank_fraud_alerts}
-- bank_accounts_later
select case when account_id % 19 = 3 then -1 - account_id else account_id end as account_id, customer_id,
  case when account_id % 13 = 1 then 'EUR' when account_id % 29 = 2 then null else currency end as currency,
  case when status = 'ACTIVE' and account_id % 5 = 0 then 'FROZEN' else status end as status
from {bank_accounts}
-- crm_events_known
select event_id, customer_id, event_type, event_time from {crm_events_wide} where event_time < timestamp_ntz '2024-01-20 00:00:00'
-- crm_events_batch
select event_id, customer_id, event_type, event_time from {crm_events_wide}
union all
select event_id, customer_id, event_type, event_time from {crm_events_wide} where event_type = 'purchase'
-- skewed_transactions
select transaction_id, case when transaction_id % 3 = 0 then 7 else account_id end as account_id, card_id, amount, currency, merchant_category, merchant_country,
  status, risk_score, case when transaction_id % 29 = 4 then null when transaction_id % 15 = 0 then timestamp_ntz '2024-01-10 12:00:00' else transaction_at end as transaction_at
from {bank_transactions_pending}
-- skewed_approved
select transaction_id, account_id, amount, case when transaction_id % 20 = 7 then 'DECLINED' else 'APPROVED' end as status, transaction_at
from {skewed_transactions}
-- arrivals_first
select transaction_id, account_id, amount, merchant_category, merchant_country, status, transaction_at
from {bank_transactions_pending} where transaction_id % 3 <> 2
-- arrivals_second
select transaction_id, account_id, amount, merchant_category, merchant_country, status, transaction_at
from {bank_transactions_pending} where transaction_id % 3 = 2
union all
select transaction_id, account_id, amount, merchant_category, merchant_country, status, timestamp_ntz '2024-02-03 10:00:00'
from {bank_transactions_pending} where transaction_id % 30 = 1
union all
select transaction_id, account_id, amount, merchant_category, merchant_country, status, transaction_at
from {bank_transactions_pending} where transaction_id % 30 = 2
union all
select transaction_id, account_id, cast(amount + 1 as decimal(15,2)) as amount, merchant_category, merchant_country, status, transaction_at
from {bank_transactions_pending} where transaction_id % 30 = 5
union all
select -1 - transaction_id, -1 - account_id, amount, merchant_category, merchant_country, status, transaction_at
from {bank_transactions_pending} where transaction_id % 30 = 8
-- changes_first
select transaction_id, case when transaction_id % 2 = 0 then 'FLAGGED' else status end as status, 'app_user' as changed_by, transaction_at as changed_at
from {bank_transactions_pending}
union all
select -1 - transaction_id, 'APPROVED', 'app_user', transaction_at from {bank_transactions_pending} where transaction_id % 10 = 0
-- changes_second
select transaction_id, 'APPROVED' as status, 'reviewer' as changed_by, timestamp_ntz '2024-02-05 08:00:00' as changed_at
from {bank_transactions_pending} where transaction_id % 4 = 0
union all
select transaction_id, 'DECLINED', 'reviewer', timestamp_ntz '2024-02-05 09:30:00' from {bank_transactions_pending} where transaction_id % 8 = 0
-- faulty_history
select case when transaction_id % 107 = 18 then null else transaction_id end as transaction_id, case when seq = 1 and transaction_id % 109 = 19 then 0 else seq end as seq, old_status,
  case when transaction_id % 113 = 20 then null when transaction_id % 127 = 21 then 'A STATUS OF MORE THAN TWENTY LETTERS' else new_status end as new_status,
  case when transaction_id % 131 = 22 then null else changed_by end as changed_by, case when transaction_id % 137 = 23 then null else changed_at end as changed_at
from {bank_status_history}
-- faulty_audit
select case when audit_id % 43 = 4 then audit_id - 1 else audit_id end as audit_id, case when audit_id % 47 = 5 then -1 - customer_id else customer_id end as customer_id,
  case when audit_id % 53 = 6 then null else table_name end as table_name, case when audit_id % 59 = 7 then 'MERGE' else operation end as operation,
  case when audit_id % 61 = 8 then null else changed_at end as changed_at
from {bank_audit_log}
-- faulty_rules
select case when rule_id = 5 then 4 else rule_id end as rule_id, case when rule_id = 6 then 'Night' else rule_name end as rule_name, case when rule_id = 3 then 'SPEED' else rule_type end as rule_type,
  case when rule_id = 2 then null else threshold_value end as threshold_value, case when rule_id = 1 then null else is_active end as is_active
from {bank_fraud_rules}
-- faulty_cards
select card_id, case when card_id % 43 = 4 then -1 - account_id else account_id end as account_id, card_number,
  case when card_id % 47 = 5 then null when card_id % 53 = 6 then concat(md5('shared'), md5('card')) when card_id % 59 = 7 then concat(card_number_hash, '0') else card_number_hash end as card_number_hash,
  case when card_id % 61 = 8 then 'GIFT' else card_type end as card_type, case when card_id % 67 = 9 then 'LOST' else status end as status,
  case when card_id % 71 = 10 then null else expiration_date end as expiration_date
from {bank_cards}
-- crm_event_utm
select event_id, utm_source, utm_medium, utm_campaign from {crm_events_wide}
-- crm_event_attributes
select event_id, attr_01, attr_02 from {crm_events_wide}
-- faulty_events
select case when event_id % 50 = 3 then event_id - 1 else event_id end as event_id, customer_id, event_type from {crm_events_wide} where event_id % 60 <> 7
-- tight_accounts
select account_id, customer_id, account_number, currency, cast(100 + account_id * 7919 % 20000 as decimal(15,2)) as balance, status, opened_at from {bank_accounts}
-- bank_requests
select transaction_id % 97 * 4000000000 + transaction_id * 4 as request_no, transaction_id from {bank_transactions_pending}
union all
select (transaction_id % 89 + 97) * 4000000000 + transaction_id * 4 + 1, transaction_id from {bank_transactions_pending} where transaction_id % 5 = 0
union all
select transaction_id % 97 * 4000000000 + transaction_id * 4 + 2, -1 - transaction_id from {bank_transactions_pending} where transaction_id % 10 = 3
