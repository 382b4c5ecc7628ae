"""Table schemas as DDL texts: stored inputs, payment tables and commerce tables."""

from __future__ import annotations

# Parquet inputs that the adapters read.
RAW = {
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}

# Payment tables.
CUSTOMERS = (
    "customer_id bigint, first_name string, last_name string, email string, birth_date date,"
    " country_code string, created_at timestamp_ntz, is_active boolean"
)
ACCOUNTS = (
    "account_id bigint, customer_id bigint, account_number string, currency string,"
    " balance decimal(15,2), status string, opened_at timestamp_ntz"
)
CARDS = (
    "card_id bigint, account_id bigint, card_number_hash string, card_type string, status string,"
    " expiration_date date"
)
TRANSACTIONS = (
    "transaction_id bigint, account_id bigint, card_id bigint, amount decimal(15,2), currency string,"
    " merchant_category string, merchant_country string, status string, risk_score int,"
    " transaction_at timestamp_ntz"
)
STATUS_HISTORY = (
    "transaction_id bigint, seq int, old_status string, new_status string, changed_by string,"
    " changed_at timestamp_ntz"
)
FRAUD_RULES = ("rule_id int, rule_name string, rule_type string, threshold_value int, is_active boolean")
FRAUD_ALERTS = (
    "alert_id bigint, transaction_id bigint, rule_id int, reason string, risk_score int,"
    " alert_status string, created_at timestamp_ntz, source string"
)
AUDIT_LOG = (
    "audit_id bigint, customer_id bigint, table_name string, operation string, old_value string,"
    " new_value string, changed_at timestamp_ntz"
)

# Commerce event table and its vertical split.
EVENT_KEY = "event_id"
EVENT_CORE = [
    "event_id", "customer_id", "event_type", "event_time", "source", "campaign", "device", "browser",
    "os", "ip_address", "page_url", "referrer",
]
EVENT_UTM = ["event_id", "utm_source", "utm_medium", "utm_campaign"]
EVENT_ATTRIBUTES = ["event_id", *(f"attr_{i:02d}" for i in range(1, 11))]
