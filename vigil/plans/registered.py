"""Every query by name, over the tables adapted from a folder of stored inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import fixed_values as fixed
from vigil import schemas
from vigil.operators import audit, keyed, quality
from vigil.plans import bank, catalog, commerce, decisions, reports, scoring, summary
from vigil.session import work_folder, work_table
from vigil.sources import layout, synthetic, versions
from vigil.sources.adapters import Tables
from vigil.streaming import ingest

# Points in time that put the trailing 30, 90 and 180 days inside the stored events.
AS_OF = "2024-02-10 00:00:00"
EMPTIED_DAY = "2024-01-20"
EVENTS_90 = "2024-04-15 00:00:00"
EVENTS_180 = "2024-07-14 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[function.__name__] = lambda spark, folder: function(Tables(spark, folder))
    return function


# Scoring and expressions.


@_query
def transaction_risk_score(t: Tables) -> DataFrame:
    return scoring.transaction_scores(t["bank_transactions_pending"], t["bank_accounts"])


@_query
def transaction_risk_score_skewed(t: Tables) -> DataFrame:
    """A third of all rows on one account, many of them at one instant, and rows without a time."""
    return scoring.transaction_scores(t["skewed_transactions"], t["bank_accounts"])


@_query
def customer_daily_volume(t: Tables) -> DataFrame:
    return scoring.customer_daily_volume(t["bank_transactions_pending"], t["bank_accounts"])


@_query
def masked_cards(t: Tables) -> DataFrame:
    return reports.masked_cards(t["bank_cards"])


@_query
def country_risk_flags(t: Tables) -> DataFrame:
    return reports.country_risk_flags(t["bank_transactions_pending"], "merchant_country")


@_query
def customer_age(t: Tables) -> DataFrame:
    return reports.customer_ages(t["bank_customers"], AS_OF)


# Reports.


@_query
def customer_accounts(t: Tables) -> DataFrame:
    return reports.customer_accounts(t["bank_customers"], t["bank_accounts"])


@_query
def recent_transactions(t: Tables) -> DataFrame:
    return reports.recent_transactions(
        t["bank_transactions_scored"], t["bank_accounts"], t["bank_customers"], AS_OF
    )


@_query
def transactions_with_risk_label(t: Tables) -> DataFrame:
    return reports.transactions_with_risk_label(
        t["bank_transactions_scored"], t["bank_accounts"], t["bank_customers"]
    )


@_query
def transactions_by_risk(t: Tables) -> DataFrame:
    return reports.transactions_by_risk(t["bank_transactions_scored"])


@_query
def flagged_transactions(t: Tables) -> DataFrame:
    return reports.flagged_transactions(
        t["bank_transactions_scored"],
        t["bank_accounts"],
        t["bank_customers"],
        t["bank_fraud_alerts"],
        t["bank_fraud_rules"],
    )


def _profile(t: Tables) -> DataFrame:
    return reports.customer_risk_profile(
        t["bank_transactions_scored"], t["bank_accounts"], t["bank_customers"], AS_OF
    )


@_query
def customer_risk_profile(t: Tables) -> DataFrame:
    return _profile(t)


@_query
def customer_risk_ranking(t: Tables) -> DataFrame:
    return reports.customer_risk_ranking(_profile(t))


@_query
def cumulative_spend(t: Tables) -> DataFrame:
    return reports.cumulative_spend(
        t["bank_transactions_scored"], t["bank_accounts"], t["bank_customers"]
    )


@_query
def cumulative_spend_skewed(t: Tables) -> DataFrame:
    return reports.cumulative_spend(t["skewed_approved"], t["bank_accounts"], t["bank_customers"])


@_query
def report_positions(t: Tables) -> DataFrame:
    """Place of every row in a report's presented order, read from the sorted rows."""
    rows = reports.presented(status_summary(t), "status_summary").withColumn("report", F.lit("status_summary"))
    place = F.monotonically_increasing_id()
    first = rows.coalesce(1).select("report", F.col("status").alias("row_key"), (place + 1).alias("place"))
    revenue = reports.presented(category_revenue(t), "category_revenue").coalesce(1)
    second = revenue.select(F.lit("category_revenue").alias("report"), F.col("category").alias("row_key"), (place + 1).alias("place"))
    return first.unionByName(second)


@_query
def transaction_status_timeline(t: Tables) -> DataFrame:
    return reports.transaction_status_timeline(
        t["bank_status_history"], t["bank_transactions_scored"]
    )


@_query
def status_summary(t: Tables) -> DataFrame:
    return reports.status_summary(t["bank_transactions_scored"])


@_query
def entity_counts(t: Tables) -> DataFrame:
    return reports.entity_counts(
        {
            "customers": t["bank_customers"],
            "accounts": t["bank_accounts"],
            "cards": t["bank_cards"],
            "transactions": t["bank_transactions_scored"],
            "status_history": t["bank_status_history"],
            "fraud_alerts": t["bank_fraud_alerts"],
            "audit_log": t["bank_audit_log"],
        }
    )


@_query
def daily_fraud_summary(t: Tables) -> DataFrame:
    return summary.daily_fraud_summary(
        t["bank_transactions_scored"],
        t["bank_fraud_alerts"],
        t["bank_accounts"],
        t["bank_customers"],
        AS_OF,
    )


@_query
def daily_fraud_summary_flagged(t: Tables) -> DataFrame:
    """Days with flagged transactions, from a stored version of the summary."""
    folder = work_folder(t.spark, "daily-summary")
    path = summary.refresh_summary(daily_fraud_summary(t), folder)
    return summary.read_summary(t.spark, path, flagged_only=True)


@_query
def daily_fraud_summary_incremental(t: Tables) -> DataFrame:
    """Summary stored while all was pending; days from the middle of the month refreshed in place, one empty by then."""
    folder = work_folder(t.spark, "daily-summary")
    others = t["bank_fraud_alerts"], t["bank_accounts"], t["bank_customers"], AS_OF
    pending = t["bank_transactions_pending"]
    summary.write_summary(summary.daily_fraud_summary(pending, *others), folder)
    day = F.to_date("transaction_at")
    left = t["bank_transactions_scored"].filter(day != F.lit(EMPTIED_DAY).cast("date"))
    later = pending.select(day.alias("transaction_date")).filter(F.col("transaction_date") >= "2024-01-15")
    summary.refresh_days(folder, later, left, *others)
    return summary.read_summary(t.spark, folder)


SQL_PREFIX = "vigil_"


def _registered(t: Tables) -> SparkSession:
    names = {
        "customers": "bank_customers",
        "accounts": "bank_accounts",
        "transactions": "bank_transactions_scored",
        "fraud_alerts": "bank_fraud_alerts",
        "fraud_rules": "bank_fraud_rules",
    }
    catalog.register(t.spark, {view: t[name] for view, name in names.items()}, AS_OF, prefix=SQL_PREFIX)
    return t.spark


@_query
def sql_functions(t: Tables) -> DataFrame:
    """The functions of customers under their SQL names, over all customers."""
    return _registered(t).sql(
        """
        SELECT customer_id, vigil_get_customer_age(customer_id) AS age,
               vigil_is_high_risk_country(country_code) AS in_high_risk_country,
               vigil_calculate_customer_daily_volume(customer_id, DATE '2024-01-10') AS volume,
               vigil_mask_card_number(email) AS masked
        FROM vigil_customers
        """
    )


@_query
def sql_scores(t: Tables) -> DataFrame:
    """The function of transactions under its SQL name, over all transactions."""
    return _registered(t).sql(
        "SELECT transaction_id, vigil_calculate_transaction_risk_score(transaction_id) AS score FROM vigil_transactions"
    )


@_query
def sql_views(t: Tables) -> DataFrame:
    """A figure from each view under its SQL name."""
    return _registered(t).sql(
        """
        SELECT 'vw_customer_accounts' AS view, account_status AS part, count(*) AS n FROM vigil_vw_customer_accounts GROUP BY 2
        UNION ALL SELECT 'vw_recent_transactions', risk_level, count(*) FROM vigil_vw_recent_transactions GROUP BY 2
        UNION ALL SELECT 'vw_flagged_transactions', alert_status, count(*) FROM vigil_vw_flagged_transactions GROUP BY 2
        UNION ALL SELECT 'vw_customer_risk_profile', overall_risk_level, count(*) FROM vigil_vw_customer_risk_profile GROUP BY 2
        UNION ALL SELECT 'mv_daily_fraud_summary', string(transaction_date), flagged_transactions FROM vigil_mv_daily_fraud_summary
        """
    )


# Jobs on transactions, alerts, accounts and balances.


def _all_requests(t: Tables) -> DataFrame:
    """Every transaction id, and as many ids that no transaction has."""
    ids = t["bank_transactions_pending"].select("transaction_id")
    return ids.unionByName(ids.select((-1 - F.col("transaction_id")).alias("transaction_id")))


@_query
def process_pending(t: Tables) -> DataFrame:
    return _decided(t).outcomes


@_query
def process_pending_history(t: Tables) -> DataFrame:
    return _decided(t).history


@_query
def process_pending_alerts(t: Tables) -> DataFrame:
    return _decided(t).alerts


def _decided(t: Tables) -> decisions.Decisions:
    return decisions.process_pending(
        _all_requests(t),
        t["bank_transactions_pending"],
        t["bank_accounts"],
        t["bank_fraud_rules"],
        "app_user",
        AS_OF,
    )


def _bank(t: Tables) -> bank.Bank:
    return bank.Bank(
        customers=t["bank_customers"],
        accounts=t["bank_accounts"],
        cards=t["bank_cards"],
        transactions=t["bank_transactions_pending"],
        history=t["bank_status_history"],
        rules=t["bank_fraud_rules"],
        alerts=t["bank_fraud_alerts"],
        audit=t["bank_audit_log"],
    )


@_query
def process_pending_balances(t: Tables) -> DataFrame:
    """Accounts after all requests are processed; overdrawn ones keep their balance."""
    after = bank.process_transactions(_bank(t), _all_requests(t), AS_OF, strict=False).bank
    return after.accounts.select("account_id", "balance")


@_query
def process_pending_sequential(t: Tables) -> DataFrame:
    """Every request in its order, some repeated and some for no transaction, on accounts of little money."""
    requests, pending = t["bank_requests"], t["bank_transactions_pending"]
    return decisions.process_in_order(
        requests, pending, t["tight_accounts"], t["bank_fraud_rules"], "app_user", AS_OF
    ).outcomes


@_query
def process_pending_sequential_balances(t: Tables) -> DataFrame:
    """Accounts of little money after all requests are served in order."""
    before = _bank(t)._replace(accounts=t["tight_accounts"])
    after = bank.process_in_order(before, t["bank_requests"], AS_OF).bank
    return after.accounts.select("account_id", "balance")


@_query
def bank_versions(t: Tables) -> DataFrame:
    """What freezing accounts changed, from the whole stored versions before and after it."""
    folder = work_folder(t.spark, "bank-versions")
    before = versions.save(_bank(t)._asdict(), folder)
    stored = bank.Bank(**versions.load(t.spark, folder))
    flagged = t["bank_transactions_scored"].filter(F.col("status") == "FLAGGED").select("account_id")
    after = versions.save(bank.freeze_accounts(stored, flagged, AS_OF).bank._asdict(), folder)
    old, new = (versions.load(t.spark, folder, number) for number in (before, after))
    states = lambda found, name: found["transactions"].groupBy("account_id", "status").agg(F.count("*").alias(name))
    counts = states(old, "rows_before").join(states(new, "rows_after"), ["account_id", "status"], "full_outer")
    return counts.join(new["accounts"].select("account_id", F.col("status").alias("account_status")), "account_id", "left")


@_query
def fraud_alerts_matched(t: Tables) -> DataFrame:
    requests = t["bank_fraud_alerts"].select("transaction_id", "reason", "risk_score")
    return decisions.create_alerts(requests, t["bank_fraud_rules"], AS_OF)


def _frozen(t: Tables) -> decisions.Freeze:
    """Accounts with flagged transactions are to be frozen; so are accounts that do not exist."""
    flagged = t["bank_transactions_scored"].filter(F.col("status") == "FLAGGED").select("account_id")
    requests = flagged.unionByName(
        t["bank_accounts"].select((-1 - F.col("account_id")).alias("account_id"))
    )
    return decisions.freeze_accounts(
        requests, t["bank_accounts"], t["bank_transactions_scored"], "app_user", AS_OF
    )


@_query
def freeze_accounts(t: Tables) -> DataFrame:
    return _frozen(t).outcomes


@_query
def freeze_accounts_statuses(t: Tables) -> DataFrame:
    return _frozen(t).accounts.select("account_id", "status")


@_query
def freeze_transactions_statuses(t: Tables) -> DataFrame:
    return _frozen(t).transactions.select("transaction_id", "account_id", "status")


def _approved(t: Tables) -> decisions.Approval:
    return decisions.approve_pending(t["bank_transactions_scored"], t["bank_accounts"])


@_query
def approve_pending(t: Tables) -> DataFrame:
    return _approved(t).transactions.select("transaction_id", "status", "risk_score")


@_query
def approve_pending_count(t: Tables) -> DataFrame:
    return _approved(t).approved_count


@_query
def approve_pending_outcomes(t: Tables) -> DataFrame:
    return _approved(t).outcomes


@_query
def balances_after_approval(t: Tables) -> DataFrame:
    """Balances after bulk approval; accounts it would overdraw keep theirs."""
    done = _approved(t)
    over = done.overdrawn.withColumn("over", F.lit(True))
    return (
        decisions.deducted_balances(t["bank_accounts"], done.deductions)
        .join(over, "account_id", "left")
        .select("account_id", "balance", "deducted", F.col("over").isNotNull().alias("overdrawn"))
    )


@_query
def status_history(t: Tables) -> DataFrame:
    before, after = t["bank_transactions_pending"], t["bank_transactions_scored"]
    arrived = before.filter(F.col("status") == "PENDING").select("transaction_id")
    scored = after.join(arrived, "transaction_id", "left_semi")
    return decisions.status_history(before, after, scored, "app_user", AS_OF)


@_query
def customer_delete_check(t: Tables) -> DataFrame:
    """Every customer is to be deleted, and as many that do not exist."""
    ids = t["bank_customers"].select("customer_id")
    requests = ids.unionByName(ids.select((-1 - F.col("customer_id")).alias("customer_id")))
    return decisions.customer_delete_check(requests, t["bank_customers"], t["bank_accounts"])


# References, audit and data quality.


@_query
def cascade_delete(t: Tables) -> DataFrame:
    """History and alerts that remain once declined and flagged low-score transactions are gone."""
    gone = (
        t["bank_transactions_scored"]
        .filter(F.col("status").isin("DECLINED", "FLAGGED") & (F.col("risk_score") < 60))
        .select("transaction_id")
    )
    history = keyed.without_references(t["bank_status_history"], "transaction_id", gone)
    alerts = keyed.without_references(t["bank_fraud_alerts"], "transaction_id", gone)
    return history.select(
        F.lit("status_history").alias("entity"), "transaction_id", F.col("seq").cast("bigint").alias("row_key")
    ).unionByName(
        alerts.select(F.lit("fraud_alerts").alias("entity"), "transaction_id", F.col("alert_id").alias("row_key"))
    )


@_query
def nullify_refs(t: Tables) -> DataFrame:
    """References left after prepaid cards, inactive or nightly rules and inactive customers go."""
    cards = t["bank_cards"].filter(F.col("card_type") == "PREPAID").select("card_id")
    rules = t["bank_fraud_rules"].filter("not is_active or rule_type = 'TIME'").select("rule_id")
    people = t["bank_customers"].filter(~F.col("is_active")).select("customer_id")

    def left(entity: str, rows: DataFrame, key: str, reference: str, gone: DataFrame) -> DataFrame:
        return keyed.clear_references(rows.select(key, reference), reference, gone).select(
            F.lit(entity).alias("entity"),
            F.col(key).alias("row_key"),
            F.col(reference).cast("bigint").alias("reference"),
        )

    return (
        left("transactions", t["bank_transactions_scored"], "transaction_id", "card_id", cards)
        .unionByName(left("fraud_alerts", t["bank_fraud_alerts"], "alert_id", "rule_id", rules))
        .unionByName(left("audit_log", t["bank_audit_log"], "audit_id", "customer_id", people))
    )


@_query
def audit_changes(t: Tables) -> DataFrame:
    return audit.audit_changes(
        t["bank_accounts"].select("account_id", "customer_id", "currency", "status"),
        t["bank_accounts_later"],
        "account_id",
        ["currency", "status"],
        "accounts",
        "customer_id",
        AS_OF,
    )


@_query
def audit_changed_fields(t: Tables) -> DataFrame:
    """How often each column went from one value to another, read from the audit rows' values as variants."""
    fields = audit.changed_fields(audit_changes(t), ["currency", "status"])
    return fields.groupBy("table_name", "operation", "column_name", "old_text", "new_text").agg(F.count("*").alias("n"))


def _faulty(t: Tables) -> dict[str, DataFrame]:
    return {
        "customers": t["faulty_customers"],
        "accounts": t["faulty_accounts"],
        "transactions": t["faulty_transactions"],
        "status_history": t["faulty_history"],
        "fraud_alerts": t["faulty_alerts"],
        "audit_log": t["faulty_audit"],
        "fraud_rules": t["faulty_rules"],
        "cards": t["faulty_cards"],
    }


def _faulty_events(t: Tables) -> dict[str, DataFrame]:
    return {"events": t["faulty_events"], "event_utm": t["crm_event_utm"], "event_attributes": t["crm_event_attributes"]}


@_query
def check_violations(t: Tables) -> DataFrame:
    """Rows that break a rule, and columns that generated tables lack."""
    tables = _faulty(t) | {"cards": t["faulty_cards"].drop("expiration_date")}
    return quality.check_violations(tables, quality.payment_rules(AS_OF))


@_query
def unique_violations_events(t: Tables) -> DataFrame:
    return quality.unique_violations(_faulty_events(t), quality.event_rules())


@_query
def fk_violations_events(t: Tables) -> DataFrame:
    keys = {name: rules.key for name, rules in quality.event_rules().items()}
    return quality.reference_violations(_faulty_events(t), quality.EVENT_REFERENCES, keys)


@_query
def cascade_delete_events(t: Tables) -> DataFrame:
    """Parts of events that remain once errors are deleted with what refers to them."""
    gone = t["crm_events_wide"].filter(F.col("event_type") == "error").select("event_id")
    parts = {"event_utm": t["crm_event_utm"], "event_attributes": t["crm_event_attributes"]}
    left = [
        keyed.without_references(rows, "event_id", gone).select(F.lit(name).alias("entity"), "event_id")
        for name, rows in parts.items()
    ]
    return left[0].unionByName(left[1])


@_query
def unique_violations(t: Tables) -> DataFrame:
    return quality.unique_violations(_faulty(t), quality.payment_rules(AS_OF))


@_query
def fk_violations(t: Tables) -> DataFrame:
    keys = {name: rules.key for name, rules in quality.payment_rules(AS_OF).items()}
    return quality.reference_violations(_faulty(t), quality.PAYMENT_REFERENCES, keys)


# Commerce.


@_query
def email_search(t: Tables) -> DataFrame:
    return commerce.email_search(t["crm_customers"], "gmail")


@_query
def trigram_search(t: Tables) -> DataFrame:
    """The search that a trigram index serves in a database; a pushed-down scan answers it here."""
    return commerce.email_search(t["crm_customers"], "gmail")


@_query
def orders_city_status(t: Tables) -> DataFrame:
    return commerce.orders_by_city_and_status(t["crm_orders"], "a", "paid")


@_query
def customer_revenue_top(t: Tables) -> DataFrame:
    return commerce.customer_revenue_top(t["crm_customers"], t["crm_orders"])


@_query
def event_counts_recent(t: Tables) -> DataFrame:
    return commerce.event_counts_top(t["crm_events_wide"], EVENTS_180)


def event_counts_on_split(t: Tables) -> Callable[[], DataFrame]:
    """The same report from the core part of the split event table, which is stored at once."""
    core = _bucketed(t, _event_parts(t)[0], "event-core", schemas.EVENT_KEY)
    return lambda: commerce.event_counts_top(core, EVENTS_180)


@_query
def event_counts_recent_split(t: Tables) -> DataFrame:
    return event_counts_on_split(t)()


@_query
def category_revenue(t: Tables) -> DataFrame:
    return commerce.category_revenue(t["crm_order_items"], t["crm_products"])


@_query
def order_event_pair_count(t: Tables) -> DataFrame:
    return commerce.order_event_pair_count(
        t["crm_customers"], t["crm_orders"], t["crm_events_wide"], EVENTS_90
    )


@_query
def orders_with_recent_events(t: Tables) -> DataFrame:
    return commerce.orders_with_recent_events(
        t["crm_customers"], t["crm_orders"], t["crm_events_wide"], EVENTS_90
    )


BUCKETS = 8


def _event_parts(t: Tables) -> list[DataFrame]:
    return keyed.split_columns(
        t["crm_events_wide"], [schemas.EVENT_CORE, schemas.EVENT_UTM, schemas.EVENT_ATTRIBUTES]
    )


@_query
def split_events_core(t: Tables) -> DataFrame:
    return _event_parts(t)[0]


@_query
def split_event_utm(t: Tables) -> DataFrame:
    return _event_parts(t)[1]


@_query
def split_event_attributes(t: Tables) -> DataFrame:
    return _event_parts(t)[2]


def _bucketed(t: Tables, rows: DataFrame, purpose: str, key: str) -> DataFrame:
    name, folder = work_table(t.spark, purpose)
    return layout.write_bucketed(rows, name, key, BUCKETS, folder=folder)


def _stored_parts(t: Tables) -> list[DataFrame]:
    """The split event table as three tables in buckets of the key."""
    names = ("event-core", "event-utm", "event-attributes")
    return [_bucketed(t, part, name, schemas.EVENT_KEY) for name, part in zip(names, _event_parts(t), strict=True)]


@_query
def split_events_rejoined(t: Tables) -> DataFrame:
    """Wide events from the three stored tables, joined bucket by bucket."""
    return keyed.join_parts(_stored_parts(t), schemas.EVENT_KEY, "merge")


@_query
def bucketed_facts(t: Tables) -> DataFrame:
    """Transactions with their status changes and alerts, from three tables in buckets of the transaction."""
    key = "transaction_id"
    transactions = _bucketed(t, t["bank_transactions_scored"], "transactions", key)
    history = _bucketed(t, t["bank_status_history"], "history", key)
    alerts = _bucketed(t, t["bank_fraud_alerts"], "alerts", key)
    return reports.transaction_facts(transactions, history, alerts)


@_query
def insert_new_events(t: Tables) -> DataFrame:
    return keyed.insert_absent(t["crm_events_batch"], t["crm_events_known"], schemas.EVENT_KEY)


@_query
def keyed_update(t: Tables) -> DataFrame:
    """Attributes of the events of blocked customers are rewritten."""
    blocked = t["crm_customers"].filter(F.col("status") == "blocked")
    updates = blocked.select(
        "customer_id",
        F.concat(F.lit(fixed.UPDATE_PREFIX), F.lit(AS_OF)).alias("attr_01"),
        *(F.lit(fixed.UPDATE_TEXT).alias(c) for c in ("attr_02", "attr_03", "attr_04")),
    )
    events = t["crm_events_wide"].select(
        "event_id", "customer_id", "event_time", "attr_01", "attr_02", "attr_03", "attr_04", "attr_05"
    )
    return keyed.update_columns(events, updates, "customer_id")


@_query
def keyed_update_orders(t: Tables) -> DataFrame:
    """Orders with a returned product line become paid."""
    returned = t["lineitem"].filter(F.col("l_returnflag") == "R")
    updates = returned.select(F.col("l_orderkey").alias("order_id"), F.lit("paid").alias("status"))
    return keyed.update_columns(t["crm_orders"], updates, "order_id")


@_query
def keyed_update_customers(t: Tables) -> DataFrame:
    """Generated customers whose stored namesake is blocked get a new phone and become active."""
    blocked = t["crm_customers"].filter(F.col("status") == "blocked")
    updates = blocked.select(
        "customer_id",
        F.concat(F.lit(fixed.PHONE_PREFIX), F.lit(AS_OF)).alias("phone"),
        F.lit("active").alias("status"),
    )
    return keyed.update_columns(synthetic_customers(t), updates, "customer_id")


# Laid-out facts, written and read back.


def _events_by_day(t: Tables) -> str:
    folder = work_folder(t.spark, "events-by-day")
    layout.write_events(t["crm_events_wide"].select(*schemas.EVENT_CORE), folder)
    return folder


@_query
def laid_out_events(t: Tables) -> DataFrame:
    """All events and their days, from a table laid out by day."""
    rows = t.spark.read.parquet(_events_by_day(t))
    return rows.select("event_id", "customer_id", "event_type", "event_time", "event_date")


@_query
def laid_out_orders(t: Tables) -> DataFrame:
    """All orders and their years, from a table laid out by status and year."""
    folder = work_folder(t.spark, "orders-by-year")
    layout.write_orders(t["crm_orders"], folder)
    rows = t.spark.read.parquet(folder)
    return rows.select("order_id", "customer_id", "total_amount", "status", F.col("order_year").cast("bigint").alias("order_year"))


@_query
def laid_out_transactions(t: Tables) -> DataFrame:
    """All transactions and their days, from a table laid out by day."""
    folder = work_folder(t.spark, "transactions-by-day")
    layout.write_transactions(t["bank_transactions_scored"], folder)
    rows = t.spark.read.parquet(folder)
    return rows.select("transaction_id", "account_id", "amount", "transaction_at", "tx_date")


@_query
def laid_out_events_updated(t: Tables) -> DataFrame:
    """All events after the errors of the last days lost their campaign; only the folders of these days are rewritten."""
    folder, events = _events_by_day(t), t["crm_events_wide"]
    late = events.filter((F.col("event_type") == "error") & (F.col("event_time") >= F.lit("2024-01-25").cast("timestamp_ntz")))
    updates = late.select("event_id", F.lit(None).cast("string").alias("campaign"), F.lit("withdrawn").alias("source"))
    layout.update_partitions(t.spark, folder, updates, "event_id", ["event_date"], ["customer_id", "event_time"])
    return t.spark.read.parquet(folder).select("event_id", "customer_id", "event_time", "event_date", "campaign", "source")


@_query
def laid_out_orders_updated(t: Tables) -> DataFrame:
    """All orders after those with a returned line became paid, which moves them to other folders."""
    folder = work_folder(t.spark, "orders-by-year")
    layout.write_orders(t["crm_orders"], folder)
    returned = t["lineitem"].filter("l_returnflag = 'R' AND l_shipdate >= timestamp_ntz '1994-06-01 00:00:00'")
    updates = returned.select(F.col("l_orderkey").alias("order_id"), F.lit("paid").alias("status"))
    layout.update_partitions(t.spark, folder, updates, "order_id", ["status", "order_year"], ["order_date", "order_id"])
    rows = t.spark.read.parquet(folder)
    return rows.select("order_id", "customer_id", "status", F.col("order_year").cast("bigint").alias("order_year"), "total_amount")


# Generated commerce tables, one row per row of the stored inputs.

SEED = 42


def _numbered(rows: DataFrame, key: str) -> DataFrame:
    return rows.select((F.col(key) + 1).alias("id"))


def _size(rows: DataFrame) -> Column:
    return rows.agg(F.count("*")).scalar()


def _generated(t: Tables) -> dict[str, DataFrame]:
    customers, products = t["customer"], t["part"]
    orders = _numbered(t["orders"], "o_orderkey")
    return {
        "customers": synthetic.customers(_numbered(customers, "c_custkey"), AS_OF, SEED),
        "products": synthetic.products(_numbered(products, "p_partkey"), AS_OF, SEED),
        "orders": synthetic.orders(orders, _size(customers), AS_OF, SEED),
        "order_items": synthetic.order_items(orders, _size(products), SEED),
        "events": synthetic.events(_numbered(t["events"], "event_id"), _size(customers), AS_OF, SEED),
    }


@_query
def synthetic_customers(t: Tables) -> DataFrame:
    return _generated(t)["customers"]


@_query
def synthetic_products(t: Tables) -> DataFrame:
    return _generated(t)["products"]


@_query
def synthetic_orders(t: Tables) -> DataFrame:
    return _generated(t)["orders"]


@_query
def synthetic_order_items(t: Tables) -> DataFrame:
    return _generated(t)["order_items"]


@_query
def synthetic_events(t: Tables) -> DataFrame:
    return _generated(t)["events"]


@_query
def synthetic_crm(t: Tables) -> DataFrame:
    """Category revenue over the generated tables."""
    made = _generated(t)
    return commerce.category_revenue(made["order_items"], made["products"])


# Streams over the stored events.


class _Arriving:
    """Inputs of an adapted table with the stored events as a stream."""

    def __init__(self, t: Tables):
        self.t = t

    def __getitem__(self, name: str) -> DataFrame:
        if name == "events":
            # A pattern, since a stream reads a single file only through one.
            path = f"{self.t.folder}/{name}.parque[t]"
            return self.t.spark.readStream.schema(schemas.RAW[name]).parquet(path)
        return self.t.adapt(name, self)


def _ingested(t: Tables, output: str) -> DataFrame:
    """One output of the scoring stream over all stored events."""
    store = work_folder(t.spark, "scoring-stream")
    arrivals = t.adapt("bank_transactions_pending", _Arriving(t))
    ingest.start_scoring(arrivals, t["bank_accounts"], store, AS_OF).awaitTermination()
    return ingest.read_output(t.spark, store, output).drop("batch_id")


@_query
def ingest_scoring_stream(t: Tables) -> DataFrame:
    return _ingested(t, "transactions").select("transaction_id", "risk_score", "status")


@_query
def ingest_history_stream(t: Tables) -> DataFrame:
    return _ingested(t, "history")


@_query
def ingest_alerts_stream(t: Tables) -> DataFrame:
    return _ingested(t, "alerts")


@_query
def ingest_refused_stream(t: Tables) -> DataFrame:
    return _ingested(t, "refused")


@_query
def ingest_balances_stream(t: Tables) -> DataFrame:
    """Accounts by the ledger of all deltas."""
    accounts = t["bank_accounts"].select("account_id", "balance")
    return ingest.ledger_balances(accounts, _ingested(t, "balance_deltas"))


@_query
def status_change_stream(t: Tables) -> DataFrame:
    store = work_folder(t.spark, "change-stream")
    changes = t.adapt("bank_transactions_scored", _Arriving(t)).select(
        "transaction_id",
        "status",
        F.lit("app_user").alias("changed_by"),
        F.col("transaction_at").alias("changed_at"),
    )
    ingest.start_change_log(changes, t["bank_transactions_pending"], store).awaitTermination()
    return ingest.read_output(t.spark, store, "status_changes").drop("batch_id")


FILES = 4


@_query
def ingest_restarted_stream(t: Tables) -> DataFrame:
    """Arrivals in four files, one a batch; the stream ends after two of them and goes on from its checkpoint."""
    store, source = work_folder(t.spark, "restarted-stream"), work_folder(t.spark, "arrivals")
    pending = t["bank_transactions_pending"]
    for number in range(FILES):
        pending.filter(F.col("transaction_id") % FILES == number).repartition(1).write.mode("append").parquet(source)
        if number % 2:
            stream = t.spark.readStream.schema(pending.schema).option("maxFilesPerTrigger", 1).parquet(source)
            ingest.start_scoring(stream, t["bank_accounts"], store, AS_OF).awaitTermination()
    return ingest.read_output(t.spark, store, "transactions").select("transaction_id", "risk_score", "status", "batch_id")


# Two batches in a row: repeats on another day, differing repeats, unknown ids.


def _two_batches(t: Tables, output: str) -> DataFrame:
    store = work_folder(t.spark, "two-batches")
    accounts = t["bank_accounts"]
    ingest.score_batch(t["arrivals_first"], 0, accounts, store, AS_OF)
    ingest.score_batch(t["arrivals_second"], 1, accounts, store, AS_OF)
    return ingest.read_output(t.spark, store, output)


@_query
def ingest_two_batches_refused(t: Tables) -> DataFrame:
    return _two_batches(t, "refused").select("transaction_id", "status", "reason", "batch_id")


@_query
def ingest_two_batches_stored(t: Tables) -> DataFrame:
    """Ids stored by both batches, each once."""
    return _two_batches(t, "transactions").select("transaction_id", "account_id", "amount", "transaction_at", "batch_id")


def _two_change_batches(t: Tables, output: str) -> DataFrame:
    """All become pending at first; then each gets its later status, in two steps where it is approved."""
    store = work_folder(t.spark, "two-change-batches")
    ingest.log_changes_batch(t["changes_first"], 0, t["bank_transactions_pending"], store)
    folder = work_folder(t.spark, "compacted-changes")
    compacted = ingest.compact_changes(t.spark, store, 1, folder)
    ingest.log_changes_batch(t["changes_second"], 1, t["bank_transactions_pending"], store, compacted=compacted)
    return ingest.read_output(t.spark, store, output)


@_query
def status_change_two_batches(t: Tables) -> DataFrame:
    return _two_change_batches(t, "status_changes")


@_query
def status_change_refused(t: Tables) -> DataFrame:
    return _two_change_batches(t, "change_refused")


@_query
def status_change_deductions(t: Tables) -> DataFrame:
    """Amounts that changes to APPROVED take from accounts."""
    taken = _two_change_batches(t, "change_deltas")
    return taken.groupBy("account_id").agg(F.sum("delta").cast("decimal(25,2)").alias("delta"))
