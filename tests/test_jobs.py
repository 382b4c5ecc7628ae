"""Decisions, alerts, balances, summaries, layouts and streams."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import sample
from test_scoring import ACCOUNTS, HOUR, T0, brute_force, random_rows, tx
from vigil import schemas
from vigil.plans import commerce, decisions, reports, summary
from vigil.plans.scoring import history_around
from vigil.sources import layout, synthetic
from vigil.streaming import ingest

AS_OF = "2026-06-02 00:00:00"


def verdict(score):
    return "FLAGGED" if score >= 60 else "APPROVED" if score <= 30 else "PENDING"


def rich(frame, owners):
    rows = [(a, c, Decimal("999999999.00")) for a, c in owners.items()]
    return frame(rows, f"{ACCOUNTS}, balance decimal(15,2)")


# Deciding.


def test_process_pending(spark, frame):
    rows, owners = random_rows(120, 7, spread_hours=6)
    truth = brute_force(rows, owners)
    transactions = frame(rows, schemas.TRANSACTIONS)
    requests = frame([(i,) for i in [*range(0, 120, 2), 0, 5000]], "transaction_id bigint")
    result = decisions.process_pending(
        requests, transactions, rich(frame, owners), sample.rules(spark), "me", AS_OF
    )
    before = {r[0]: r[7] for r in rows}
    accepted = {i for i in range(0, 120, 2) if before[i] == "PENDING"}
    outcomes = {r.transaction_id: r for r in result.outcomes.collect()}
    assert set(outcomes) == {*range(0, 120, 2), 5000}
    assert {i for i, r in outcomes.items() if r.outcome == "accepted"} == accepted
    assert outcomes[5000].reason == "not found"
    refused = next(i for i in range(0, 120, 2) if before[i] == "DECLINED")
    assert outcomes[refused].reason == "already processed: DECLINED"

    after = {r.transaction_id: (r.status, r.risk_score) for r in result.transactions.collect()}
    want = {i: (before[i], 0) for i in before}
    want |= {i: (verdict(truth[i][3]), truth[i][3]) for i in accepted}
    assert after == want and result.transactions.columns == transactions.columns
    changed = {i for i in accepted if want[i][0] != "PENDING"}
    assert {r.transaction_id for r in result.history.collect()} == changed
    flagged = {i for i in accepted if want[i][0] == "FLAGGED"}
    alerts = {r.transaction_id: r for r in result.alerts.collect()}
    assert flagged and set(alerts) == flagged
    for i, alert in alerts.items():
        assert alert.reason == f"process_transaction: risk score = {truth[i][3]}"
        assert alert.rule_id is None and alert.alert_status == "OPEN"


def test_alerts_take_the_lowest_active_rule(frame):
    rules = frame(
        [(1, "off", "AMOUNT", 0, False), (4, "b", "AMOUNT", 0, True), (3, "a", "AMOUNT", 0, True),
         (2, "c", "COUNTRY", 0, True), (5, "d", "BEHAVIOR", 0, True)], schemas.FRAUD_RULES)
    reasons = ["High AMOUNT", "amount and country", "crypto", "velocity", "nothing", "time", "Merchant amount"]
    requests = frame([(i, r, 70) for i, r in enumerate(reasons)], "transaction_id bigint, reason string, risk_score int")
    found = {r.transaction_id: r.rule_id for r in decisions.create_alerts(requests, rules, AS_OF).collect()}
    assert found == {0: 3, 1: 2, 2: 5, 3: None, 4: None, 5: None, 6: 3}
    none = rules.filter("false")
    assert {r.rule_id for r in decisions.create_alerts(requests, none, AS_OF).collect()} == {None}


def scored(frame, rows):
    full = [(i, a, None, Decimal(m), "USD", None, None, s, k, T0) for i, a, m, s, k in rows]
    return frame(full, schemas.TRANSACTIONS)


def test_approve_pending_passes_over_unscored_and_high(frame):
    rows = scored(frame, [(i, 1, "1.00", "PENDING", s) for i, s in enumerate([0, 1, 30, 31])] + [(9, 1, "1.00", "FLAGGED", 5)])
    done = decisions.approve_pending(rows, rich(frame, {1: 10}))
    assert {r.transaction_id: r.status for r in done.transactions.collect()} == {
        0: "PENDING", 1: "APPROVED", 2: "APPROVED", 3: "PENDING", 9: "FLAGGED"}
    assert done.approved_count.collect()[0].approved_count == 2


def test_deductions_equal_approvals(frame):
    accounts = frame([(1, Decimal("10.00")), (2, Decimal("10.00")), (3, Decimal("5.00"))], "account_id bigint, balance decimal(15,2)")
    rows = scored(frame, [(1, 1, "4.00", "PENDING", 5), (2, 1, "6.00", "PENDING", 5), (3, 2, "10.01", "PENDING", 5),
                          (4, 3, "5.00", "APPROVED", 5)])
    done = decisions.approve_pending(rows, accounts)
    assert {r.transaction_id: (r.outcome, r.reason) for r in done.outcomes.collect()} == {
        1: ("accepted", None), 2: ("accepted", None), 3: ("refused", "overdraft")}
    found = decisions.deducted_balances(accounts, done.deductions).collect()
    assert {r.account_id: (str(r.balance), str(r.deducted)) for r in found} == {
        1: ("0.00", "10.00"), 2: ("10.00", "0.00"), 3: ("5.00", "0.00")}
    strict = decisions.approve_pending(rows, accounts, refuse_overdrafts=False)
    with pytest.raises(PySparkException, match="overdraft of account 2"):
        decisions.deducted_balances(accounts, strict.deductions).collect()


def test_one_request_reads_only_its_days_and_customers(spark, tmp_path):
    layout.write_transactions(sample.transactions(spark), str(tmp_path / "t"))
    kept = spark.read.parquet(str(tmp_path / "t"))
    batch = kept.filter("transaction_id = 8")
    assert [r.transaction_id for r in history_around(batch, kept, sample.accounts(spark)).collect()] == [8]


def test_customer_delete_check(frame):
    requests = frame([(1,), (2,), (3,), (4,), (1,)], "customer_id bigint")
    people = frame([(1,), (2,), (3,)], "customer_id bigint")
    accounts = frame([(1, 1, "ACTIVE"), (2, 1, "CLOSED"), (3, 2, "CLOSED")], "account_id bigint, customer_id bigint, status string")
    found = {r.customer_id: tuple(r)[1:] for r in decisions.customer_delete_check(requests, people, accounts).collect()}
    assert found == {1: ("refused: active accounts", 1, 2), 2: ("refused: accounts refer to it", 0, 1),
                     3: ("allowed", 0, 0), 4: ("absent", 0, 0)}


# Reports.


def test_alert_fan_out_counts_in_every_measure(spark):
    base = sample.transactions(spark).withColumn("risk_score", F.col("transaction_id").cast("int"))
    base = base.withColumn("status", F.when(F.col("transaction_id") == 3, "FLAGGED").otherwise(F.col("status")))
    alerts = sample.alerts(spark, [(k, 3, None, "r", 3, "OPEN", datetime(2026, 6, 1), f"s{k}") for k in range(3)])
    rows = summary.daily_fraud_summary(base, alerts, sample.accounts(spark), sample.customers(spark), AS_OF)
    row = rows.filter("transaction_date = date '2026-05-30'").collect()[0]
    assert (row.total_transactions, str(row.total_amount), row.flagged_transactions, str(row.suspicious_amount)) == (
        5, "6670.00", 3, "6000.00")
    assert str(row.avg_risk_score) == "2.40" and row.total_fraud_alerts == 3


def test_profile_keeps_customers_without_accounts(spark):
    accounts = sample.accounts(spark).filter("account_id <> 5")
    rows = reports.customer_risk_profile(sample.transactions(spark), accounts, sample.customers(spark), AS_OF)
    taras = rows.filter("customer_id = 5").collect()[0]
    assert rows.count() == 10 and taras.total_transactions == 0 and str(taras.total_approved_amount) == "0.00"


def test_summary_versions_and_daily_refresh(spark, tmp_path):
    def compute(transactions):
        return summary.daily_fraud_summary(
            transactions, sample.alerts(spark), sample.accounts(spark), sample.customers(spark), AS_OF)

    first = sample.transactions(spark)
    old = summary.refresh_summary(compute(first), str(tmp_path / "full"))
    changed = first.withColumn("status", F.when(F.col("transaction_id") == 10, "FLAGGED").otherwise(F.col("status")))
    new = summary.refresh_summary(compute(changed), str(tmp_path / "full"))
    assert old != new
    assert summary.read_summary(spark, old, flagged_only=True).count() == 0
    assert [r.transaction_date for r in summary.read_summary(spark, new, flagged_only=True).collect()] == [date(2026, 5, 29)]

    others = (sample.alerts(spark), sample.accounts(spark), sample.customers(spark), AS_OF)
    days = spark.createDataFrame([(date(2026, 5, 29),), (date(2026, 5, 30),), (None,)], "transaction_date date")
    later = first.withColumn("status", F.lit("FLAGGED")).filter("to_date(transaction_at) <> date '2026-05-30'")
    untimed = later.withColumn("transaction_at", F.when(F.col("transaction_id") != 12, F.col("transaction_at")))
    rows = summary.refreshed_days(summary.read_summary(spark, old), days, untimed, *others).collect()
    assert {r.transaction_date: (r.total_transactions, r.flagged_transactions) for r in rows} == {
        date(2026, 5, 29): (1, 1), date(2026, 5, 31): (3, 0), date(2026, 6, 1): (5, 0), None: (1, 1)}


def test_pair_count_equals_the_expanded_join(frame):
    people = frame([(1, "active"), (2, "inactive"), (3, "blocked"), (4, "active")], "customer_id bigint, status string")
    orders = frame([(i, 1 + i % 5) for i in range(23)], "order_id bigint, customer_id bigint")
    day = lambda k: datetime(2026, 6, 2) - timedelta(days=k)
    events = frame([(i, 1 + i % 3, day(i * 9)) for i in range(20)], "event_id bigint, customer_id bigint, event_time timestamp_ntz")
    wide = people.filter("status <> 'blocked'").join(orders, "customer_id").join(
        events.filter(f"event_time >= timestamp_ntz '{AS_OF}' - interval 90 day"), "customer_id")
    found = commerce.order_event_pair_count(people, orders, events, AS_OF).collect()[0].pair_count
    assert found == wide.count() > 0
    seen = commerce.orders_with_recent_events(people, orders, events, AS_OF).collect()[0].orders_count
    assert seen == wide.select("order_id").distinct().count() < found


def test_revenue_ties_and_absent_amounts(frame):
    people = frame([(i, f"n{i}", "active") for i in range(4)], "customer_id bigint, full_name string, status string")
    orders = frame([(0, 0, Decimal("5.00")), (1, 1, Decimal("5.00")), (2, 2, None), (3, 3, Decimal("9.00"))],
                   "order_id bigint, customer_id bigint, total_amount decimal(12,2)")
    rows = commerce.customer_revenue_top(people, orders, k=3).collect()
    assert [r.customer_id for r in rows] == [2, 3, 0]


# Stored layouts and generated tables.


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_layouts_prune_folders(spark, tmp_path):
    made = synthetic.commerce_tables(spark, 50, 10, 300, 400, AS_OF)
    layout.write_events(made["customer_events_wide"].select(*schemas.EVENT_CORE), str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e")).filter("event_date >= date '2026-05-01' and customer_id = 7")
    assert "PartitionFilters: [isnotnull(event_date" in plan(events)
    assert "EqualTo(customer_id,7)" in plan(events)
    layout.write_events(made["customer_events_wide"], str(tmp_path / "h"), by_hour=True)
    night = spark.read.parquet(str(tmp_path / "h")).filter("event_hour = 3")
    assert "PartitionFilters: [isnotnull(event_hour" in plan(night)
    assert night.count() == made["customer_events_wide"].filter("hour(event_time) = 3").count() > 0
    layout.write_orders(made["orders"], str(tmp_path / "o"))
    orders = spark.read.parquet(str(tmp_path / "o")).filter("status = 'paid' and order_year = 2026")
    assert "PartitionFilters: [isnotnull(status" in plan(orders)
    assert orders.count() == made["orders"].filter("status = 'paid' and year(order_date) = 2026").count() > 0
    assert spark.read.parquet(str(tmp_path / "e")).count() == 400


def test_bucketed_tables_join_without_shuffle(spark):
    rows = sample.transactions(spark)
    layout.write_bucketed(rows, "bucketed_transactions", "transaction_id", 4, mode="overwrite")
    layout.write_bucketed(rows.select("transaction_id", "status"), "bucketed_states", "transaction_id", 4, mode="overwrite")
    joined = spark.table("bucketed_transactions").hint("merge").join(
        spark.table("bucketed_states").withColumnRenamed("status", "other"), "transaction_id")
    assert "Exchange" not in plan(joined) and joined.count() == 12


def test_append_fills_absent_columns(spark, frame, tmp_path):
    folder = str(tmp_path / "t")
    kind = "id bigint, status string, score int, note string"
    layout.append(frame([(1, None)], "id bigint, status string"), folder, kind, {"status": "PENDING", "score": 0})
    layout.append(frame([(2,)], "id int"), folder, kind, {"status": "PENDING", "score": 0})
    rows = spark.read.schema(kind).parquet(folder).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None, 0, None), (2, "PENDING", 0, None)]


def test_generated_tables(spark):
    made = synthetic.commerce_tables(spark, 40, 15, 200, 100, AS_OF, seed=3)
    again = synthetic.commerce_tables(spark, 40, 15, 200, 100, AS_OF, seed=3)
    other = synthetic.commerce_tables(spark, 40, 15, 200, 100, AS_OF, seed=4)
    for name, rows in made.items():
        assert rows.exceptAll(again[name].repartition(7)).count() == 0, name
        assert rows.exceptAll(other[name]).count() > 0, name
    items, orders = made["order_items"], made["orders"]
    assert {n: made[n].count() for n in ("customers", "products", "orders", "customer_events_wide")} == {
        "customers": 40, "products": 15, "orders": 200, "customer_events_wide": 100}
    assert items.select("order_item_id").distinct().count() == items.count()
    per_order = items.groupBy("order_id").count()
    assert per_order.count() == 200 and {r["count"] for r in per_order.collect()} == {1, 2, 3, 4, 5}
    bounds = items.agg(F.min("quantity"), F.max("quantity"), F.min("unit_price"), F.max("unit_price"),
                       F.min("product_id"), F.max("product_id")).collect()[0]
    assert bounds[0] >= 1 and bounds[1] <= 10 and bounds[2] >= 5 and bounds[3] <= 1000
    assert bounds[4] >= 1 and bounds[5] <= 15
    assert orders.join(made["customers"], "customer_id", "left_anti").count() == 0
    assert {r.status for r in orders.select("status").distinct().collect()} == {"new", "paid", "shipped", "cancelled", "returned"}
    assert len(made["customer_events_wide"].columns) == 25


# Streams.


def sequential(batches, owners):
    """Each batch scored from rows of earlier batches and its own."""
    seen, result = [], {}
    for rows in batches:
        fresh = [r for r in rows if r[7] == "PENDING" and r[1] in owners and r[0] not in result]
        seen += fresh
        truth = brute_force(seen, owners)
        result |= {r[0]: truth[r[0]][3] for r in fresh}
    return result


def batches():
    rows, owners = random_rows(180, 8, spread_hours=8)
    rows.sort(key=lambda r: r[9])
    return [rows[:70], rows[70:120], rows[120:] + rows[100:110]], owners


def outputs(spark, store):
    return {
        name: sorted(map(str, ingest.read_output(spark, store, name).collect()))
        for name in ("transactions", "history", "alerts", "balance_deltas", "refused")
    }


def test_ordered_batches_and_replay(spark, frame, tmp_path):
    parts, owners = batches()
    accounts = frame(list(owners.items()), ACCOUNTS)
    store = str(tmp_path / "store")
    for number, rows in enumerate(parts):
        ingest.score_batch(frame(rows, schemas.TRANSACTIONS), number, accounts, store, AS_OF)
    found = ingest.read_output(spark, store, "transactions").collect()
    truth = sequential(parts, owners)
    assert {r.transaction_id: r.risk_score for r in found} == truth
    assert all(r.status == verdict(r.risk_score) for r in found)
    refused = ingest.read_output(spark, store, "refused").collect()
    assert {r.reason for r in refused} == {"not pending", "unknown account", "already stored"}
    moved = [(*r[:9], r[9] + 40 * 24 * HOUR) for r in parts[0] if r[7] == "PENDING" and r[1] in owners][:3]
    other = [(9000, 1, *moved[0][2:]), (9000, 2, *moved[0][2:])]
    ingest.score_batch(frame(moved + other, schemas.TRANSACTIONS), 3, accounts, store, AS_OF)
    late = ingest.read_batch(spark, store, "refused", 3).collect()
    assert sorted((r.transaction_id, r.reason) for r in late) == sorted(
        [(r[0], "already stored") for r in moved] + [(9000, "conflicting repeat")])
    assert ingest.read_batch(spark, store, "transactions", 3).count() == 0

    once = outputs(spark, store)
    for number in (2, 1):
        ingest.score_batch(frame(parts[number], schemas.TRANSACTIONS), number, accounts, store, AS_OF)
    assert outputs(spark, store) == once


def test_compacted_base_gives_the_same_scores(spark, frame, tmp_path):
    parts, owners = batches()
    accounts = frame(list(owners.items()), ACCOUNTS)
    store = str(tmp_path / "store")
    base = None
    for number, rows in enumerate(parts):
        if number == 2:
            base = ingest.compact(spark, store, 2, str(tmp_path / "base"))
        ingest.score_batch(frame(rows, schemas.TRANSACTIONS), number, accounts, store, AS_OF, base)
    found = ingest.read_output(spark, store, "transactions").collect()
    assert {r.transaction_id: r.risk_score for r in found} == sequential(parts, owners)


def test_scoring_stream_of_files(spark, frame, tmp_path):
    parts, owners = batches()
    accounts = frame(list(owners.items()), ACCOUNTS)
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    for rows in parts[:2]:
        frame(rows, schemas.TRANSACTIONS).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.TRANSACTIONS).parquet(source)
        ingest.start_scoring(stream, accounts, store, AS_OF).awaitTermination()
    found = ingest.read_output(spark, store, "transactions")
    assert {r.transaction_id: r.risk_score for r in found.collect()} == sequential(parts[:2], owners)
    assert {r.batch_id for r in found.select("batch_id").distinct().collect()} == {0, 1}


def test_change_log(spark, frame, tmp_path):
    store = str(tmp_path)
    base = frame([(1, "PENDING"), (2, "PENDING"), (3, "FLAGGED")], "transaction_id bigint, status string")
    kind = "transaction_id bigint, status string, changed_by string, changed_at timestamp_ntz"
    first = frame([(1, "FLAGGED", "a", T0), (1, "APPROVED", "b", T0 + HOUR), (3, "FLAGGED", "a", T0), (9, "APPROVED", "a", T0)], kind)
    second = frame([(1, "DECLINED", "c", T0 + 2 * HOUR), (2, "PENDING", "c", T0), (2, "APPROVED", "c", T0 + HOUR)], kind)
    for _ in range(2):
        ingest.log_changes_batch(first, 0, base, store)
        ingest.log_changes_batch(second, 1, base, store)
    rows = ingest.read_output(spark, store, "status_changes").collect()
    assert sorted((r.transaction_id, r.old_status, r.new_status, r.changed_by) for r in rows) == [
        (1, "APPROVED", "DECLINED", "c"), (1, "FLAGGED", "APPROVED", "b"), (1, "PENDING", "FLAGGED", "a"),
        (2, "PENDING", "APPROVED", "c"),
    ]
    keys = [(r.transaction_id, r.seq) for r in rows]
    assert len(set(keys)) == len(keys)
    assert [r.transaction_id for r in ingest.read_output(spark, store, "change_refused").collect()] == [9]


def test_change_log_of_a_busy_transaction(spark, frame, tmp_path):
    pick = random.Random(9)
    rows, at = [], T0
    for _ in range(200):
        at += timedelta(seconds=pick.choice([0.5, 5, 59, 60, 3000]))
        rows.append((pick.choice([1, 1, 2]), pick.choice("ABC"), "a", at))
    base = frame([(1, "A"), (2, None)], "transaction_id bigint, status string")
    kind = "transaction_id bigint, status string, changed_by string, changed_at timestamp_ntz"
    ingest.log_changes_batch(frame(rows, kind), 0, base, str(tmp_path))
    latest, want = {1: "A", 2: None}, []
    for i, status, _, when in rows:
        if latest[i] != status:
            want.append((i, latest[i], status, when))
        latest[i] = status
    found = ingest.read_output(spark, str(tmp_path), "status_changes").collect()
    assert sorted((r.transaction_id, r.changed_at, r.old_status, r.new_status) for r in found) == sorted(
        (i, when, old, new) for i, old, new, when in want)
    for i in (1, 2):
        ordered = sorted((r for r in found if r.transaction_id == i), key=lambda r: r.changed_at)
        assert [r.seq for r in ordered] == sorted({r.seq for r in ordered})


def test_ledger_counts_a_transaction_once(frame):
    accounts = frame([(1, Decimal("10.00"))], "account_id bigint, balance decimal(15,2)")
    deltas = frame([(7, 1, Decimal("-4.00")), (7, 1, Decimal("-4.00")), (8, 1, Decimal("-7.00"))],
                   "transaction_id bigint, account_id bigint, delta decimal(15,2)")
    row = ingest.ledger_balances(accounts, deltas).collect()[0]
    assert str(row.balance) == "-1.00" and row.overdrawn


def test_arrivals_of_one_statement_see_each_other(spark, frame, tmp_path):
    rows = [tx(i, 1, T0 - timedelta(minutes=i)) for i in range(6)]
    ingest.score_batch(frame(rows, schemas.TRANSACTIONS), 0, frame([(1, 1)], ACCOUNTS), str(tmp_path), AS_OF)
    scores = {r.transaction_id: r.risk_score for r in ingest.read_output(spark, str(tmp_path), "transactions").collect()}
    assert scores == {0: 20, 1: 10, 2: 10, 3: 0, 4: 0, 5: 0}
