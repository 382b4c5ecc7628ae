"""A day at the sample bank: inserts, decisions, freezes, deletes, SQL names."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

import sample
from vigil import schemas
from vigil.plans import bank as jobs
from vigil.plans import catalog, reports, summary
from vigil.session import stored, work_folder


@pytest.fixture(scope="module")
def empty(spark):
    def table(kind):
        return spark.createDataFrame([], kind)

    return jobs.Bank(
        sample.customers(spark), sample.accounts(spark), table(schemas.CARDS), table(schemas.TRANSACTIONS),
        table(schemas.STATUS_HISTORY), sample.rules(spark), table(schemas.FRAUD_ALERTS), table(schemas.AUDIT_LOG),
    )


@pytest.fixture(scope="module")
def loaded(spark, empty):
    return jobs.insert_transactions(empty, sample.transactions(spark), sample.AS_OF).bank


def arrival(i, account, amount, country="KP", category="GAMBLING", status="PENDING"):
    return (i, account, None, Decimal(amount), "EUR", category, country, status, 0, datetime(2026, 6, 1, 13))


def balances(bank):
    return {r.account_id: str(r.balance) for r in bank.accounts.collect()}


def test_insert_has_all_effects(loaded):
    assert loaded.transactions.count() == 12 and loaded.history.count() == 23
    assert balances(loaded)[1] == "14450.50" and balances(loaded)[9] == "670.20"
    keys = loaded.history.select("transaction_id", "seq")
    assert keys.distinct().count() == 23


def test_defaults_and_refusals(spark, loaded):
    rows = [(21, 6, Decimal("5.00"), datetime(2026, 6, 1, 20)), (1, 1, Decimal("5.00"), datetime(2026, 6, 1, 20)),
            (22, 99, Decimal("5.00"), datetime(2026, 6, 1, 20))]
    arrivals = spark.createDataFrame(
        rows, "transaction_id bigint, account_id bigint, amount decimal(15,2), transaction_at timestamp_ntz"
    ).selectExpr("*", "cast(null as string) as merchant_category", "cast(null as string) as merchant_country")
    done = jobs.insert_transactions(loaded, arrivals, sample.AS_OF)
    assert {r.transaction_id: r.outcome for r in done.outcomes.collect()} == {21: "accepted", 1: "refused", 22: "refused"}
    row = done.bank.transactions.filter("transaction_id = 21").collect()[0]
    assert (row.currency, row.status, row.card_id) == ("UAH", "APPROVED", None)


def test_flagged_arrival_raises_an_alert_without_rule(spark, loaded):
    rows = spark.createDataFrame([arrival(31, 6, "9000.00")], schemas.TRANSACTIONS)
    bank = jobs.insert_transactions(loaded, rows, sample.AS_OF).bank
    alert = bank.alerts.collect()[0]
    assert (alert.transaction_id, alert.reason, alert.rule_id) == (31, "Auto-flagged: risk score 60", None)
    assert balances(bank)[6] == balances(loaded)[6]


def test_overdraft_fails_or_is_kept_back(spark, loaded):
    rows = spark.createDataFrame([arrival(41, 5, "0.01", None, None)], schemas.TRANSACTIONS)
    with pytest.raises(PySparkException, match="overdraft of account 5"):
        jobs.insert_transactions(loaded, rows, sample.AS_OF).bank.accounts.collect()
    done = jobs.insert_transactions(loaded, rows, sample.AS_OF, strict=False)
    assert balances(done.bank)[5] == "0.00"
    assert [tuple(r) for r in done.outcomes.collect()] == [(41, "refused", "overdraft")]
    assert [r.status for r in done.bank.transactions.filter("transaction_id = 41").collect()] == ["PENDING"]


def test_all_approvals_of_an_overdrawn_account_are_refused(spark, loaded):
    rows = [arrival(61, 9, "600.00", None, None), arrival(62, 9, "70.21", None, None), arrival(63, 8, "1.00", None, None)]
    waiting = loaded._replace(transactions=loaded.transactions.unionByName(spark.createDataFrame(rows, schemas.TRANSACTIONS)))
    ids = spark.createDataFrame([(61,), (62,), (63,)], "transaction_id bigint")
    done = jobs.process_transactions(waiting, ids, sample.AS_OF, strict=False)
    assert {r.transaction_id: (r.outcome, r.reason) for r in done.outcomes.collect()} == {
        61: ("refused", "overdraft"), 62: ("refused", "overdraft"), 63: ("accepted", None)}
    assert balances(done.bank)[9] == balances(loaded)[9]
    assert {r.transaction_id: r.status for r in done.bank.transactions.filter("transaction_id > 60").collect()} == {
        61: "PENDING", 62: "PENDING", 63: "APPROVED"}
    assert done.bank.history.filter("transaction_id in (61, 62)").count() == 0
    with pytest.raises(PySparkException, match="overdraft of account 9"):
        jobs.process_transactions(waiting, ids, sample.AS_OF).bank.accounts.collect()


def test_arrivals_that_differ_are_refused_and_absent_times_are_filled(spark, loaded):
    kind = "transaction_id bigint, account_id bigint, amount decimal(15,2), merchant_category string, merchant_country string"
    rows = [(71, 6, Decimal("7.00"), None, None), (71, 8, Decimal("8.00"), None, None), (72, 6, Decimal("1.00"), None, None), (72, 6, Decimal("1.00"), None, None)]
    done = jobs.insert_transactions(loaded, spark.createDataFrame(rows, kind), sample.AS_OF)
    assert sorted(map(tuple, done.outcomes.collect())) == [(71, "refused", "conflicting repeat"), (72, "accepted", None)]
    row = done.bank.transactions.filter("transaction_id = 72").collect()
    assert [str(r.transaction_at) for r in row] == [sample.AS_OF]


def test_process_then_approve_then_freeze(spark, loaded):
    ids = spark.createDataFrame([(10,), (1,), (77,)], "transaction_id bigint")
    done = jobs.process_transactions(loaded, ids, sample.AS_OF)
    assert {r.transaction_id: r.outcome for r in done.outcomes.collect()} == {10: "accepted", 1: "refused", 77: "refused"}
    assert done.bank.history.count() == 23  # 45 points: still pending

    unscored = spark.createDataFrame([arrival(51, 8, "10.00", None, None, "PENDING")], schemas.TRANSACTIONS)
    waiting = done.bank._replace(transactions=done.bank.transactions.unionByName(
        unscored.selectExpr(*(c if c != "risk_score" else "20 as risk_score" for c in unscored.columns))))
    approved = jobs.approve_pending(waiting, sample.AS_OF)
    assert [r.outcome for r in approved.outcomes.collect()] == ["accepted"]
    assert Decimal(balances(approved.bank)[8]) == Decimal(balances(waiting)[8]) - 10
    assert approved.bank.history.count() == 24

    account = spark.createDataFrame([(9,), (7,)], "account_id bigint")
    frozen = jobs.freeze_accounts(approved.bank, account, sample.AS_OF)
    last = frozen.bank.history.filter("transaction_id = 10").orderBy("seq").collect()
    assert [(r.seq, r.old_status, r.new_status) for r in last] == [(0, None, "PENDING"), (1, "PENDING", "DECLINED")]
    assert frozen.bank.accounts.filter("status = 'FROZEN'").count() == 3


def test_deletes_follow_references(spark, loaded):
    ids = spark.createDataFrame([(1,), (2,)], "transaction_id bigint")
    bank = jobs.delete_transactions(loaded, ids)
    assert bank.transactions.count() == 10 and bank.history.count() == 19
    cards = spark.createDataFrame([(3,)], "card_id bigint")
    bank = jobs.delete_cards(bank, cards)
    assert [r.card_id for r in bank.transactions.filter("account_id = 3").collect()] == [None]
    assert bank.transactions.filter("card_id is null").count() == 1
    assert jobs.delete_rules(bank, spark.createDataFrame([(1,)], "rule_id int")).rules.count() == 4

    log = spark.createDataFrame([(1, 1, "customers", "INSERT", None, None, None), (2, 2, "customers", "INSERT", None, None, None)], schemas.AUDIT_LOG)
    no_accounts = bank._replace(audit=log, accounts=bank.accounts.filter("customer_id <> 2"))
    done = jobs.delete_customers(no_accounts, spark.createDataFrame([(1,), (2,)], "customer_id bigint"))
    assert {r.customer_id: r.outcome for r in done.outcomes.collect()} == {1: "refused: active accounts", 2: "allowed"}
    assert done.bank.customers.count() == 9
    assert {r.audit_id: r.customer_id for r in done.bank.audit.collect()} == {1: 1, 2: None}


def test_sql_names(spark, loaded, tmp_path):
    tables = {"customers": loaded.customers, "accounts": loaded.accounts, "transactions": loaded.transactions,
              "fraud_alerts": loaded.alerts, "fraud_rules": loaded.rules}
    path = summary.refresh_summary(
        summary.daily_fraud_summary(loaded.transactions, loaded.alerts, loaded.accounts, loaded.customers, sample.AS_OF),
        str(tmp_path))
    catalog.register(spark, tables, sample.AS_OF, path)
    one = lambda text: spark.sql(text).collect()[0][0]
    assert one("select mask_card_number('4111111111111234')") == "****-****-****-1234"
    assert one("select mask_card_number('123')") == "****"
    flags = spark.sql("select code, is_high_risk_country(code) from values ('UA'), ('KP'), (null) as v(code)").collect()
    assert {r[0]: r[1] for r in flags} == {"UA": False, "KP": True, None: None}
    ages = spark.sql("select customer_id, get_customer_age(customer_id) from customers order by 1").collect()
    assert [r[1] for r in ages] == [41, 35, 48, 33, 46, 30, 51, 37, 60, 27]
    assert str(one("select calculate_customer_daily_volume(2, date '2026-05-30')")) == "2120.00"
    assert str(one("select calculate_customer_daily_volume(1, date '2020-01-01')")) == "0.00"
    assert one("select calculate_transaction_risk_score(10)") == 45
    for call in ("get_customer_age(99)", "calculate_transaction_risk_score(99)"):
        with pytest.raises(PySparkException, match="not found: 99"):
            one(f"select {call}")
    assert one("select count(*) from vw_customer_accounts where account_status = 'FROZEN'") == 2
    assert one("select count(*) from vw_recent_transactions where risk_level = 'MEDIUM'") == 1
    assert one("select count(*) from vw_flagged_transactions where alert_status = 'OPEN'") == 0
    assert one("select count(*) from vw_customer_risk_profile where overall_risk_level = 'MEDIUM'") == 1
    assert one("select count(*) from mv_daily_fraud_summary where flagged_transactions > 0") == 0


def test_report_order(loaded):
    rows = reports.transactions_with_risk_label(loaded.transactions, loaded.accounts, loaded.customers)
    assert [r.transaction_id for r in reports.presented(rows, "transactions_with_risk_label").take(4)] == [10, 8, 3, 6]
    recent = reports.recent_transactions(loaded.transactions, loaded.accounts, loaded.customers, sample.AS_OF)
    times = [r.transaction_at for r in reports.presented(recent, "recent_transactions").collect()]
    assert times == sorted(times, reverse=True) and len(times) == 12


def test_work_folder_follows_the_cluster_setting(spark, frame):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(shared + "/x-")
    rows = stored(frame([(1, "a"), (2, None)], "id int, v string"), "kept")
    assert rows.inputFiles() and all(shared in path for path in rows.inputFiles())
    assert sorted(map(tuple, rows.collect())) == [(1, "a"), (2, None)]
