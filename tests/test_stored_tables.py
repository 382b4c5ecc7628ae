"""Tables that jobs keep: pruned reads, partitions rewritten in place, buckets, variants, whole batches and streams."""

import re
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import sample
from test_jobs import AS_OF, batches, outputs, plan, sequential
from test_scoring import ACCOUNTS, HOUR
from vigil import schemas
from vigil.operators import audit, keyed
from vigil.plans import registered, reports, summary
from vigil.plans.scoring import history_around, on_days
from vigil.sources import layout, versions
from vigil.streaming import ingest


def files(folder):
    """Data files of a laid-out table by folder."""
    found = {}
    for path in Path(folder).rglob("*.parquet"):
        found.setdefault(path.parent.name, set()).add((path.name, path.stat().st_mtime_ns))
    return found


# Pruned reads.


@pytest.fixture
def by_day(spark, tmp_path):
    """Sample transactions by day, with a file in another day's folder that no read survives."""
    layout.write_transactions(sample.transactions(spark), str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "tx_date=2026-05-29").mkdir(exist_ok=True)
    (tmp_path / "t" / "tx_date=2026-05-29" / "broken.parquet").write_bytes(b"no parquet")
    broken = spark.read.schema(table.schema).parquet(str(tmp_path / "t"))
    with pytest.raises(Exception, match="not a Parquet file"):
        broken.collect()
    return broken


def test_history_reads_only_the_days_of_a_batch(spark, by_day):
    batch = sample.transactions(spark).filter("transaction_id = 8")
    around = history_around(batch, by_day, sample.accounts(spark))
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan(around))
    assert [r.transaction_id for r in around.collect()] == [8]
    night = batch.withColumn("transaction_at", F.lit("2026-06-01 00:30:00").cast("timestamp_ntz"))
    assert 8 in [r.transaction_id for r in history_around(night, by_day, sample.accounts(spark)).collect()]


def test_days_prune_a_union_and_drop_nulls(spark, by_day):
    days = spark.createDataFrame([(date(2026, 6, 1),), (None,), (date(2026, 6, 1),)], "day date")
    twice = by_day.unionByName(by_day)
    once = by_day.filter("tx_date = date '2026-06-01'").count()
    assert on_days(twice, days).count() == 2 * once > 0


# Partitions rewritten in place.


def test_summary_is_refreshed_in_place(spark, tmp_path):
    folder, first = str(tmp_path / "s"), sample.transactions(spark)
    others = (sample.alerts(spark), sample.accounts(spark), sample.customers(spark), AS_OF)
    summary.write_summary(summary.daily_fraud_summary(first, *others), folder)
    before = files(folder)
    assert set(before) >= {"transaction_date=2026-05-29", "transaction_date=2026-05-30", "transaction_date=2026-06-01"}
    days = spark.createDataFrame([(date(2026, 5, 29),), (date(2026, 5, 30),), (None,)], "transaction_date date")
    later = first.withColumn("status", F.lit("FLAGGED")).filter("to_date(transaction_at) <> date '2026-05-30'")
    untimed = later.withColumn("transaction_at", F.when(F.col("transaction_id") != 12, F.col("transaction_at")))
    summary.refresh_days(folder, days, untimed, *others)
    after = files(folder)
    assert after["transaction_date=2026-06-01"] == before["transaction_date=2026-06-01"]
    assert after["transaction_date=2026-05-31"] == before["transaction_date=2026-05-31"]
    assert after["transaction_date=2026-05-29"] != before["transaction_date=2026-05-29"]
    assert "transaction_date=2026-05-30" not in after
    rows = summary.read_summary(spark, folder).collect()
    assert {r.transaction_date: (r.total_transactions, r.flagged_transactions) for r in rows} == {
        date(2026, 5, 29): (1, 1), date(2026, 5, 31): (3, 0), date(2026, 6, 1): (5, 0), None: (1, 1)}
    whole = summary.refreshed_days(summary.read_summary(spark, folder), days, untimed, *others)
    assert sorted(map(str, whole.collect())) == sorted(map(str, rows))


def _orders(spark):
    rows = [(n, n % 3, datetime(2026 - n % 2, 1 + n % 12, 1), ["new", "paid", None][n % 3], None) for n in range(24)]
    return spark.createDataFrame(rows, "order_id bigint, customer_id bigint, order_date timestamp_ntz, status string, delivery_city string")


def test_update_rewrites_only_touched_partitions(spark, tmp_path):
    folder = str(tmp_path / "o")
    layout.write_orders(_orders(spark), folder)
    before = files(folder)
    updates = spark.createDataFrame([(0, "Lviv"), (6, "Odesa"), (6, "Odesa"), (99, "Kyiv")], "order_id bigint, delivery_city string")
    touched = layout.update_partitions(spark, folder, updates, "order_id", ["status", "order_year"], ["order_date"])
    assert [tuple(r) for r in touched.collect()] == [("new", 2026)]
    after = {p.relative_to(folder).parent.as_posix(): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}
    assert len(after) >= 6
    assert sum(files(folder)[k] != before[k] for k in before) == 1  # order_year=2026 of one status
    found = {r.order_id: r.delivery_city for r in spark.read.parquet(folder).collect()}
    assert len(found) == 24 and {k: v for k, v in found.items() if v} == {0: "Lviv", 6: "Odesa"}


def test_update_of_a_folder_column_moves_rows(spark, tmp_path):
    folder = str(tmp_path / "o")
    layout.write_orders(_orders(spark), folder)
    updates = _orders(spark).filter("status = 'new'").select("order_id", F.lit("paid").alias("status"))
    layout.update_partitions(spark, folder, updates, "order_id", ["status", "order_year"])
    assert not list(Path(folder).glob("status=new/*"))
    expected = keyed.update_columns(_orders(spark), updates, "order_id").select("order_id", "status", "customer_id")
    found = spark.read.parquet(folder).select("order_id", "status", "customer_id")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_nothing_to_update_rewrites_nothing(spark, tmp_path):
    folder = str(tmp_path / "o")
    layout.write_orders(_orders(spark), folder)
    before = files(folder)
    updates = spark.createDataFrame([(99, "x")], "order_id bigint, delivery_city string")
    layout.update_partitions(spark, folder, updates, "order_id", ["status", "order_year"])
    assert files(folder) == before


# Buckets.


def shuffles(frame):
    return len(re.findall(r"\bExchange\b", plan(frame)))


def test_split_and_bucketed_tables_join_without_a_shuffle(spark):
    tables = registered.Tables(spark, "/root/testdata/sf0.001")
    wide = registered.split_events_rejoined(tables)
    assert shuffles(wide) == 0 and "SortMergeJoin" in plan(wide)
    facts = registered.bucketed_facts(tables)
    assert shuffles(facts) == 0 and "SortMergeJoin" in plan(facts)
    loose = reports.transaction_facts(tables["bank_transactions_scored"], tables["bank_status_history"], tables["bank_fraud_alerts"])
    assert shuffles(loose) > 0
    assert sorted(map(str, facts.collect())) == sorted(map(str, loose.collect()))


# Variants.


def test_changed_fields_of_variants(spark):
    rows = [
        ("a", 1, "UPDATE", '{"x":"1","y":null}', '{"x":"2","y":"3"}'), ("a", 2, "INSERT", None, '{"x":null}'),
        ("b", 3, "DELETE", '{"y":"4","z":5}', None), ("b", 4, "UPDATE", "{}", "{}"),
    ]
    frame = spark.createDataFrame(rows, "table_name string, row_key bigint, operation string, old_value string, new_value string")
    found = audit.changed_fields(frame, ["x", "y"])
    assert sorted((r.row_key, r.column_name, r.old_text, r.new_text) for r in found.collect()) == [
        (1, "x", "1", "2"), (1, "y", None, "3"), (2, "x", None, None), (3, "y", "4", None)]


# Versions of several tables.


def test_versions_are_seen_whole(spark, frame, tmp_path):
    folder, kind = str(tmp_path / "v"), "id bigint, v string"
    first, second = frame([(1, "a")], kind), frame([(1, "b"), (2, None)], kind)
    with pytest.raises(ValueError, match="no whole version"):
        versions.load(spark, folder)
    assert versions.save({"x": first, "y": first}, folder) == 1
    broken = second.withColumn("v", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        versions.save({"x": second, "y": broken}, folder)
    seen = versions.load(spark, folder)
    assert [r.v for r in seen["x"].collect()] == ["a"] and versions.last_version(spark, folder) == 1
    # What was read from one version becomes the next; the earlier one stays as it was.
    changed = {"x": seen["x"].unionByName(second), "y": second}
    assert versions.save(changed, folder) == 2
    assert versions.load(spark, folder)["x"].count() == 3 and versions.load(spark, folder, 1)["x"].count() == 1


# Whole batches and streams.


def test_readers_see_whole_batches_only(spark, frame, tmp_path, monkeypatch):
    parts, owners = batches()
    accounts = frame(list(owners.items()), ACCOUNTS)
    store, unbroken = str(tmp_path / "store"), str(tmp_path / "unbroken")
    for number, rows in enumerate(parts[:2]):
        ingest.score_batch(frame(rows, schemas.TRANSACTIONS), number, accounts, unbroken, AS_OF)
    ingest.score_batch(frame(parts[0], schemas.TRANSACTIONS), 0, accounts, store, AS_OF)
    first, write = outputs(spark, store), ingest._write

    def failing(rows, folder, name, batch_id, by=None):
        if name == "alerts":
            raise OSError("lost")
        write(rows, folder, name, batch_id, by)

    monkeypatch.setattr(ingest, "_write", failing)
    with pytest.raises(OSError, match="lost"):
        ingest.score_batch(frame(parts[1], schemas.TRANSACTIONS), 1, accounts, store, AS_OF)
    assert ingest.read_batch(spark, store, "transactions", 1).count() > 0
    assert outputs(spark, store) == first
    monkeypatch.setattr(ingest, "_write", write)
    ingest.score_batch(frame(parts[1], schemas.TRANSACTIONS), 1, accounts, store, AS_OF)
    assert outputs(spark, store) == outputs(spark, unbroken) != first
    assert [r.batch_id for r in ingest.whole_batches(spark, store, ingest.SCORING).orderBy("batch_id").collect()] == [0, 1]
    with pytest.raises(OSError, match="lost"):  # a batch that is written again is hidden until it is whole
        monkeypatch.setattr(ingest, "_write", failing)
        ingest.score_batch(frame(parts[1], schemas.TRANSACTIONS), 1, accounts, store, AS_OF)
    assert outputs(spark, store) == first


def test_unread_batches_are_not_opened(spark, frame, tmp_path):
    parts, owners = batches()
    accounts, store = frame(list(owners.items()), ACCOUNTS), str(tmp_path / "store")
    ingest.score_batch(frame(parts[0], schemas.TRANSACTIONS), 0, accounts, store, AS_OF)
    broken = tmp_path / "store" / "history" / "batch_id=7"
    broken.mkdir()
    (broken / "broken.parquet").write_bytes(b"no parquet")
    assert ingest.read_output(spark, store, "history").count() > 0
    assert ingest.read_output(spark, str(tmp_path / "none"), "history").count() == 0


def _stream(spark, source, per_batch=None):
    reader = spark.readStream.schema(schemas.TRANSACTIONS)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(source)


def test_restarted_stream_equals_an_unbroken_one(spark, frame, tmp_path):
    """Three files, one a batch; the last repeats ids of the second, and rows of the first on another day."""
    parts, owners = batches()
    moved = [(*r[:9], r[9] + 40 * 24 * HOUR) for r in parts[0] if r[7] == "PENDING" and r[1] in owners][:3]
    conflicting = [(9000, 1, *moved[0][2:]), (9000, 2, *moved[0][2:])]
    truth = sequential(parts, owners)
    parts[2] = parts[2] + moved + conflicting
    accounts = frame(list(owners.items()), ACCOUNTS)
    source, store, unbroken = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "unbroken")
    for number, rows in enumerate(parts):
        frame(rows, schemas.TRANSACTIONS).coalesce(1).write.mode("append").parquet(source)
        if number:
            ingest.start_scoring(_stream(spark, source, 1), accounts, store, AS_OF).awaitTermination()
    ingest.start_scoring(_stream(spark, source, 1), accounts, unbroken, AS_OF).awaitTermination()
    assert outputs(spark, store) == outputs(spark, unbroken)
    found = ingest.read_output(spark, store, "transactions").collect()
    assert {r.transaction_id: r.risk_score for r in found} == truth
    refused = {(r.transaction_id, r.reason) for r in ingest.read_output(spark, store, "refused").filter("batch_id = 2").collect()}
    assert refused >= {(r[0], "already stored") for r in moved} | {(9000, "conflicting repeat")}
    assert ingest.whole_batches(spark, store, ingest.SCORING).count() == 3


def test_ids_of_a_base_are_state_of_the_stream(spark, frame, tmp_path):
    parts, owners = batches()
    accounts, source, store = frame(list(owners.items()), ACCOUNTS), str(tmp_path / "in"), str(tmp_path / "store")
    known = [r for r in parts[0] if r[7] == "PENDING" and r[1] in owners]
    base = ingest.Base(frame(known, schemas.TRANSACTIONS))
    frame(parts[1] + known[:5], schemas.TRANSACTIONS).coalesce(1).write.parquet(source)
    ingest.start_scoring(_stream(spark, source), accounts, store, AS_OF, base).awaitTermination()
    refused = {r.transaction_id for r in ingest.read_output(spark, store, "refused").filter("reason = 'already stored'").collect()}
    assert refused == {r[0] for r in known[:5]}
    truth = sequential(parts[:2], owners)
    found = {r.transaction_id: r.risk_score for r in ingest.read_output(spark, store, "transactions").collect()}
    assert found == {i: s for i, s in truth.items() if i not in {r[0] for r in known}}


def test_a_stream_goes_on_from_a_compacted_base(spark, frame, tmp_path):
    parts, owners = batches()
    accounts, source, store = frame(list(owners.items()), ACCOUNTS), str(tmp_path / "in"), str(tmp_path / "store")
    truth, base = sequential(parts, owners), None
    repeated = [r for r in parts[0] if r[7] == "PENDING" and r[1] in owners][:4]
    parts[2] = parts[2] + repeated
    for number, rows in enumerate(parts):
        frame(rows, schemas.TRANSACTIONS).coalesce(1).write.mode("append").parquet(source)
        if number == 2:
            base = ingest.compact(spark, store, 2, str(tmp_path / "base"))
        ingest.start_scoring(_stream(spark, source, 1), accounts, store, AS_OF, base).awaitTermination()
    found = ingest.read_output(spark, store, "transactions").collect()
    assert {r.transaction_id: r.risk_score for r in found} == truth and len(found) == len(truth)
    refused = ingest.read_output(spark, store, "refused").filter("batch_id = 2 AND reason = 'already stored'").collect()
    assert {r.transaction_id for r in refused} >= {r[0] for r in repeated}


def test_settling_reads_no_stored_table(spark, frame, tmp_path):
    """The plan that looks up ids holds the arrivals, the accounts and the state; nothing of the store."""
    parts, owners = batches()
    source = str(tmp_path / "in")
    frame(parts[0], schemas.TRANSACTIONS).coalesce(1).write.parquet(source)
    rows = ingest.settled_stream(_stream(spark, source), frame(list(owners.items()), ACCOUNTS))
    text = rows._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" in text and str(tmp_path / "store") not in text
    assert set(rows.columns) == {*_stream(spark, source).columns, "held", "conflict", "known"}


def test_state_holds_blocks_of_ids(spark, frame, tmp_path):
    """Neighbouring, scattered, negative and absent ids over three batches; a refused or differing id is not stored."""
    like = next(r for r in batches()[0][0] if r[7] == "PENDING")
    made = lambda i, more=0, status="PENDING": (i, 1, like[2], like[3] + more, *like[4:7], status, *like[8:])
    known = [*range(1000, 1060), -1, -1025, 1 << 40, None]
    first = [made(i) for i in known] + [made(7, status="DECLINED"), made(8), made(8, 6), made(9), made(9)]
    again = [made(i) for i in [*known, 7, 8, 9, 1060]]
    accounts, source, store = frame([(1, 1)], ACCOUNTS), str(tmp_path / "in"), str(tmp_path / "store")
    for rows in (first, again, again):
        frame(rows, schemas.TRANSACTIONS).coalesce(1).write.mode("append").parquet(source)
        ingest.start_scoring(_stream(spark, source, 1), accounts, store, AS_OF).awaitTermination()
    stored = ingest.read_output(spark, store, "transactions").select("transaction_id", "batch_id").collect()
    assert sorted(map(tuple, stored), key=str) == sorted([(i, 0) for i in [*known, 9]] + [(i, 1) for i in (7, 8, 1060)], key=str)
    refused = {(r.transaction_id, r.batch_id, r.reason) for r in ingest.read_output(spark, store, "refused").collect()}
    late = {(i, 1, "already stored") for i in [*known, 9]} | {(i, 2, "already stored") for i in [*known, 7, 8, 9, 1060]}
    assert refused == late | {(7, 0, "not pending"), (8, 0, "conflicting repeat")}


def test_state_is_looked_up_by_blocks(spark, frame, tmp_path):
    """A batch of neighbouring ids reads and writes a few entries of state, not one an id."""
    like = next(r for r in batches()[0][0] if r[7] == "PENDING")
    rows = [(i, 1, *like[2:]) for i in range(5000)]
    accounts, source, store = frame([(1, 1)], ACCOUNTS), str(tmp_path / "in"), str(tmp_path / "store")
    frame(rows, schemas.TRANSACTIONS).coalesce(1).write.parquet(source)
    stream = ingest.start_scoring(_stream(spark, source), accounts, store, AS_OF)
    stream.awaitTermination()
    assert ingest.read_output(spark, store, "transactions").count() == 5000
    assert 0 < stream.lastProgress["stateOperators"][0]["numRowsUpdated"] <= 10
