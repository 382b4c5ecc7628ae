"""Micro-batch jobs: score arriving transactions, log status changes.

Every output lies in ``<store>/<name>/batch_id=<n>``.  A batch looks only at stored rows of smaller
batch ids and overwrites its own folder, so a replayed batch writes the same rows again.  A batch's
last act is its mark in ``<store>/whole-<job>``; readers see only batches that have one, and so all
outputs of a batch or none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from vigil.functions.columns import decide
from vigil.operators.activity import minute
from vigil.operators.keyed import one_per_key, settled, update_columns
from vigil.plans.decisions import arrival_outputs
from vigil.plans.scoring import history_around, transaction_scores
from vigil.session import exists, remove
from vigil.sources.layout import write_transactions

STORED_TRANSACTIONS = (
    "transaction_id bigint, account_id bigint, card_id bigint, amount decimal(15,2), currency string,"
    " merchant_category string, merchant_country string, status string, risk_score int,"
    " transaction_at timestamp_ntz, tx_date date, batch_id bigint"
)
STORED_CHANGES = (
    "transaction_id bigint, seq int, old_status string, new_status string, changed_by string,"
    " changed_at timestamp_ntz, batch_id bigint"
)
ALERT_OUTPUT = (
    "transaction_id bigint, rule_id int, reason string, risk_score int, alert_status string,"
    " created_at timestamp_ntz, source string, batch_id bigint"
)
DELTA_OUTPUT = "transaction_id bigint, account_id bigint, delta decimal(15,2), batch_id bigint"
REFUSED_OUTPUT = "transaction_id bigint, status string, reason string, batch_id bigint"

OUTPUT_SCHEMAS = {
    "transactions": STORED_TRANSACTIONS,
    "history": STORED_CHANGES,
    "alerts": ALERT_OUTPUT,
    "balance_deltas": DELTA_OUTPUT,
    "refused": REFUSED_OUTPUT,
    "status_changes": STORED_CHANGES,
    "change_deltas": DELTA_OUTPUT,
    "change_refused": REFUSED_OUTPUT,
}


SCORING, CHANGES = "scoring", "changes"
JOBS = dict.fromkeys(OUTPUT_SCHEMAS, SCORING) | dict.fromkeys(("status_changes", "change_deltas", "change_refused"), CHANGES)
MARK = "marked boolean, batch_id bigint"


def whole_batches(spark: SparkSession, store: str, job: str) -> DataFrame:
    """``batch_id`` of every batch of a job that wrote all its outputs."""
    folder = f"{store}/whole-{job}"
    if not exists(spark, folder):
        return spark.createDataFrame([], "batch_id bigint")
    # The condition holds always; it tells the planner that these rows may prune the partitions of others.
    return spark.read.schema(MARK).parquet(folder).filter("batch_id >= 0").select("batch_id")


def _mark(spark: SparkSession, store: str, job: str, batch_id: int) -> None:
    mark = spark.range(1).select(F.lit(True).alias("marked"))
    mark.write.mode("overwrite").parquet(f"{store}/whole-{job}/batch_id={batch_id}")


def _unmark(spark: SparkSession, store: str, job: str, batch_id: int) -> None:
    """A batch that is written again is not whole until it has been."""
    remove(spark, f"{store}/whole-{job}/batch_id={batch_id}")


def read_output(spark: SparkSession, store: str, name: str) -> DataFrame:
    """Rows of the whole batches of an output."""
    if not exists(spark, f"{store}/{name}"):
        return spark.createDataFrame([], OUTPUT_SCHEMAS[name])
    rows = spark.read.schema(OUTPUT_SCHEMAS[name]).parquet(f"{store}/{name}")
    # One row a batch; the join leaves out the folders of other batches before they are read.
    return rows.join(F.broadcast(whole_batches(spark, store, JOBS[name])), "batch_id", "left_semi").select(*rows.columns)


def read_batch(spark: SparkSession, store: str, name: str, batch_id: int) -> DataFrame:
    """One batch of an output, from its own folder."""
    reader = spark.read.schema(OUTPUT_SCHEMAS[name]).option("basePath", f"{store}/{name}")
    return reader.parquet(f"{store}/{name}/batch_id={batch_id}")


def _write(rows: DataFrame, store: str, name: str, batch_id: int, by: str | None = None) -> None:
    """Rebalancing joins small partitions and splits large ones, also one hot value of ``by``."""
    balanced = rows.hint("rebalance", by) if by else rows.hint("rebalance")
    writer = balanced.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(by)
    writer.parquet(f"{store}/{name}/batch_id={batch_id}")


class Base(NamedTuple):
    """Transactions stored before the stream, or compacted from its batches below ``batches``."""

    transactions: DataFrame
    batches: int = 0


def _stored_before(
    spark: SparkSession, store: str, batch_id: int, base: Base | None
) -> DataFrame | None:
    """All transactions stored before this batch; the first batch without a base has none."""
    first = base.batches if base else 0
    columns = ["transaction_id", "account_id", "amount", "status", "transaction_at", "tx_date"]
    parts = []
    if batch_id > first:
        parts.append(
            read_output(spark, store, "transactions").filter(
                F.col("batch_id").between(first, batch_id - 1)
            )
        )
    if base:
        rows = base.transactions
        if "tx_date" not in rows.columns:
            rows = rows.withColumn("tx_date", F.to_date("transaction_at"))
        parts.append(rows)
    return reduce(DataFrame.unionByName, (p.select(*columns) for p in parts)) if parts else None


def _judged(rows: DataFrame) -> DataFrame:
    """Settled arrivals with ``reason``: why a row is refused, NULL where it is not."""
    return rows.withColumn(
        "reason",
        F.when(F.col("conflict"), "conflicting repeat")
        .when(~F.col("status").eqNullSafe("PENDING"), "not pending")
        .when(F.col("held").isNull(), "unknown account")
        .when(F.col("known"), "already stored"),
    )


def score_batch(
    batch: DataFrame,
    batch_id: int,
    accounts: DataFrame,
    store: str,
    as_of: str,
    base: Base | None = None,
) -> None:
    """Score one batch of arrivals against what is stored and against itself.

    Arrivals are new, PENDING and of a known account; others go to ``refused``, as do all rows of an id
    whose rows differ.  For a batch that comes without a stream, ids are looked for among all stored rows,
    whatever their day; the batch's smallest and largest id let the scan skip files.  Later batches do not
    rescore rows.
    """
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        keys = accounts.select("account_id", F.lit(True).alias("held"))
        judged = settled(batch, "transaction_id").join(keys, "account_id", "left")
        before = _stored_before(spark, store, batch_id, base)
        if before is not None:
            least, most = batch.agg(F.min("transaction_id"), F.max("transaction_id")).first()
            seen = before.filter(F.col("transaction_id").between(least, most)).select("transaction_id")
            judged = judged.join(seen.distinct().withColumn("known", F.lit(True)), "transaction_id", "left")
        else:
            judged = judged.withColumn("known", F.lit(None).cast("boolean"))
        _score(judged, batch.columns, batch_id, accounts, before, store, as_of)
    finally:
        batch.unpersist()


def _score(
    settled_rows: DataFrame, columns: list[str], batch_id: int, accounts: DataFrame, before: DataFrame | None, store: str, as_of: str
) -> None:
    """Write all outputs of one batch of settled arrivals, and its mark."""
    spark = settled_rows.sparkSession
    _unmark(spark, store, SCORING, batch_id)
    # Written first: the state of a stream must be computed once, and all outputs derive from these rows.
    folder = f"{store}/judged/batch_id={batch_id}"
    rows = _judged(settled_rows)
    rows.write.mode("overwrite").parquet(folder)
    judged = spark.read.schema(rows.schema).parquet(folder)
    fresh = judged.filter("reason IS NULL").select(*columns)
    if before is not None:
        before = history_around(fresh, before, accounts)
    others = [c for c in columns if c not in ("transaction_id", "risk_score", "status")]
    decided = (
        transaction_scores(fresh, accounts, before, others)
        .drop("customer_id", "daily_volume", "recent_count")
        .withColumn("status", decide(F.col("risk_score")))
        .withColumn("tx_date", F.to_date("transaction_at"))
    )
    _write(decided, store, "transactions", batch_id, by="tx_date")

    # The rest derives from the rows just written, not from a second computation of them.
    own = read_batch(spark, store, "transactions", batch_id)
    for name, output in arrival_outputs(own, as_of)._asdict().items():
        _write(output, store, name, batch_id)
    refused = judged.filter("reason IS NOT NULL").select("transaction_id", "status", "reason")
    _write(refused, store, "refused", batch_id)
    _mark(spark, store, SCORING, batch_id)
    remove(spark, folder)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Neighbouring ids that share one entry of a stream's state, as a power of two, and groups that entries are dealt over.
BLOCK_BITS, GROUPS = 10, 1 << 12
#: Rows, and bytes of them, that a task packs at a time.
PACK_ROWS, PACK_BYTES = 1 << 16, 32 << 20


def _block() -> Column:
    return F.shiftright("transaction_id", BLOCK_BITS)


def _group() -> Column:
    return F.pmod(F.xxhash64(_block()), F.lit(GROUPS)).cast("int").alias("id_group")


# The functions that run in tasks are built by others, so that they reach the workers with the query and need
# nothing of this package there.


def _packing() -> Callable:
    """Rows of a task as one row per ``id_group``, with the other columns as an Arrow stream."""
    most_rows, most_bytes = PACK_ROWS, PACK_BYTES

    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).sort_by("id_group")
        groups = table["id_group"].to_numpy()
        rows = table.drop_columns(["id_group"]).combine_chunks()
        starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
        streams = []
        for start, end in zip(starts, [*starts[1:], len(groups)], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as out:
                out.write_table(rows.slice(start, end - start))
            streams.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_pydict({"id_group": pa.array(groups[starts], pa.int32()), "rows": pa.array(streams, pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n, size = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= most_rows or size >= most_bytes:
                yield packed(waiting)
                waiting, n, size = [], 0, 0
        if waiting:
            yield packed(waiting)

    return pack


def _unpacking() -> Callable:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column("rows"):
                yield from pa.ipc.open_stream(rows.as_buffer())

    return unpack


def _settling():
    """Stateful processor that settles the packed arrivals of a group of ids and remembers which of them were stored.

    The state of a block of neighbouring ids is one entry with a bit an id, read and written once a batch.
    """
    bits, most_rows = BLOCK_BITS, PACK_ROWS
    mask = (1 << bits) - 1

    class Settling(StatefulProcessor):
        def init(self, handle) -> None:
            self.stored = handle.getMapState("stored", "block bigint", "places binary")

        def read(self, block: int | None) -> np.ndarray:
            value = self.stored.getValue((block,))
            known = (bytes(value[0]) if value else b"").ljust((mask + 1) // 8, b"\0")
            return np.unpackbits(np.frombuffer(known, np.uint8), bitorder="little").astype(bool)

        def write(self, block: int | None, places: np.ndarray) -> None:
            self.stored.updateValue((block,), (np.packbits(places, bitorder="little").tobytes().rstrip(b"\0"),))

        def settle(self, parts: list[pa.Table]) -> pa.Table:
            """One row an id: the smallest, and whether another differs from it."""
            table = pa.concat_tables(parts).combine_chunks()
            number = table["transaction_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            many = np.bincount(number)[number] > 1
            if not many.any():
                return table
            order = lambda row: [(value is not None, value) for value in row]
            at = np.flatnonzero(many)
            repeated = table.take(at)
            conflicts = repeated["conflict"].to_pylist()
            least, differing = {}, set()
            for place, row in enumerate(zip(*(c.to_pylist() for c in repeated.drop_columns(["conflict"]).columns), strict=True)):
                key = number[at[place]]
                held, first = least.setdefault(key, (place, row))
                if conflicts[place] or row != first:
                    differing.add(key)
                    least[key] = min((held, first), (place, row), key=lambda x: order(x[1]))
            kept = np.sort(np.r_[np.flatnonzero(~many), at[[place for place, _ in least.values()]]])
            table = table.take(kept)
            conflict = np.array(table["conflict"]) | np.isin(number[kept], list(differing))
            return table.set_column(table.column_names.index("conflict"), "conflict", pa.array(conflict, pa.bool_()))

        def handleInputRows(self, key, rows, timers):
            parts, n = [], 0
            for packed in rows:
                part = pa.ipc.open_stream(bytes(packed["rows"])).read_all()
                parts.append(part.append_column("conflict", pa.array(np.zeros(len(part), bool))))
                n += len(part)
                if n >= 2 * most_rows:  # repeats don't wait for the end of the group
                    parts = [self.settle(parts)]
                    n = 0
            table = self.settle(parts)
            ids = table["transaction_id"]
            absent, numbers = np.array(ids.is_null()), ids.fill_null(0).to_numpy()
            fit = np.array(pc.fill_null(pc.and_(pc.equal(table["status"], "PENDING"), table["held"]), False)) & ~np.array(table["conflict"])
            known = np.zeros(len(table), bool)
            blocks, places = numbers >> bits, numbers & mask
            present = np.flatnonzero(~absent)
            present = present[np.argsort(blocks[present], kind="stable")]
            entries = np.split(present, np.flatnonzero(np.diff(blocks[present])) + 1)
            for at in filter(len, [*entries, np.flatnonzero(absent)]):
                block = None if absent[at[0]] else int(blocks[at[0]])
                before = self.read(block)
                known[at] = before[places[at]]
                after = before.copy()
                after[places[at[fit[at]]]] = True
                if (after != before).any():
                    self.write(block, after)
            table = table.append_column("known", pa.array(known))
            for start in range(0, len(table), most_rows):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema) as out:
                    out.write_table(table.slice(start, most_rows))
                yield Row(rows=sink.getvalue().to_pybytes())

        def handleInitialState(self, key, row, timers) -> None:
            places = np.zeros(mask + 1, bool)
            places[row["places"]] = True
            self.write(row["block"], places)

        def close(self) -> None:
            pass

    return Settling()


def settled_stream(arrivals: DataFrame, accounts: DataFrame, base: Base | None = None) -> DataFrame:
    """A stream's arrivals, one row an id in every batch, with ``held``, ``conflict`` and ``known``.

    Which ids were stored is kept as state, in blocks of neighbouring ids, so a batch looks up the blocks of its
    own ids alone, whatever the store holds.  Rows are dealt by groups of blocks and reach the state packed, many
    at a time.  The ids of a base that the stream begins with become state once, in its first batch.
    """
    columns = arrivals.columns
    held = arrivals.join(accounts.select("account_id", F.lit(True).alias("held")), "account_id", "left").select(*columns, "held")
    kind = StructType([*held.schema.fields, StructField("conflict", BooleanType()), StructField("known", BooleanType())])
    initial = None
    if base:
        place = F.coalesce(F.col("transaction_id").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)), F.lit(0)).cast("int")
        blocks = base.transactions.groupBy(_group(), _block().alias("block")).agg(F.collect_set(place).alias("places"))
        initial = blocks.groupBy("id_group")
    dealt = held.select("*", _group()).repartition("id_group").mapInArrow(_packing(), "id_group int, rows binary")
    settled_rows = dealt.groupBy("id_group").transformWithState(_settling(), "rows binary", "Append", "None", initial)
    return settled_rows.mapInArrow(_unpacking(), kind)


def compact(spark: SparkSession, store: str, batches: int, folder: str) -> Base:
    """Fold the transactions of the first batches into one laid-out table, so that later batches
    list and open few files.  Restart the stream with the result as its base."""
    rows = read_output(spark, store, "transactions").filter(F.col("batch_id") < batches)
    write_transactions(rows.drop("batch_id", "tx_date"), folder)
    return Base(spark.read.parquet(folder), batches)


def _start(
    stream: DataFrame, store: str, name: str, run: Callable[[DataFrame, int], None], every: str | None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(run).option(
        "checkpointLocation", f"{store}/checkpoint-{name}"
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    conf = stream.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ROCKS_DB)  # a query takes the setting with it when it starts
    try:
        return writer.trigger(**trigger).start()
    finally:
        conf.set(STATE_STORE, before)


def start_scoring(
    arrivals: DataFrame,
    accounts: DataFrame,
    store: str,
    as_of: str,
    base: Base | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Score a stream of arriving transactions; outputs are read with ``read_output``.

    Runs on at the given interval (``every="1 minute"``), or else stops when all that is available
    has been read.  Which ids are stored is the stream's own state, kept in its checkpoint; rows are refused
    as in ``score_batch``.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        before = _stored_before(batch.sparkSession, store, batch_id, base)
        _score(batch, arrivals.columns, batch_id, accounts, before, store, as_of)

    return _start(settled_stream(arrivals, accounts, base), store, SCORING, run, every)


def ledger_balances(accounts: DataFrame, deltas: DataFrame) -> DataFrame:
    """Opening balances plus all deltas, each transaction counted once.

    A stream cannot turn a whole batch down, so an overdrawn account shows a negative balance and is
    marked.
    """
    once = one_per_key(deltas.select("transaction_id", "account_id", "delta"), "transaction_id")
    sums = once.groupBy("account_id").agg(F.sum("delta").alias("delta"))
    balance = (F.col("balance") + F.coalesce("delta", F.lit(0))).cast("decimal(25,2)")
    return accounts.join(sums, "account_id", "left").select(
        *(c for c in accounts.columns if c != "balance"),
        balance.alias("balance"),
        (balance < 0).alias("overdrawn"),
    )


def _with_previous(changes: DataFrame) -> DataFrame:
    """Add ``previous`` status and ``seq`` within the batch, in time order per transaction.

    In two levels, so that the changes of one busy transaction spread over its minutes: a minute
    starts with the last status and the number of changes of the minutes before it.
    """
    order = ["changed_at", "status"]
    changes = changes.select(
        "transaction_id", "status", "changed_by", "changed_at", minute("changed_at").alias("cell")
    )
    cells = changes.groupBy("transaction_id", "cell").agg(
        F.count("*").alias("n"), F.max_by("status", F.struct(*order)).alias("last")
    )
    over_cells = Window.partitionBy("transaction_id").orderBy("cell")
    before = F.sum("n").over(over_cells.rowsBetween(Window.unboundedPreceding, -1))
    starts = cells.select(
        "transaction_id",
        "cell",
        F.lag("last").over(over_cells).alias("first_previous"),
        F.coalesce(before, F.lit(0)).alias("earlier"),
    )
    in_cell = Window.partitionBy("transaction_id", "cell").orderBy(*order)
    return (
        changes.join(starts, ["transaction_id", "cell"])
        .withColumn("place", F.row_number().over(in_cell))
        .withColumn(
            "previous",
            F.when(F.col("place") == 1, F.col("first_previous")).otherwise(
                F.lag("status").over(in_cell)
            ),
        )
        .withColumn("seq", (F.col("earlier") + F.col("place")).cast("int"))
        .drop("cell", "place", "earlier", "first_previous")
    )


class ChangeBase(NamedTuple):
    """Latest status and sequence number per transaction, from batches below ``batches``."""

    latest: DataFrame
    batches: int


def _latest(spark: SparkSession, store: str, below: int, compacted: ChangeBase | None) -> DataFrame | None:
    """Latest status and number per transaction that the log has before batch ``below``."""
    first = compacted.batches if compacted else 0
    parts = []
    if below > first:
        logged = read_output(spark, store, "status_changes").filter(F.col("batch_id").between(first, below - 1))
        parts.append(logged.select("transaction_id", F.col("new_status").alias("status"), "seq"))
    if compacted:
        parts.append(compacted.latest)
    if not parts:
        return None
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("transaction_id")
        .agg(F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq"))
    )


def compact_changes(
    spark: SparkSession, store: str, batches: int, folder: str, compacted: ChangeBase | None = None
) -> ChangeBase:
    """Fold the log of the first batches into one row per transaction, which later batches read instead."""
    latest = _latest(spark, store, batches, compacted)
    latest.repartitionByRange("transaction_id").sortWithinPartitions("transaction_id").write.parquet(folder)
    return ChangeBase(spark.read.schema(latest.schema).parquet(folder), batches)


def log_changes_batch(
    batch: DataFrame,
    batch_id: int,
    base: DataFrame,
    store: str,
    logged: DataFrame | None = None,
    compacted: ChangeBase | None = None,
) -> None:
    """Log status changes of one batch against the latest known status of each transaction.

    ``batch`` has transaction_id, status, changed_by and changed_at.  Several changes of one
    transaction follow each other by time; repeating a status logs nothing.  Numbers go on from the log's
    largest, and from that of ``logged``, a log kept elsewhere (transaction_id, seq).  Changes of ids that
    ``base`` lacks go to ``change_refused``.  A change to APPROVED deducts: its amount goes to
    ``change_deltas`` if ``base`` has account_id and amount.
    """
    spark = batch.sparkSession
    _unmark(spark, store, CHANGES, batch_id)
    ids = batch.select("transaction_id").distinct()
    money = [c for c in ("account_id", "amount") if c in base.columns]
    known = base.select("transaction_id", "status", *money).join(ids, "transaction_id", "left_semi")
    known = known.withColumn("had", F.lit(0))
    if logged is not None:
        numbers = logged.join(ids, "transaction_id", "left_semi").groupBy("transaction_id").agg(F.max("seq").alias("had"))
        known = update_columns(known, numbers, "transaction_id")
    latest = _latest(spark, store, batch_id, compacted)
    if latest is not None:
        asked = latest.join(ids, "transaction_id", "left_semi")
        known = update_columns(known, asked.select("transaction_id", "status", F.col("seq").alias("had")), "transaction_id")
    changes = (
        _with_previous(batch)
        .join(known.withColumnRenamed("status", "stored_status"), "transaction_id", "left")
        .withColumn(
            "old_status",
            F.when(F.col("seq") == 1, F.col("stored_status")).otherwise(F.col("previous")),
        )
    ).persist()
    try:
        is_known = F.col("had").isNotNull()
        logs = changes.filter(is_known & ~F.col("old_status").eqNullSafe(F.col("status")))
        _write(
            logs.select(
                "transaction_id",
                (F.col("seq") + F.col("had")).cast("int").alias("seq"),
                "old_status",
                F.col("status").alias("new_status"),
                "changed_by",
                "changed_at",
            ),
            store,
            "status_changes",
            batch_id,
        )
        refused = changes.filter(~is_known).select("transaction_id", "status", F.lit("unknown transaction").alias("reason"))
        _write(refused, store, "change_refused", batch_id)
        if len(money) == 2:
            # Each change to APPROVED deducts once more, as each did when it was made.
            taken = logs.filter("status = 'APPROVED'").select(
                "transaction_id", "account_id", (-F.col("amount")).cast("decimal(15,2)").alias("delta")
            )
            _write(taken, store, "change_deltas", batch_id)
        _mark(spark, store, CHANGES, batch_id)
    finally:
        changes.unpersist()


def start_change_log(
    changes: DataFrame,
    base: DataFrame,
    store: str,
    every: str | None = None,
    logged: DataFrame | None = None,
    compacted: ChangeBase | None = None,
) -> StreamingQuery:
    """Log a stream of status changes against the statuses in ``base``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        log_changes_batch(batch, batch_id, base, store, logged, compacted)

    return _start(changes, store, CHANGES, run, every)
