"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

Every row gets its text's digest and a run number; a run is written sorted by digest.  Runs are merged in
rounds as in a binomial tree, ``2 ** bits`` partners at a time: runs whose numbers differ only in the lowest
bits still apart merge into one, and each merge keeps, per digest, the row to retain and the number of rows.
A group of equal texts of any size is therefore spread over all runs, and a merge sees at most one entry per
partner.  What the root decides goes down the same tree.

Equal means: same SHA-256, same number of bytes and same 64-bit second hash; all three are keys of every merge,
so an entry joins only entries that pass the check.

A round sorts its entries again, so it depends on the runs' numbers but not on their order, and a lost part of a run
can be written anew in any order.

Null text counts as empty, texts of any length are hashed whole, and an empty table gives no rows.  A null ``doc_id`` is smaller than any other.  Rows that share ``doc_id`` and text
are separate documents in the counts; exactly one of them can be kept.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.shared import fresh, stored, whole_text

#: Runs, and bits of the run number that one round settles.
RUN_BITS = 12
ROUND_BITS = 6

KEY = ["digest", "n_bytes", "second"]


def digests(text: Column) -> dict[str, Column]:
    return {"digest": F.unhex(F.sha2(text, 256)), "n_bytes": F.octet_length(text).cast("long"), "second": F.xxhash64(text)}


def _merged(entries: DataFrame, keep: str, bits: int) -> DataFrame:
    """One round: entries of runs that agree but for the lowest bits become one entry per text."""
    best = F.max if keep == "largest" else F.min
    return (
        entries.withColumn("run", F.shiftright("run", bits))
        .groupBy(*KEY, "run")
        .agg(best("keeper").alias("keeper"), F.sum("n").alias("n"))
    )


def exact_groups(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` and ``n_bytes, second``, one row per document.

    ``keep``: the ``largest`` or ``smallest`` doc_id of equal texts stays.
    """
    # Nulls sort first in Spark, so a null id is the smallest under either rule.
    rows = docs.select("doc_id", whole_text().alias("text")).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), *[c.alias(n) for n, c in digests(F.col("text")).items()]
    )
    runs = stored(
        rows.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(1 << RUN_BITS)).cast("int")).sortWithinPartitions(*KEY),
        "digest-runs",
    )
    entry = F.struct("doc_id", "row").alias("keeper")
    levels = [stored(_merged(runs.select(*KEY, "run", entry, F.lit(1).cast("long").alias("n")), keep, 0), "digest-level")]
    for _ in range(0, RUN_BITS, ROUND_BITS):
        levels.append(stored(_merged(levels[-1], keep, ROUND_BITS), "digest-level"))
    # Texts that occur once are settled; the rest go down the tree, one level at a time.
    decided = levels[-1].where("n > 1").drop("run").withColumn("above", F.lit(0))
    for level in reversed(levels[:-1]):
        decided = (
            level.select(*KEY, "run", F.shiftright("run", ROUND_BITS).alias("above"))
            .join(decided, [*KEY, "above"])
            .drop("above")
            .withColumnRenamed("run", "above")
        )
    return runs.join(decided.withColumnRenamed("above", "run"), [*KEY, "run"], "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keeper.row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n_bytes",
        "second",
    )


def without_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = exact_groups(docs, keep).where("kept")
    names = {n: fresh(n, docs.columns) for n in ("id", "no_id", "sha", "bytes", "second", "rank")}
    identity = lambda sha, size, second: [
        F.coalesce("doc_id", F.lit(0)).alias(names["id"]),
        F.col("doc_id").isNull().alias(names["no_id"]),
        sha.alias(names["sha"]),
        size.alias(names["bytes"]),
        second.alias(names["second"]),
    ]
    on = [names[n] for n in ("id", "no_id", "sha", "bytes", "second")]
    text = whole_text()
    marked = docs.select("*", *identity(F.sha2(text, 256), F.octet_length(text).cast("long"), F.xxhash64(text)))
    stay = marked.join(kept.select(*identity(F.col("text_sha256"), F.col("n_bytes"), F.col("second"))), on, "left_semi")
    first = F.row_number().over(Window.partitionBy(*on).orderBy(*on[:1]))  # rows equal in id and text: one stays
    return stay.withColumn(names["rank"], first).where(F.col(names["rank"]) == 1).select(*docs.columns)
