"""Merkle manifest of a dataset: a digest tree for each group of rows, a tree over the groups, and inclusion proofs.

Every row's fields are hashed to a leaf.  The leaves of a group in order, then the nodes of each level, are hashed in
runs of ``FAN`` until one node is left, the group's subroot; subroots in the order of their groups give the root in the
same way.

A block of ``BLOCK`` consecutive nodes, aligned to whole subtrees, keeps each of its levels as one string of
concatenated hex digests.  Fixed-width substrings of a level are hashed to the next one; the substrings on both sides of
a node within its run are its siblings.  The tops of a group's blocks are the nodes of the next round, so every round
shrinks the data by ``BLOCK`` and a group of any size is spread over its blocks.  Proofs are put together from the
topmost round down, block by block.

Places come from a range sort: a row's place is its number in its partition, plus the group's rows in earlier
partitions, which are known from one small row per partition and group.

A null field is hashed as ``-``, a text of any length whole.  Null groups come first, then groups by the bytes of their
UTF-8 text; null ids come first in their group.  Rows that share an id are separate leaves, ordered by their digests.  An
empty table has no leaves and gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.shared import fresh, stored

FAN = 3
#: Levels that one round settles, and nodes of a block: its first level is a string of 64 x 243 characters.
STEPS = 5
BLOCK = FAN**STEPS
HEX = 64

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """A value as it enters a leaf: its bytes behind their number."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _lot(group: Column) -> Column:
    """A group as text that is never null and sorts null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a column ``lot``) and two longs: ``place`` within the lot by ``order``, and ``n``, the lot's rows.

    ``rows`` are sorted by range, so a lot of any size is spread.  They must come from a stored table.
    """
    number = F.monotonically_increasing_id()  # partition << 33 | place in the sorted partition
    ranged = rows.repartitionByRange("lot", *order).sortWithinPartitions("lot", *order).withColumn("number", number)
    ranged = stored(ranged, "ranged").withColumn("part", F.shiftright("number", 33))
    parts = ranged.groupBy("lot", "part").agg(F.min("number").alias("first"), F.count("*").alias("rows"))
    lot = Window.partitionBy("lot")
    earlier = lot.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.select(
        "lot", "part", (F.sum("rows").over(earlier) - F.col("rows") - F.col("first")).alias("shift"), F.sum("rows").over(lot).alias("n")
    )
    return ranged.join(parts, ["lot", "part"]).withColumn("place", F.col("number") + F.col("shift")).drop("part", "number", "shift")


def _hashed(level: Column) -> Column:
    """The level above a level: digests of its runs, each a substring of fixed width."""
    width = FAN * HEX
    starts = F.sequence(F.lit(1), F.length(level), F.lit(width))
    return F.array_join(F.transform(starts, lambda at: F.sha2(F.substr(level, at, F.lit(width)), 256)), "")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of nodes ``lot, place, n, hash`` with other columns: ``lot, block, n, members, levels, top``."""
    others = [c for c in nodes.columns if c not in ("lot", "place", "n", "hash")]
    members = F.array_sort(F.collect_list(F.struct("place", "hash", *others))).alias("members")
    # A lot of one block stops at its last node; in larger lots every block, the last one too, goes up all steps.
    steps = sum((F.col("n") > FAN**j).cast("int") for j in range(STEPS))
    lowest = F.array_join(F.transform("members", lambda m: m["hash"]), "")
    levels = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
        F.array(lowest),
        lambda known, _: F.concat(known, F.array(_hashed(F.element_at(known, -1)))),
    )
    return (
        nodes.withColumn("block", F.expr(f"place div {BLOCK}"))
        .groupBy("lot", "n", "block")
        .agg(members)
        .withColumn("levels", levels)
        .withColumn("top", F.element_at("levels", -1))
    )


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Stored blocks of every round, the lowest first; the last round has one block for each lot."""
    rounds = [stored(_blocks(nodes), "blocks")]
    most = rounds[0].agg(F.max("n")).first()[0] or 0
    while most > BLOCK:
        most = -(-most // BLOCK)
        above = F.ceil(F.col("n") / BLOCK).cast("long").alias("n")
        rounds.append(stored(_blocks(rounds[-1].select("lot", F.col("block").alias("place"), above, F.col("top").alias("hash"))), "blocks"))
    return rounds


def _siblings(levels: Column, place: Column) -> Column:
    """What stands before and after a node in its run, on every level of its block."""
    powers = F.array(*[F.lit(FAN**j) for j in range(STEPS + 1)])

    def run(step: Column) -> Column:
        at = F.floor(F.pmod(place, F.lit(BLOCK)) / F.get(powers, step)).cast("int")
        inside = at % FAN
        level = F.get(levels, step)
        before = F.substr(level, (at - inside) * HEX + 1, inside * HEX)
        after = F.substr(level, (at + 1) * HEX + 1, (FAN - 1 - inside) * HEX)
        return F.struct(before.alias("before"), after.alias("after"))

    steps = F.size(levels) - 1
    return F.when(steps > 0, F.transform(F.sequence(F.lit(0), steps - 1), run)).otherwise(F.array().cast(PATH))


def descend(rounds: list[DataFrame], above: DataFrame, carried: list[str]) -> DataFrame:
    """The nodes of the lowest round with their ``path`` to the root.

    ``above``: for every lot one row ``lot, place`` = 0, its own ``path`` and the ``carried`` columns.
    """
    for blocks in reversed(rounds):
        known = above.select("lot", F.col("place").alias("block"), F.col("path").alias("upper"), *carried)
        names = [f.name for f in blocks.schema["members"].dataType.elementType]
        member = lambda m: F.struct(
            *[m[c].alias(c) for c in names], F.concat(_siblings(F.col("levels"), m["place"]), F.col("upper")).alias("path")
        )
        above = blocks.join(known, ["lot", "block"]).select("lot", *carried, F.inline(F.transform("members", member)))
    return above


def fold(start: Column, path: Column) -> Column:
    """Root that follows from a leaf and its path."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def manifest(leaves: DataFrame) -> DataFrame:
    """Columns of ``leaves`` (``doc_id``, ``lot``, ``hash`` and others) with ``path, subroot, root``.

    ``lot`` is the group as ``_lot`` writes it; ``path`` lists, from the leaf up, what stands before and after each
    node in its run.
    """
    others = [c for c in leaves.columns if c not in ("lot", "hash")]
    # Equal rows may change places; their numbers let the range sort spread them.
    row = fresh("row", leaves.columns)
    numbered = stored(leaves.withColumn(row, F.monotonically_increasing_id()), "leaves")
    rounds = climb(placed(numbered, ["doc_id", "hash", *[c for c in others if c != "doc_id"], row]).drop(row))
    tops = rounds[-1].select(F.lit("").alias("lot"), F.col("top").alias("hash"), F.col("lot").alias("member"))
    upper = climb(placed(tops, ["member"]))
    roots = upper[-1].select("lot", F.lit(0).cast("long").alias("place"), F.array().cast(PATH).alias("path"), F.col("top").alias("root"))
    lots = descend(upper, roots, ["root"]).select(
        F.col("member").alias("lot"), F.lit(0).cast("long").alias("place"), "path", F.col("hash").alias("subroot"), "root"
    )
    found = descend(rounds, lots, ["subroot", "root"])
    return found.select(*others, "lot", "hash", "path", "subroot", "root")


def document_leaves(docs: DataFrame, tampered: Callable[[Column], Column] | None = None) -> DataFrame:
    """``doc_id, lot, hash`` and, where a second state of the text is given, that state's leaf as ``seen``.

    ``tampered`` maps the text column to the text that is found later; null where nothing was touched.
    """
    columns = [F.col(c) for c in FIELDS]
    seen = tampered(F.col("text")) if tampered else F.lit(None).cast("string")
    again = F.when(seen.isNotNull(), leaf(*columns[:-1], seen))
    return docs.select("doc_id", _lot(F.col("source")).alias("lot"), leaf(*columns).alias("hash"), again.alias("seen"))


def _line_breaks_lost(text: Column) -> Column:
    """Text without its line breaks in the documents that the contract tampers with, else null."""
    touched = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(touched, F.replace(text, F.lit("\n"), F.lit("")))


def verified(docs: DataFrame, tampered: Callable[[Column], Column] = _line_breaks_lost) -> DataFrame:
    """Proof and verdict for every document, judged in the state that ``tampered`` leaves it in."""
    found = manifest(document_leaves(docs, tampered))
    segments = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    folded = found.withColumn("folded_root", fold(F.coalesce("seen", "hash"), F.col("path")))
    return folded.select(
        "doc_id",
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        F.sha2(segments, 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
