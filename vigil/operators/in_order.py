"""Requests served in order from a balance: each takes its amount if the balance still holds it, else it is passed over."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import stored

BLOCK = 4_096
"""Consecutive requests of an account that are taken one by one where a phase ends among them."""

TOTAL = "decimal(38,0)"


def _half(balance: str) -> Column:
    """Largest power of two that is not above a positive balance."""
    return F.expr(f"shiftleft(1L, length(bin({balance})) - 1)")


def _numbered(requests: DataFrame) -> DataFrame:
    """Requests with ``ordinal``, their number in their account by ``place``, and ``block``.

    Sorted by range, so that a busy account is spread; its requests in earlier ranges are known from one small row
    for each.
    """
    order = ["account_id", "place"]
    ranged = requests.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("number", F.monotonically_increasing_id())
    ranged = stored(ranged, "ranged-requests").withColumn("part", F.shiftright("number", 33))
    parts = ranged.groupBy("account_id", "part").agg(F.min("number").alias("first"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("account_id").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shift = F.sum("rows").over(earlier) - F.col("rows") - F.col("first")
    parts = parts.select(F.col("account_id").alias("part_account"), "part", shift.alias("shift"))
    same = ranged["account_id"].eqNullSafe(parts["part_account"]) & (ranged["part"] == parts["part"])
    return (
        ranged.join(parts, same)
        .withColumn("ordinal", F.col("number") + F.col("shift"))
        .withColumn("block", F.call_function("div", F.col("ordinal"), F.lit(BLOCK)))
        .select(*requests.columns, "ordinal", "block")
    )


def _phases(asked: DataFrame, state: DataFrame) -> DataFrame:
    """One phase of every open account: the block in which it ends, NULL if it doesn't, and the balance there.

    In a phase the balance lies between a power of two, ``half``, and twice that.  Amounts above the balance are
    refused for good.  Light amounts, below ``half``, are all taken until the balance falls below ``half``; the first
    other amount that the balance still holds brings it below, too.  Either ends the phase.  What is taken before is
    a running sum in two levels, blocks and the rows inside, so that no task holds a whole account.
    """
    rows = asked.join(state, "account_id").filter((F.col("block") >= F.col("from_block")) & (F.col("units") <= F.col("held")))
    is_light = F.col("units") < F.col("half")
    rows = rows.withColumn("light", F.when(is_light, F.col("units")).otherwise(0).cast(TOTAL))
    blocks = rows.groupBy("account_id", "block").agg(F.sum("light").cast(TOTAL).alias("inside"))
    earlier = Window.partitionBy("account_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("account_id", "block", F.coalesce(F.sum("inside").over(earlier), F.lit(0)).cast(TOTAL).alias("taken"))
    inside = Window.partitionBy("account_id", "block").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(blocks, ["account_id", "block"]).withColumn("so_far", F.col("held") - F.col("taken") - F.sum("light").over(inside))
    ends = F.when(is_light, F.col("so_far") < F.col("half")).otherwise(F.col("units") <= F.col("so_far"))
    end = F.when(ends, F.struct("ordinal", "block", (F.col("held") - F.col("taken")).cast("bigint").alias("carry")))
    found = rows.groupBy("account_id").agg(F.min(end).alias("end"), F.sum("units").cast(TOTAL).alias("asked"))
    # Where the balance holds all that is left, nothing ends the phase and everything counts as light.
    enough = F.coalesce(F.col("asked") <= F.col("held"), F.lit(True))
    return state.join(found, "account_id", "left").select(
        "account_id",
        "from_block",
        F.when(enough, F.col("held") + 1).otherwise(F.col("half")).alias("half"),
        F.when(~enough, F.col("end.block")).alias("to_block"),
        F.when(~enough, F.col("end.carry")).alias("carry"),
    )


def _taken_one_by_one(asked: DataFrame, ended: DataFrame) -> DataFrame:
    """``account_id, block, held, taken``: the requests accepted in the blocks where phases end, and what is left then."""
    rows = asked.join(ended.select("account_id", F.col("to_block").alias("block"), "carry"), ["account_id", "block"])
    blocks = rows.groupBy("account_id", "block", "carry").agg(F.array_sort(F.collect_list(F.struct("ordinal", "units"))).alias("requests"))
    done = F.aggregate(
        "requests",
        F.struct(F.col("carry").alias("held"), F.array().cast("array<bigint>").alias("taken")),
        lambda left, r: F.when(
            r["units"] <= left["held"],
            F.struct((left["held"] - r["units"]).alias("held"), F.array_append(left["taken"], r["ordinal"]).alias("taken")),
        ).otherwise(left),
    )
    return blocks.select("account_id", "block", done.alias("done")).select("account_id", "block", "done.*")


def served_in_order(requests: DataFrame, balances: DataFrame) -> DataFrame:
    """``requests`` (account_id, place, units and others) with ``accepted``, on ``balances`` (account_id, held).

    ``units`` and ``held`` are whole numbers (cents), ``place`` is the order of the requests of an account and
    occurs once in it.  The balance only falls, so that what doesn't fit once never will.  A round takes every open
    account to the end of a phase, which at least halves its balance, and through the block where that happens,
    request by request.  So an account of one block is done in one round, and any other in as many as its balance has
    bits, 63 at most.  Amounts of zero or less and NULL amounts are taken and change nothing; accounts without a
    balance are not limited.
    """
    numbered = stored(_numbered(requests), "numbered-requests")
    asked = numbered.filter("units > 0").select("account_id", "units", "ordinal", "block")
    held = balances.filter("held IS NOT NULL").select("account_id", F.col("held").cast("bigint").alias("held"))
    state = held.filter("held > 0").withColumn("from_block", F.lit(0).cast("bigint")).withColumn("half", _half("held"))
    phases, blocks = [], []
    while True:
        phases.append(stored(_phases(asked, state), "phases"))
        ended = phases[-1].filter("to_block IS NOT NULL")
        if ended.isEmpty():
            break
        blocks.append(stored(_taken_one_by_one(asked, ended), "blocks-served"))
        on = blocks[-1].filter("held > 0")
        state = on.select("account_id", "held", (F.col("block") + 1).alias("from_block"), _half("held").alias("half"))
    # At most 63 phases an account, which reach its requests as one array.
    phase = F.struct("from_block", "to_block", "half")
    listed = reduce(DataFrame.unionByName, phases).groupBy("account_id").agg(F.collect_list(phase).alias("phases"))
    limits = held.select("account_id", F.lit(True).alias("limited")).join(listed, "account_id", "left")
    marked = numbered.join(limits, "account_id", "left")
    if blocks:
        marked = marked.join(reduce(DataFrame.unionByName, blocks).select("account_id", "block", "taken"), ["account_id", "block"], "left")
    else:
        marked = marked.withColumn("taken", F.lit(None).cast("array<bigint>"))
    block, units = F.col("block"), F.col("units")
    light = F.exists(
        "phases",
        lambda p: (block >= p["from_block"]) & F.coalesce(block < p["to_block"], F.lit(True)) & (units < p["half"]),
    )
    taken = F.coalesce(light, F.lit(False)) | F.coalesce(F.array_contains("taken", F.col("ordinal")), F.lit(False))
    accepted = F.col("limited").isNull() | F.coalesce(units <= 0, F.lit(True)) | taken
    return marked.select(*requests.columns, accepted.alias("accepted"))
