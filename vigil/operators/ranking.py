"""Global ranks without a global sort of the rows, and without a window over all of anything."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import stored


def _split(counts: DataFrame, order) -> DataFrame:
    """Counts in stored ranges of values, each with what the ranges before it hold."""
    ranges = stored(
        counts.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "value-counts"
    )
    totals = ranges.groupBy("range").agg(F.sum("n").alias("rows"), F.count("*").alias("values"))
    # One entry per range, and no more ranges than shuffle partitions: they fit one array.
    listed = totals.agg(F.array_sort(F.collect_list(F.struct("range", "rows", "values"))).alias("all"))

    def before(i, name):
        return F.aggregate(F.slice("all", 1, i), F.lit(0).cast("bigint"), lambda total, x: total + x[name])

    starts = listed.select(
        F.explode(
            F.transform(
                "all",
                lambda x, i: F.struct(
                    x["range"].alias("range"), before(i, "rows").alias("rows_before"), before(i, "values").alias("values_before")
                ),
            )
        ).alias("start")
    ).select("start.*")
    return ranges.join(F.broadcast(starts), "range")


def value_ranks(rows: DataFrame, value: str, rank: str, dense: bool = False) -> DataFrame:
    """``ranked_value`` and its RANK or DENSE_RANK in descending order, NULLs first, for every value of ``rows``.

    Rows are counted per value, and the counts are ranked range by range.
    """
    order = F.col(value).desc_nulls_first()
    counts = _split(rows.groupBy(value).agg(F.count("*").alias("n")), order)
    window = Window.partitionBy("range").orderBy(order)
    if dense:
        position = F.col("values_before") + F.row_number().over(window)
    else:
        above = F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1))
        position = F.col("rows_before") + F.coalesce(above, F.lit(0)) + 1
    return counts.select(F.col(value).alias("ranked_value"), position.cast("bigint").alias(rank))


def rank_by_value(rows: DataFrame, value: str, rank: str, dense: bool = False) -> DataFrame:
    """Add the RANK or DENSE_RANK of ``value``.

    Ranks of few values are broadcast, by the size of their stored counts.  Else they are joined by a shuffle, in
    which AQE splits the rows of a common value, such as score 0.  ``rows`` are read twice, so they should be a
    stored table.
    """
    ranks = value_ranks(rows, value, rank, dense)
    return rows.join(ranks, F.col(value).eqNullSafe(F.col("ranked_value")), "left").drop("ranked_value")
