"""Connected components of a graph given as edges, by alternating star contractions.

Each round hangs all larger neighbours of a node on its smallest neighbour (large star), then all smaller ones
(small star); when a round changes nothing, every node hangs on the smallest node of its component.  Minima are
aggregated before they are joined back, so a node with very many neighbours costs one entry per task.  Every round
is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigil.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u != v")
        .union(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.expr("xxhash64(u, v) % 1000003"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: for every node of an edge ``u, v`` (any order, repeats and loops allowed) the smallest node
    of its component.  No edges, no rows."""
    links = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "links")
    before, state = None, _state(links)
    while state != before and state[0]:
        before = state
        links = stored(_small_star(_large_star(links)), "links")
        state = _state(links)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select("v", "v").distinct()
    )
