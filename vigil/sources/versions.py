"""Several tables stored as one version: readers see all tables of a job's outcome together, or those before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import exists

MARK = "tables array<string>, version bigint"


def _marks(spark: SparkSession, folder: str) -> DataFrame:
    if not exists(spark, f"{folder}/whole"):
        return spark.createDataFrame([], MARK)
    return spark.read.schema(MARK).parquet(f"{folder}/whole")


def last_version(spark: SparkSession, folder: str) -> int:
    """Number of the last whole version, 0 if there is none."""
    return _marks(spark, folder).agg(F.max("version")).first()[0] or 0


def save(tables: dict[str, DataFrame], folder: str) -> int:
    """Write tables as the version after the last whole one; returns its number.

    The version's mark is written last.  A job that fails before leaves a version without a mark, which no reader sees
    and the next attempt writes over.  Versions stay until they are removed, so readers keep theirs.  One writer at a
    time is meant.
    """
    spark = next(iter(tables.values())).sparkSession
    version = last_version(spark, folder) + 1
    for name, rows in tables.items():
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{folder}/version-{version}/{name}")
    mark = spark.range(1).select(F.array(*map(F.lit, tables)).alias("tables"))
    mark.write.mode("overwrite").parquet(f"{folder}/whole/version={version}")
    return version


def load(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a whole version, the last one unless another is named."""
    version = last_version(spark, folder) if version is None else version
    found = _marks(spark, folder).filter(F.col("version") == version).select("tables").first()
    if found is None:
        raise ValueError(f"no whole version {version} in {folder}")
    return {name: spark.read.parquet(f"{folder}/version-{version}/{name}") for name in found.tables}
