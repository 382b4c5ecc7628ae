"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vigil")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FOLDERS: list[str] = []
"""Work folders that this program made and has not released."""
_TABLES: list[str] = []
"""Catalog tables over such folders."""


def work_folder(spark: SparkSession, purpose: str) -> str:
    """New folder for a job's own tables, below the folder named for checkpoints: by the cluster in
    ``spark.checkpoint.dir``, or by the program with ``setCheckpointDir``.

    Only on a local master, where every task sees the same disk, is that folder set here if it is not.
    ``release`` removes the work folders once the results that read them are written.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="vigil-")
        spark.conf.set("spark.checkpoint.dir", shared)
    _FOLDERS.append(f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    return _FOLDERS[-1]


def work_table(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """New name for a catalog table and the work folder for its files; ``release`` drops both."""
    folder = work_folder(spark, purpose)
    _TABLES.append(f"vigil_{uuid.uuid4().hex}")
    return _TABLES[-1], folder


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    files, path = _path(spark, folder)
    return files.exists(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder through the file system it lies in."""
    files, path = _path(spark, folder)
    files.delete(path, True)


def release(spark: SparkSession) -> None:
    """Remove all work tables and folders made so far."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    while _FOLDERS:
        remove(spark, _FOLDERS.pop())


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows once and read them back: results used several times are computed once, survive
    lost executors, and joins with them are planned on their true size."""
    folder = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
