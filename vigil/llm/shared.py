"""Helpers of the operators: written intermediate tables, stores that tasks open, column names."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil.session import work_folder

#: Texts that go to a Python worker at a time; long ones would fill its memory in the usual batches of 10,000.
BATCH_ROWS = 500
#: Text bytes that one group of documents should hold where an operator works on groups.
GROUP_BYTES = 16 << 20


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New folder below ``spark.checkpoint.dir``; ``vigil.session.release`` removes it once results are written."""
    return work_folder(spark, purpose)


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows below the shared folder and read them back: lineage ends there, lost executors lose nothing."""
    folder = shared_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file, for tasks that write or read formats Spark has no source for."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else os.path.abspath(uri))


@contextlib.contextmanager
def whole_file(uri: str) -> Iterator:
    """Stream of a new file that appears under its name when it is whole: a repeated task replaces equal content."""
    fs, path = store(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    unfinished = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(unfinished, compression=None) as out:
        yield out
    fs.move(unfinished, path)


def whole_text(column: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fresh(name: str, taken: Iterable[str]) -> str:
    """A column name that none of the given columns has."""
    used = {x.lower() for x in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application, as ``--py-files`` would, and keep batches small."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    name = f"{package.name}-{context.applicationId}.zip"
    if not any(x.endswith(name) for x in getattr(context, "_python_includes", [])):
        path = Path(tempfile.mkdtemp(prefix="vigil-")) / name
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(package.rglob("*")):
                if file.suffix in (".py", ".sql", ".cte"):
                    archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(path))
    return spark
