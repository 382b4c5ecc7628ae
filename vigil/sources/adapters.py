"""Payment and commerce tables expressed over the stored inputs.

``adapters.sql`` holds one statement per table.  ``{name}`` stands for another table, stored or
adapted.  The same texts serve as the common table expressions of the SQL checks.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from vigil import schemas


def _read_statements() -> dict[str, str]:
    text = Path(__file__).with_name("adapters.sql").read_text()
    parts = re.split(r"^-- (\w+)$", text, flags=re.M)
    return dict(zip(parts[1::2], (body.strip() for body in parts[2::2]), strict=True))


STATEMENTS = _read_statements()


def _inputs(statement: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", statement)))


class Tables:
    """Lazy access by name: ``Tables(spark, folder)["bank_accounts"]``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._load(name)
        return self._known[name]

    def _load(self, name: str) -> DataFrame:
        if name in schemas.RAW:
            return self.spark.read.schema(schemas.RAW[name]).parquet(f"{self.folder}/{name}.parquet")
        return self.adapt(name, self)

    def adapt(self, name: str, inputs) -> DataFrame:
        """Adapted table over the given inputs, which may be streams."""
        statement = STATEMENTS[name]
        return self.spark.sql(statement, **{other: inputs[other] for other in _inputs(statement)})


def common_table_expressions(names: list[str]) -> str:
    """``with`` clause for a DuckDB check: the named tables and all that they build on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered or name not in STATEMENTS:
            return
        for other in _inputs(STATEMENTS[name]):
            visit(other)
        ordered.append(name)

    for name in names:
        visit(name)
    bodies = []
    for name in ordered:
        body = re.sub(r"\{(\w+)\}", r"\1", STATEMENTS[name]).replace("timestamp_ntz", "timestamp")
        bodies.append(f"{name} as (\n{body}\n)")
    return "with " + ",\n".join(bodies)
