"""Compare registered queries with their SQL statements in DuckDB.

    python tests/check.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def expected(connection, sql: str):
    rows = connection.execute(sql).fetchall()
    names = [d[0] for d in connection.description]
    return names, {d[0]: str(d[1]) for d in connection.description}, rows


def _bag(names, rows):
    order = [names.index(n) for n in sorted(names)]
    return Counter(tuple(r[i] for i in order) for r in rows)


def differences(frame, connection, sql: str) -> list[str]:
    """Empty when rows, names and types agree."""
    names, types, rows = expected(connection, sql)
    found = []
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    for name, kind in frame.dtypes:
        want = SAME_TYPE.get(kind, kind.upper())
        if types[name].upper() != want:
            found.append(f"{name}: {kind} against {types[name]}")
    ours, theirs = _bag(frame.columns, frame.collect()), _bag(names, rows)
    if ours != theirs:
        extra, missing = list((ours - theirs).elements()), list((theirs - ours).elements())
        found.append(f"{len(extra)} extra {extra[:3]}, {len(missing)} missing {missing[:3]}")
    if not rows:
        found.append("no rows")
    return found


def main() -> None:
    import __spark_entry__ as registry
    from vigil.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = local_session(), duck(folder)
    sql = registry.oracle_sql()
    for name, query in registry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in sql:
                found = differences(query(spark, folder), connection, sql[name])
            else:
                found = [f"(no SQL) {query(spark, folder).count()} rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{name:34s} {time.time() - start:6.2f}s  {'; '.join(found) or 'equal'}", flush=True)


if __name__ == "__main__":
    main()
