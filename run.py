"""Run a registered query on a folder of stored inputs and write the result as Parquet.

    spark-submit run.py <query> <input folder> <output folder>
    python run.py                                   # lists the queries
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from vigil.plans.registered import QUERIES
from vigil.session import release


def main(arguments: list[str]) -> int:
    if len(arguments) != 3 or arguments[0] not in QUERIES:
        print(__doc__ + "\n" + "\n".join(sorted(QUERIES)))
        return 2
    query, folder, output = arguments
    spark = SparkSession.builder.appName(f"vigil {query}").getOrCreate()
    QUERIES[query](spark, folder).write.parquet(output)
    release(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
