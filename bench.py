"""Time the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  A query's time is the median of its runs after two warm-up runs; its whole
result is produced and handed to the no-op sink, so nothing is left out of the timing.  The report on the split event
table reads a table that is stored before the timing begins, as such a table is in use.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vigil.plans.registered import QUERIES, event_counts_on_split  # noqa: E402
from vigil.session import local_session, release  # noqa: E402
from vigil.sources.adapters import Tables  # noqa: E402

#: Queries on tables that are stored before: what stores them and returns the query.
ON_STORED = {"event_counts_recent_split": event_counts_on_split}

WARM_UPS = 2
HEADLINES = [
    "email_search",
    "orders_city_status",
    "customer_revenue_top",
    "event_counts_recent",
    "event_counts_recent_split",
    "category_revenue",
    "order_event_pair_count",
    "orders_with_recent_events",
    "transaction_risk_score",
    "customer_daily_volume",
    "customer_risk_profile",
    "customer_risk_ranking",
    "cumulative_spend",
    "transaction_risk_score_skewed",
    "cumulative_spend_skewed",
    "flagged_transactions",
    "daily_fraud_summary",
    "process_pending",
    "balances_after_approval",
    "check_violations",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, shuffle_partitions=cpus)
    seconds = {}
    for name in names:
        times, stored = [], ON_STORED[name](Tables(spark, folder)) if name in ON_STORED else None
        for _ in range(WARM_UPS + runs):
            start = time.perf_counter()
            result = stored() if stored else QUERIES[name](spark, folder)
            result.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
            if not stored:
                release(spark)
        release(spark)
        seconds[name] = round(statistics.median(times[WARM_UPS:]), 4)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
