"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR   folder of the given tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up (default 3)
BENCH_QUERIES  comma-separated names instead of the headline ones, or "all"
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyline import staging  # noqa: E402
from tallyline.plans import lake, registry  # noqa: E402
from tallyline.session import get_spark  # noqa: E402

HEADLINE = [
    "match_statements",
    "final_index",
    "star_enrich",
    "unmatched_both_sides",
    "merge_indexes",
    "latest_per_transaction",
    "merchant_aggregate",
    "user_spend",
    "merchant_daily_kpi",
    "user_profile",
    "settlement_schedule",
    "compliance_index",
    "quality_report",
    "fraud_alerts",
    "discrepancies",
    "ops_index",
    "cross_join_unnest",
    "fraud_value_having",
    "q03_order_value_top5",
    "q15_events_users",
    "q26_fraud_value",
    "q29_event_row_number",
    "stream_index_tx",
    "stream_dedup",
    "salted_join",
]


def run(df) -> None:
    """Compute every row and column without collecting them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    queries = registry.all_queries()
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = get_spark(
        "tallyline-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    # The given tables turned into the jobs' inputs and the layers written on
    # the way are jobs of their own: timed once, after one warm-up.
    layers = {
        "layer_transactions": lambda: lake.transactions(spark, sf_dir),
        "layer_statements": lambda: lake.statements(spark, sf_dir),
        "layer_batch_index": lambda: lake.batch_index(spark, sf_dir),
        "layer_final_index": lambda: lake.final_index(spark, sf_dir),
        "layer_report_index": lambda: lake.report_index(spark, sf_dir),
        "layer_nested": lambda: [
            lake.nested(spark, sf_dir, t) for t in staging.NESTED_VIEWS
        ],
    }
    seconds, spread = {}, {}
    for build in layers.values():
        build()
    lake.forget()
    for name, build in layers.items():
        start = time.perf_counter()
        build()
        seconds[name] = round(time.perf_counter() - start, 3)

    for name in names:
        run(queries[name](spark, sf_dir))
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            run(queries[name](spark, sf_dir))
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        spread[name] = round(max(times) - min(times), 3)

    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "spread": spread,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
