"""Wall seconds of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (folder of tables), BENCH_CPUS (local cores),
BENCH_RUNS (timed runs after one warm-up, median is reported),
BENCH_QUERIES (comma-separated names, or ``all``).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame

from parcelworks.plans.queries import QUERIES
from parcelworks.session import build_session

HEADLINE = [
    "prepare_sales_retail",
    "unify_shipments",
    "clean_export_a",
    "status_summary",
    "attach_cost",
    "allocate_shipping_tax",
    "split_courier_charge",
    "sla_metrics",
    "apply_corrections",
    "upsert_freeze_completed",
    "tracking_worklist",
    "request_batches",
    "scan_rollup",
    "flatten_shipment_lists",
    "ledger_totals",
    "batch_shipped_summary",
    "order_flow_month",
    "segment_flow_reship",
]


def run(df: DataFrame) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            run(QUERIES[name](spark, folder))
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
