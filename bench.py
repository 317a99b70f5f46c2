"""Time the warehouse build and the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and threads.
Queries run on the built warehouse, as a dashboard would, into a sink that drops rows: "queries" has the better of two
runs, "first_run" the first. "small" has the query with a published time at the size it was published for (about 6,000
lines), on a built warehouse, outside the total.
"""

from __future__ import annotations

import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

from tradewind.plans.warehouse import BUILDS, open_generated
from tradewind.queries import QUERIES
from tradewind.session import build_session
from tradewind.sources import schemas

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SMALL = os.path.join(os.path.dirname(FOLDER.rstrip("/")), "sf0.001")
PUBLISHED = "mv15_revenue_by_product_by_day"
HEADLINE = [name for name in QUERIES if name.startswith(("mv", "rc"))] + [
    "me02_retention_churn",
    "me04_cohorts",
    "me07_product_return_rate",
    "cf03_discount_pivot",
    "vc12_order_payment_split",
    "vc15_channel_metrics",
    "vc16_redemption_anomalies",
    "rp08_popular_products",
    "wn1_line_numbers",
    "fl02_order_line_items",
    "sc09_keyed_upsert",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def load_staging(warehouse) -> None:
    """Staging tables do not depend on each other, so they load side by side."""
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(warehouse.stg.__getitem__, schemas.STAGING))


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    warehouse = open_generated(spark, FOLDER)
    times = {
        "load_staging": timed(lambda: load_staging(warehouse)),
        "build_warehouse": timed(lambda: warehouse.prepare(BUILDS)),
    }
    firsts = {}
    for name in HEADLINE:
        run = lambda: QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        firsts[name] = timed(run)
        times[name] = min(firsts[name], timed(run))
    total = round(sum(times.values()), 3)
    small = {}
    if os.path.isdir(SMALL):
        open_generated(spark, SMALL).prepare(["agg_product_day"])
        run = lambda: QUERIES[PUBLISHED](spark, SMALL).write.format("noop").mode("overwrite").save()
        small = {PUBLISHED: min(timed(run) for _ in range(5))}
    print(
        json.dumps(
            {
                "metric": "warehouse build and headline queries, total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "first_run": firsts,
                "small": small,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
