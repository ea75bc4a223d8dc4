"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated keys, or ``all`` (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import time

from martloom.catalog import QUERIES
from martloom.session import build_session

HEADLINE = [
    "m01_rfm_segments", "m05_shipping_status", "m06_shipping_datamart", "m09_weekly_retention", "m11_courier_ledger",
    "m14_group_conversion", "m15_zone_activity", "m16_user_travel", "m17_friend_suggestions", "m19_product_counters",
    "m21_metrics_backfill", "j01_inner_chain", "j11_within_distance", "w01_global_ntile", "v03_link_order_product",
    "l22_neighbour_classes", "l28_roc_auc", "l34_bootstrap_profit", "l35_tf_idf", "r07_counter_upsert",
]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES")
    keys = list(QUERIES) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")

    def run(key: str) -> float:
        begun = time.perf_counter()
        QUERIES[key](spark, base).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    run(keys[0])  # warm up the JVM
    seconds = {}
    for key in keys:
        run(key)
        seconds[key] = round(run(key), 3)
    print(json.dumps({"metric": "headline queries, total seconds after one warm-up", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": base.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
