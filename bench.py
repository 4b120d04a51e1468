"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tidemark import plans
from tidemark.session import SETTINGS

HEADLINE = (
    "bar_ohlcv", "bar_partial_final", "bar_reconcile", "frame_dedup", "monotonic_stamp", "latest_state", "splice_series", "omo_flow", "calendar_coverage",
    "screen_topk", "statements_long", "price_type_mode", "event_dedupe_best", "upsert_counts", "directory_diff", "due_list", "freq_detect", "text_norm", "phrase_search", "near_dup",
)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = plans.queries(), {}
    queries["bar_ohlcv"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    sf = sf_dir.rstrip("/").rpartition("sf")[2]
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
