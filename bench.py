"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brookmart.queries import QUERIES  # noqa: E402

HEADLINE = ["log_split_counts", "changelog_route", "new_visitor_flag", "daily_unique_visitors",
            "user_jump", "visitor_stats", "order_wide_enriched", "payment_wide",
            "product_stats_enriched", "province_stats", "search_keyword_stats",
            "document_words", "late_rows_split", "dim_upsert_latest", "gmv_by_brand_day"]
RUNS = 3
LARGE = 100_000     # bytes of a file that is worth cutting


def spread(spark: SparkSession, sf_dir: str, folder: str, parts: int) -> str:
    """A copy of the tables as many files each.

    A test table is one file of one row group, which no number of cores can share; tables at
    the size this is made for come in many.  Made once, before anything is timed.
    """
    target = os.path.join(folder, os.path.basename(sf_dir))
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            large = os.path.getsize(f"{sf_dir}/{name}") > LARGE
            rows = spark.read.parquet(f"{sf_dir}/{name}")
            rows.repartition(parts if large else 1).write.parquet(f"{target}/{name}")
    return target


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false")
             # As many files a task as the copy has for each core.
             .config("spark.sql.files.openCostInBytes", "256k")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.TemporaryDirectory(prefix="brookmart-bench-")
    sf_dir = spread(spark, sf_dir, scratch.name, 2 * int(cpus))
    for name in ("daily_uv_count", "order_wide_facts"):  # warm-up: JSON parsing and a join
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(RUNS):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(median(taken), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}))
    spark.stop()
    scratch.cleanup()


if __name__ == "__main__":
    main()
