"""Time the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query's whole result is computed and thrown away, twice: the first run warms
the JVM and the Python workers up, the second is the one reported.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from querymill.plans.queries import QUERIES
from querymill.session import release_scratch, settings_for

HEADLINE = [
    "query_to_partitions",
    "date_parts",
    "partitioned_roundtrip",
    "query_roundtrip",
    "latest_per_key",
    "sql_pricing_summary",
    "sql_region_volume",
    "sql_join_agg_window",
    "csv_text_roundtrip",
    "json_text_roundtrip",
    "latest_version",
    "hash_split",
    "nearest_neighbor",
    "accuracy",
    "train_and_score",
    "batch_score",
    "insert_if_absent",
    "register_packages",
    "registry_pending",
    "approved_latest",
    "version_link",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    size = sum(path.stat().st_size for path in Path(sf_dir).glob("*.parquet"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings_for(size, cpus).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        _run(spark, name, sf_dir)
        seconds[name] = _run(spark, name, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    release_scratch(spark)
    spark.stop()


def _run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


if __name__ == "__main__":
    main()
