"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tablewright.plans.catalog import QUERIES  # noqa: E402
from tablewright.shared import intermediate  # noqa: E402

HEADLINES = (
    "delimited_parse", "clean_markup", "normalize_names", "resolve_codes", "job_facts",
    "profile_ads", "profile_documents", "error_report", "consolidate_names",
    "candidate_pairs", "candidate_pairs_above_floor", "duplicate_records",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tablewright-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tablewright-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not measured
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        with intermediate(spark):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
