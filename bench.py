"""Wall seconds of every query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query writes its whole result to the `noop` sink. One warm-up run, then the median of
$BENCH_RUNS runs (3), or one run where the warm-up took over five seconds. Queries that move files
run once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from rawstar.plans import catalog_files  # noqa: F401  (registers its queries)
from rawstar.plans.catalog import QUERIES

FILE_QUERIES = {
    "raw_line_lineage", "incremental_ingest", "stream_ingest", "retry_ingest",
    "pipeline_fact", "pipeline_gaps", "pipeline_control", "stream_pipeline", "failed_batch",
    "layer_views",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rawstar-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in QUERIES:
        if only and name not in only:
            continue
        if name in FILE_QUERIES:
            seconds[name] = round(once(name), 3)
            continue
        repeat = runs if once(name) < 5 else 1
        seconds[name] = round(statistics.median(once(name) for _ in range(repeat)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total wall seconds, median per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "spark": spark.version,
                "cpus": int(cpus),
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
