"""Time every registered query; prints one JSON line.

Each query is run to the end into the no-op sink, after one untimed run of a small query.
`value` is the sum over all queries. `landing_rows_per_sec` is the rate of the whole
two-batch load and transform, which includes writing its landing files.
BENCH_ONLY names a few queries, separated by commas.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from martloom.queries import QUERIES
from martloom.queries.landing import BATCHES, LANDINGS
from martloom.sources.scratch import scratch

PIPELINE = "pipeline_two_batches"


def session(shared: str) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("martloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    with scratch(spark):
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def landing_rows(spark: SparkSession, sf_dir: str) -> int:
    return sum(x.rows(spark, sf_dir, b).count() for x in LANDINGS.values() for b in BATCHES)


def main(shared: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_ONLY")
    names = chosen.split(",") if chosen else list(QUERIES)
    spark = session(shared)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "group_counts", sf_dir)
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in names}
    report = {
        "metric": "total seconds of all queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if PIPELINE in seconds:
        rows = landing_rows(spark, sf_dir)
        report |= {"landing_rows": rows, "landing_rows_per_sec": round(rows / seconds[PIPELINE])}
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    with tempfile.TemporaryDirectory(prefix="martloom-bench-") as folder:
        main(folder)
