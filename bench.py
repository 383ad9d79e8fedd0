"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   data directory, default /root/testdata/sf0.1
BENCH_CPUS     local cores, default 8
BENCH_COMPARE  set to 1 to also time the textbook delta in benchmarks/
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

import snaptrack as st
from snaptrack.registry import scenarios, spark_queries

HEADLINE = (
    "build_history_full",
    "build_history_delta",
    "build_history_missing_close",
    "build_history_documents",
    "build_history_events",
    "classify",
    "classify_embeddings",
    "change_summary",
    "edited_rows",
    "closed_edited_rows_log",
    "change_log",
    "new_rows",
    "timeline",
    "explode_changes",
    "column_change_counts",
    "key_violations",
    "replay",
    "replay_bucketed",
    "stream_history",
    "build_history_bucketed",
    "build_history_keep_first",
    "as_of",
    "as_of_history_table",
    "join_as_of",
    "history_violations",
)
# These read a stored history: it is written before the clock starts.
READS = ("as_of", "as_of_history_table", "timeline", "join_as_of")
REPEATS = 2


def run(df: DataFrame) -> None:
    """Compute every row and column, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def best_time(make, read_alone: bool = False) -> float:
    run(make())  # warm up: code generation, file listing
    times = []
    for _ in range(REPEATS):
        prepared = make() if read_alone else None
        start = time.perf_counter()
        run(prepared if read_alone else make())
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("snaptrack-bench")
        .config(map=st.session_conf(cores=int(cpus) // 2 or 1))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = spark_queries.queries()
    times = {
        name: best_time(lambda: queries[name](spark, sf_dir), name in READS) for name in HEADLINE
    }
    report = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_COMPARE") == "1":
        from benchmarks.multi_join import build_history

        recent, history = scenarios.frames(spark, sf_dir, scenarios.ORDERS)
        report["textbook_delta"] = best_time(
            lambda: build_history(recent, history, "o_orderkey", scenarios.RUN_DATE)
        )
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
