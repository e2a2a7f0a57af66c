"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Results go to the no-op sink, so a query is timed to its last row without a file or a collect.
``$BENCH_RUNS`` timed runs follow one warm run; the best counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from dictspark.plans import load_all
from dictspark.plans.registry import QUERIES, TABLES
from dictspark.plans.wide_queries import WIDE_FIELDS, wide_table
from dictspark.session import local_session, work_dir
from dictspark.sources.connector import write_extract
from dictspark.sources.reader import read_table

HEADLINE = (
    "read_table_full", "decode_fixed_width", "decode_roundtrip", "flagship_join", "cube_rows", "cube_pivot", "cube_totals_show",
    "hierarchy_rollup", "lineage_trace_down", "delta_apply", "delta_latest_image", "reconcile_summary", "fingerprint_table",
    "json_typed_roundtrip", "describe_function_nested", "quality_decode_profile", "wide_scan_count",
)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, runs: int) -> float:
    best = None
    for i in range(runs + 1):
        start = time.perf_counter()
        run()
        took = time.perf_counter() - start
        if i:
            best = took if best is None else min(best, took)
    return round(best, 3)


def dealt(spark, sf_dir: str) -> str:
    """The tables in as many files as cores, written before the clock starts: a small table is one row group, which one task
    would read alone, while tables of any size come in many."""
    out = work_dir(spark, "tables")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{out}/{name}.parquet")
    return out


def wide_extract(spark, sf_dir: str, rows: int) -> str:
    """A text extract of 400 columns, written before the clock starts."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").limit(rows)
    return write_extract(wide_table(items.repartition(spark.sparkContext.defaultParallelism)), WIDE_FIELDS, work_dir(spark, "wide"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = sys.argv[1:]
    spark = local_session("bench", cores, int(cores) if cores.isdigit() else 8, spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    times: dict[str, float] = {}
    tables = dealt(spark, sf_dir)
    for name in HEADLINE:
        if not only or name in only:
            times[name] = timed(lambda name=name: consume(QUERIES[name](spark, tables)), runs)
    if not only or "wide_file" in only:
        path = wide_extract(spark, sf_dir, 100_000)
        scan = {"layout": "delimited", "fields": WIDE_FIELDS}
        times["wide_file_limit_10"] = timed(lambda: consume(read_table(spark, f"{path}/lines", max_rows=10, **scan)), runs)
        times["wide_file_limit_10000"] = timed(lambda: consume(read_table(spark, f"{path}/lines", max_rows=10_000, **scan)), runs)
        times["wide_file_count"] = timed(lambda: read_table(spark, f"{path}/lines", **scan).count(), runs)
        times["wide_file_full"] = timed(lambda: consume(read_table(spark, f"{path}/lines", **scan)), runs)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    line = {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(scale.group(1)) if scale else None}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
