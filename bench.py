"""Benchmark: every registered query on the business tables of one scale factor.

Steps
1. derive the eight business tables from the driver's tables at
   ``$BENCH_SF_DIR`` and write them once as Parquet into a fresh folder under
   the session's ``spark.checkpoint.dir`` (``prepare_sec``);
2. run every registered query against the written tables: one warm-up, then
   ``$BENCH_REPEAT`` timed runs (median).  Each run executes the full plan
   into Spark's ``noop`` sink, so nothing is collected to the driver.

Prints ONE JSON line: {"metric", "value" (sum of medians), "unit", "queries",
"sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salescope.plans.catalog import QUERIES  # noqa: E402
from salescope.session import checkpoint_root, get_session, scale_settings  # noqa: E402
from salescope.sources.parquet import save_tables  # noqa: E402
from salescope.sources.tpch import derive_tables  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _input_bytes(spark, path: str) -> int:
    """Bytes under ``path``, through the Hadoop FileSystem (any storage)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(
        app="salescope-bench",
        master=f"local[{cpus}]",
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # size shuffle partitions, splits and skew thresholds from the input
    input_bytes = _input_bytes(spark, sf_dir)
    for key, value in scale_settings(input_bytes, cpus).items():
        spark.conf.set(key, value)

    buckets = int(os.environ.get("BENCH_BUCKETS", "0")) or None
    root = checkpoint_root(spark).rstrip("/")
    tables_dir = f"{root}/salescope-bench-{uuid.uuid4().hex[:8]}"
    database = "salescope_bench"
    t0 = time.perf_counter()
    save_tables(derive_tables(spark, sf_dir), database, tables_dir, buckets)
    prepare = time.perf_counter() - t0
    source_tables = f"catalog:{database}"

    results: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        source = sf_dir if name.startswith("with_fiscal") else source_tables
        try:
            _run(fn(spark, source))  # warm-up (also plans and caches file listings)
            times = []
            for _ in range(repeat):
                t = time.perf_counter()
                _run(fn(spark, source))
                times.append(time.perf_counter() - t)
            results[name] = round(statistics.median(times), 4)
        except Exception as e:  # keep measuring the others; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "prepare_sec": round(prepare, 3),
        "cpus": cpus,
        "input_bytes": input_bytes,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "repeat": repeat,
        "tables_dir": tables_dir,
        "buckets": buckets,
        "errors": errors,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
