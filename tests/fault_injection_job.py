"""Run the distributed rank while input tasks fail on their first attempt.

Launched by tests/test_fault_tolerance.py in its own JVM with
``local[4,4]`` (4 attempts per task).  Prints "OK <rows>" when the ranks
equal a plain window computed without failures.
"""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from salescope.operators.rank import rank_within  # noqa: E402


@F.udf(T.LongType())
def flaky(x):
    # test-only: the first attempt of every odd input partition fails
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 1:
        raise RuntimeError("injected task failure")
    return x


def main() -> None:
    spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "6").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ft-"))
    base = spark.range(0, 4000, 1, 8).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string")))
        .alias("division"),
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("product"),
        (F.col("id") * 7919 % 53).alias("total_qty"),
    )
    failing = base.withColumn("total_qty", flaky("total_qty"))
    got = rank_within(failing, ["division"], "total_qty", ["product"]).collect()
    by = Window.partitionBy("division").orderBy(F.desc("total_qty"))
    named = Window.partitionBy("division").orderBy(F.desc("total_qty"), "product")
    want = base.select("*", F.rank().over(by).alias("rnk"), F.dense_rank().over(by).alias("drnk"), F.row_number().over(named).alias("row_num")).collect()
    key = lambda r: (r.division, r.product)
    a = sorted((key(r), r.rnk, r.drnk, r.row_num) for r in got)
    b = sorted((key(r), r.rnk, r.drnk, r.row_num) for r in want)
    print("OK" if a == b else "MISMATCH", len(a), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
