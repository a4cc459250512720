"""Date dimension built on the cluster from a month range."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions.fiscal import fiscal_year


def build_dim_date(spark: SparkSession, first: _dt.date, last: _dt.date, step: str = "month") -> DataFrame:
    """dim_date(calendar_date, fiscal_year) for every ``step`` from ``first``
    to ``last`` inclusive (``step`` is 'month' or 'day').

    Generated with ``sequence`` + ``explode`` (no driver-side list), so a
    century of days is still one small distributed relation.
    """
    interval = F.expr(f"INTERVAL 1 {step.upper()}")
    return (
        spark.range(1)
        .select(F.explode(F.sequence(F.lit(first), F.lit(last), interval)).alias("calendar_date"))
        .select(F.col("calendar_date").cast("date").alias("calendar_date"))
        .withColumn("fiscal_year", fiscal_year("calendar_date"))
    )
