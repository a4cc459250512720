"""Business tables as Parquet: reader and the layout writer."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.schema import SCHEMAS
from salescope.sources.tables import TABLE_NAMES, SalesTables, table_path

FACTS_BY_DATE = ("fact_sales_monthly", "fact_forecast_monthly", "fact_post_invoice_deductions")


def read_tables(spark: SparkSession, root: str) -> SalesTables:
    """Read the eight tables under ``root`` with their declared schemas
    (no inference job, predicate pushdown and column pruning apply)."""
    frames = {
        name: spark.read.schema(SCHEMAS[name]).parquet(table_path(spark, root, name) or f"{root}/{name}").select(*SCHEMAS[name].fieldNames())
        for name in TABLE_NAMES
    }
    return SalesTables(**frames)


def write_tables(tables: SalesTables, root: str, mode: str = "overwrite") -> SalesTables:
    """Write every table under ``root`` and return readers of the written copy.

    The three (date, customer, product) facts are partitioned by ``date``
    (one folder per month: a fiscal year reads 12 of them, and a filtered
    dim_date join prunes the rest at run time through dynamic partition
    pruning).  Rows are range-clustered by the full key (date first) before
    the write, so each task writes few folders and a month holding a large
    share of the rows is still split over many tasks; inside each file rows
    are sorted by (customer_code, product_code), so the 3-key joins read keys
    in order and Parquet min/max statistics are tight.  ``root`` should be shared storage on a cluster
    (see ``session.checkpoint_root``).
    """
    spark = tables.sales.sparkSession
    root = root.rstrip("/")
    for name, df in tables.as_dict().items():
        w = df
        if name in FACTS_BY_DATE:
            w = (df.repartitionByRange("date", "customer_code", "product_code")
                 .sortWithinPartitions("date", "customer_code", "product_code")
                 .write.partitionBy("date"))
        else:
            w = df.write
        w.mode(mode).parquet(f"{root}/{name}")
    return read_tables(spark, root)


BUCKET_KEYS = ("customer_code", "product_code")
TARGET_FILE_BYTES = 512 * 1024 * 1024


def bucket_count(fact_bytes: int, n_dates: int, target_file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Buckets so that one bucket file of one date partition holds about
    ``target_file_bytes`` (100 TB over 120 months -> ~1,700 buckets)."""
    return max(1, -(-fact_bytes // (max(1, n_dates) * target_file_bytes)))


def save_tables(tables: SalesTables, database: str, location: str, buckets: int | None = None) -> SalesTables:
    """Save every table as a catalog table of ``database`` (stored under
    ``location``) and return readers of the saved tables.

    Catalog tables keep their file listing in the session's relation cache,
    so repeated reports do not list partition folders again.  The three
    (date, customer, product) facts are partitioned by ``date`` and, when
    ``buckets`` is given, bucketed and sorted by (customer_code,
    product_code) with the same bucket count: the fact-fact joins on
    (customer_code, date, product_code) then read co-partitioned buckets and
    need no shuffle where ``spark.sql.requireAllClusterKeysForCoPartition`` is
    false, which ``get_session`` sets: the bucket keys are a subset of the join
    keys.  The settings of a session made elsewhere are left alone.
    """
    spark = tables.sales.sparkSession
    location = location.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name, df in tables.as_dict().items():
        if name in FACTS_BY_DATE:
            if buckets:
                # one task per (month, bucket): as many tasks as files, none holds a bucket of all months
                slot = F.pmod(F.hash(*BUCKET_KEYS), F.lit(buckets))
                w = (df.repartition("date", slot).write.partitionBy("date")
                     .bucketBy(buckets, *BUCKET_KEYS).sortBy(*BUCKET_KEYS))
            else:
                w = (df.repartitionByRange("date", "customer_code", "product_code")
                     .sortWithinPartitions("date", "customer_code", "product_code")
                     .write.partitionBy("date"))
        else:
            w = df.write
        w.mode("overwrite").format("parquet").option("path", f"{location}/{name}").saveAsTable(
            f"{database}.{name}")
    return catalog_tables(spark, database)


def catalog_tables(spark: SparkSession, database: str) -> SalesTables:
    """Readers of the eight tables saved in ``database``; columns that the
    schema names and no operator needs may be missing."""

    def table(name: str) -> DataFrame:
        df = spark.table(f"{database}.{name}")
        return df.select(*[c for c in SCHEMAS[name].fieldNames() if c in df.columns or c not in OPTIONAL])

    return SalesTables(**{name: table(name) for name in TABLE_NAMES}, newest_sales_date=newest_date(spark, f"{database}.fact_sales_monthly"))


def newest_date(spark: SparkSession, table: str) -> dt.date | None:
    """The newest of the date folders that the catalog lists for a table
    (metadata only, no job); None where it isn't partitioned by date or the
    catalog doesn't track its folders."""
    if [c.name for c in spark.catalog.listColumns(table) if c.isPartition] != ["date"]:
        return None
    try:
        folders = [r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    except AnalysisException:
        return None
    return max((dt.date.fromisoformat(f) for f in folders if f[:1].isdigit()), default=None)


# Columns that no operator reads.
OPTIONAL = ("region",)
