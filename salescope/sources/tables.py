"""The bundle of business tables every operator reads."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.schema import KEYS, SCHEMAS

TABLE_NAMES = tuple(SCHEMAS)


@dataclass(frozen=True)
class SalesTables:
    """Eight lazy DataFrames of the sales star schema.

    Operators take this object instead of reading globals, so the same code
    runs on derived test tables, on a Parquet warehouse, or on in-memory
    fixtures.
    """

    fact_sales_monthly: DataFrame
    fact_forecast_monthly: DataFrame
    fact_gross_price: DataFrame
    fact_pre_invoice_deductions: DataFrame
    fact_post_invoice_deductions: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    #: Newest date folder of the sales table where a catalog lists them; it says where to look first, results don't hang on it.
    newest_sales_date: dt.date | None = None

    # short aliases used by the operators
    @property
    def sales(self) -> DataFrame:
        return self.fact_sales_monthly

    @property
    def forecast(self) -> DataFrame:
        return self.fact_forecast_monthly

    @property
    def gross_price(self) -> DataFrame:
        return self.fact_gross_price

    @property
    def pre_invoice(self) -> DataFrame:
        return self.fact_pre_invoice_deductions

    @property
    def post_invoice(self) -> DataFrame:
        return self.fact_post_invoice_deductions

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLE_NAMES}

    def register_views(self, prefix: str = "") -> None:
        """For SQL users: every table and the view ``forecast_accuracy_base`` as
        temporary views, ``get_fiscal_year`` and ``get_fiscal_quarter`` as functions."""
        from salescope.functions.fiscal import register_sql_functions
        from salescope.operators.forecast import forecast_accuracy_base

        for name, df in self.as_dict().items():
            df.createOrReplaceTempView(prefix + name)
        forecast_accuracy_base(self).createOrReplaceTempView(prefix + "forecast_accuracy_base")
        register_sql_functions(self.sales.sparkSession)

    def duplicate_keys(self) -> DataFrame:
        """Key violations of all tables as one DataFrame (table, n_dup_keys).

        The reference's joins assume these keys are unique; a duplicate rate
        row would fan out and inflate sums.  Each check is a distributed
        aggregate; only the per-table counts come back.
        """
        out = None
        for name, df in self.as_dict().items():
            dups = (
                df.groupBy(*KEYS[name]).count().where(F.col("count") > 1)
                .agg(F.count(F.lit(1)).alias("n_dup_keys"))
                .select(F.lit(name).alias("table"), "n_dup_keys")
            )
            out = dups if out is None else out.unionByName(dups)
        return out


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of ``path`` (works for
    local paths, HDFS and object stores alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def table_path(spark: SparkSession, root: str, name: str) -> str | None:
    """``<root>/<name>`` or ``<root>/<name>.parquet``, whichever exists."""
    for cand in (f"{root.rstrip('/')}/{name}", f"{root.rstrip('/')}/{name}.parquet"):
        if path_exists(spark, cand):
            return cand
    return None


def load_tables(spark: SparkSession, source: str) -> SalesTables:
    """Load the business tables from ``source``.

    * a folder holding the eight business tables as Parquet (``<name>`` or
      ``<name>.parquet``) is read directly;
    * a folder holding the driver's TPC-H-like tables is mapped onto the
      business schema by :mod:`salescope.sources.tpch`;
    * ``catalog:<database>`` reads the tables saved in that database.
    """
    if source.startswith("catalog:"):
        from salescope.sources.parquet import catalog_tables

        return catalog_tables(spark, source.split(":", 1)[1])
    if all(table_path(spark, source, n) for n in TABLE_NAMES):
        from salescope.sources.parquet import read_tables

        return read_tables(spark, source)
    from salescope.sources.tpch import derive_tables

    return derive_tables(spark, source)
