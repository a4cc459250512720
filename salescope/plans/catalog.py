"""Every operator bound to one set of parameters, as ``(spark, source) -> DataFrame``.

``source`` is a folder of the driver's tables or of the business tables (see
``load_tables``).  Parameters are fixed here once for all checks (FY1998 is
the first full fiscal year of the test data).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from salescope import operators as op
from salescope.functions.fiscal import with_fiscal_quarter, with_fiscal_year
from salescope.sources.tables import SalesTables, load_tables

PARAMS = {
    "fiscal_year": 1998,
    "market": "NATION_19",
    "n": 5,
    "n_per_division": 3,
    "customer_code": 8,
    "customer_codes": "8,9",
    "customer_name": "FURNITURE-6",
    "y1": 1998,
    "y2": 1999,
    "badge_threshold": 7_500,
}

P = PARAMS


def _ship_dates(spark: SparkSession, source: str) -> DataFrame:
    return spark.read.parquet(f"{source}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date"))


def _on_tables(fn: Callable[[SalesTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, source: str) -> DataFrame:
        df = fn(load_tables(spark, source))
        # decimals as DOUBLE, only for the comparison of values by hash
        return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name) for f in df.schema.fields])

    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # O-01 .. O-04: gross and net sales
    "gross_sales_one_customer": _on_tables(lambda t: op.gross_sales_one_customer(t, P["customer_code"])),
    "gross_sales_named_customer": _on_tables(
        lambda t: op.gross_sales_named_customer(t, P["customer_name"], P["market"])),
    "gross_sales_monthly": _on_tables(lambda t: op.gross_sales_monthly(t, P["customer_codes"])),
    "net_sales_by_customer_code": _on_tables(lambda t: op.net_sales_by_customer_code(t, P["fiscal_year"], P["n"])),
    # O-05 .. O-09: top-N reports
    "net_sales_by_fiscal_year": _on_tables(lambda t: op.net_sales_by_fiscal_year(t, P["fiscal_year"])),
    "top_customers_by_net_sales": _on_tables(
        lambda t: op.top_customers_by_net_sales(t, P["market"], P["fiscal_year"], P["n"])),
    "top_markets_by_net_sales": _on_tables(lambda t: op.top_markets_by_net_sales(t, P["fiscal_year"], P["n"])),
    "top_products_by_net_sales": _on_tables(
        lambda t: op.top_products_by_net_sales(t, P["market"], P["fiscal_year"], P["n"])),
    "top_products_per_division": _on_tables(
        lambda t: op.top_products_per_division(t, P["fiscal_year"], P["n_per_division"])),
    # O-10 .. O-14: forecast accuracy
    "forecast_accuracy_base": _on_tables(op.forecast_accuracy_base),
    "forecast_accuracy_by_customer": _on_tables(lambda t: op.forecast_accuracy_by_customer(t, P["fiscal_year"])),
    "forecast_accuracy_by_market": _on_tables(lambda t: op.forecast_accuracy_by_market(t, P["fiscal_year"])),
    "forecast_decline_lag": _on_tables(lambda t: op.forecast_decline_lag(t, P["y1"], P["y2"])),
    "forecast_decline_pivot": _on_tables(lambda t: op.forecast_decline_pivot(t, P["y1"], P["y2"])),
    # O-15: badge, single market and all markets
    "market_badge": _on_tables(
        lambda t: op.market_badge(t, P["market"], P["fiscal_year"], P["badge_threshold"])),
    "market_badges": _on_tables(lambda t: op.market_badges(t, P["fiscal_year"], P["badge_threshold"])),
    # O-16, O-17: fiscal calendar functions over every ship date
    "with_fiscal_year": lambda spark, source: with_fiscal_year(_ship_dates(spark, source), "ship_date"),
    "with_fiscal_quarter": lambda spark, source: with_fiscal_quarter(_ship_dates(spark, source), "ship_date"),
    # O-18 .. O-24: window reports
    "division_total_alongside_rows": _on_tables(lambda t: op.division_total_alongside_rows(t, P["fiscal_year"])),
    "rank_products": _on_tables(lambda t: op.rank_products(t, P["fiscal_year"])),
    "dense_rank_products": _on_tables(lambda t: op.dense_rank_products(t, P["fiscal_year"])),
    "row_number_products": _on_tables(lambda t: op.row_number_products(t, P["fiscal_year"])),
    "rank_comparison": _on_tables(lambda t: op.rank_comparison(t, P["fiscal_year"])),
    "gross_sales_prev_year": _on_tables(op.gross_sales_prev_year),
    "gross_sales_next_year": _on_tables(op.gross_sales_next_year),
}

# queries that read the business tables (all but the two calendar functions)
ON_TABLES = [k for k in QUERIES if not k.startswith("with_fiscal")]
