"""Gold / Silver market badge on yearly sold quantity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.fiscal import fiscal_year as fiscal_year_of
from salescope.functions.fiscal import in_fiscal_year
from salescope.operators.common import merge_names, text_equals
from salescope.sources.tables import SalesTables

# Fixed values of the reference: quantity threshold (strictly greater is
# Gold), the badge names, and the market used when an empty one is given.
DEFAULT_THRESHOLD = 5_000_000
GOLD = "Gold"
SILVER = "Silver"
DEFAULT_MARKET = "india"


def _badge(qty: Column, threshold: int) -> Column:
    return F.when(qty > F.lit(int(threshold)), F.lit(GOLD)).otherwise(F.lit(SILVER))


def _year_sales(t: SalesTables, fiscal_year: int) -> DataFrame:
    # fiscal year by the function on the sale date; the equivalent date range
    # is added so the predicate reaches the scan
    return t.sales.where(
        in_fiscal_year("date", fiscal_year) & (fiscal_year_of("date") == int(fiscal_year))
    ).select("customer_code", "sold_quantity")


def market_badge(t: SalesTables, market: str | None, fiscal_year: int,
                 threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """O-15: one row (market, fiscal_year, total_qty, badge).

    An empty market means 'india'; markets match case- and accent-insensitively.  With no
    matching sale the quantity is 0 and the badge Silver — never an error.
    The result is a one-row DataFrame: nothing is collected to the driver.
    """
    m = DEFAULT_MARKET if market == "" else market
    cust = t.dim_customer.where(text_equals("market", m)).select("customer_code")
    rows = _year_sales(t, fiscal_year).join(cust, "customer_code")
    # no row at all leaves the quantity at its default 0; rows whose
    # quantities are all NULL give NULL (and Silver)
    qty = F.when(F.count(F.lit(1)) == 0, F.lit(0).cast("long")).otherwise(F.sum("sold_quantity").cast("long"))
    agg = rows.agg(qty.alias("total_qty"))
    return agg.select(
        F.lit(m).cast("string").alias("market"),
        F.lit(int(fiscal_year)).alias("fiscal_year"),
        "total_qty",
        _badge(F.col("total_qty"), threshold).alias("badge"),
    )


def market_badges(t: SalesTables, fiscal_year: int, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """O-15, all-markets form: one row per market of dim_customer.
    -> (market, fiscal_year, total_qty, badge); markets without sales get 0,
    and spellings that differ only in case or accents are one market."""
    per_market = (
        _year_sales(t, fiscal_year)
        .join(t.dim_customer.select("customer_code", "market"), "customer_code")
        .groupBy("market").agg(F.sum("sold_quantity").cast("long").alias("qty"))
    )
    markets = t.dim_customer.select("market").distinct()
    merged = merge_names(markets.join(per_market, "market", "left"), ["market"], qty=F.sum("qty"))
    qty = F.coalesce(F.col("qty"), F.lit(0).cast("long"))
    return merged.select(
        "market",
        F.lit(int(fiscal_year)).alias("fiscal_year"),
        qty.alias("total_qty"),
        _badge(qty, threshold).alias("badge"),
    )
