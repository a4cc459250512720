"""Hand-made business tables with hot keys, for the skew tests.

Customer 8 holds about a third of all sales rows, two thirds of the
customers are in market NATION_19, 90% of the products are in division
HOT, quantities are 1..5 (ties everywhere) and names are shared by many
codes.  Some rates, sales and forecasts are missing on purpose.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.schema import SCHEMAS
from salescope.sources.calendar import build_dim_date

N_CUST, N_PROD = 400, 300
FIRST, LAST = dt.date(1996, 9, 1), dt.date(2000, 8, 1)  # FY1997 .. FY2000
LAST_SALE = dt.date(1999, 8, 1)                          # no sales in FY2000


def _h(*cols) -> F.Column:
    return F.abs(F.xxhash64(*cols))


def _cast(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])


def build(spark: SparkSession) -> dict[str, DataFrame]:
    dim_date = build_dim_date(spark, FIRST, LAST, "month")
    months = dim_date.select(F.col("calendar_date").alias("date"))
    cust = spark.range(1, N_CUST + 1).select(F.col("id").alias("customer_code"))
    prod = spark.range(1, N_PROD + 1).select(F.col("id").alias("product_code"))
    keys = (
        months.select("date", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(N_CUST).cast("long"))).alias("customer_code"))
        .select("date", "customer_code",
                F.explode(F.sequence(F.lit(1).cast("long"), F.lit(N_PROD).cast("long"))).alias("product_code"))
        .withColumn("h", _h("date", "customer_code", "product_code"))
    )
    hot = F.col("customer_code") == 8
    sold_keys = keys.where((F.col("date") <= F.lit(LAST_SALE)) & (hot | (F.col("h") % 200 == 0)))
    sales = sold_keys.select(
        "date", "customer_code", "product_code",
        F.when(F.col("h") % 97 == 0, F.lit(None)).otherwise(F.col("h") % 5 + 1).alias("sold_quantity"))
    forecast = keys.where(
        ((F.col("date") <= F.lit(LAST_SALE)) & (hot | (F.col("h") % 200 == 0)) & (F.col("h") % 10 != 3))
        | (F.col("h") % 211 == 1)
    ).select("date", "customer_code", "product_code",
             F.greatest(F.lit(0), F.col("h") % 5 + 1 + F.col("h") % 3 - 1).alias("forecast_quantity"))
    post = sold_keys.where(F.col("h") % 30 != 7).select(
        "date", "customer_code", "product_code",
        ((F.col("h") % 9) / 100).alias("discounts_pct"), ((F.col("h") % 4) / 100).alias("other_deductions_pct"))
    years = F.explode(F.sequence(F.lit(1997), F.lit(2000))).alias("fiscal_year")
    price = prod.select("product_code", years).select(
        "product_code", "fiscal_year",
        (F.lit(Decimal("10.0000")) + (F.col("product_code") % 50) + (F.col("fiscal_year") - 1997) * F.lit(Decimal("0.2575")))
        .alias("gross_price"))
    pre = cust.where(F.col("customer_code") % 37 != 0).select("customer_code", years).select(
        "customer_code", "fiscal_year", (((F.col("customer_code") * 3 + F.col("fiscal_year")) % 20 + 5) / 100)
        .alias("pre_invoice_discount_pct"))
    dim_customer = cust.select(
        "customer_code",
        F.when(F.col("customer_code") % 5 == 0, F.lit("FURNITURE-6"))
        .otherwise(F.concat(F.lit("C"), (F.col("customer_code") % 11).cast("string"))).alias("customer"),
        F.when(F.col("customer_code") % 3 != 0, F.lit("NATION_19"))
        .otherwise(F.concat(F.lit("M"), (F.col("customer_code") % 7).cast("string"))).alias("market"),
        F.lit("R").alias("region"))
    dim_product = prod.select(
        "product_code",
        F.concat(F.lit("P"), (F.col("product_code") % 40).cast("string")).alias("product"),
        F.when(F.col("product_code") % 10 != 0, F.lit("HOT"))
        .otherwise(F.concat(F.lit("D"), (F.col("product_code") % 3).cast("string"))).alias("division"))
    frames = {
        "fact_sales_monthly": sales, "fact_forecast_monthly": forecast, "fact_gross_price": price,
        "fact_pre_invoice_deductions": pre, "fact_post_invoice_deductions": post,
        "dim_customer": dim_customer, "dim_product": dim_product, "dim_date": dim_date,
    }
    return {name: _cast(df, name) for name, df in frames.items()}
