"""Map the driver's TPC-H-like tables onto the sales star schema.

This module only builds stand-in input in the business schema (the rules are
those of FIXTURES.md §2); it computes none of the reports, and the operators
never rely on how these rows were made.

All rows of the given tables are read.  Business columns decide what a line is:
returned lines are no sales, urgent orders come without a forecast, and a line
has a post-invoice row if it carries a discount or a tax.  So sales without a
forecast, forecasts without a sale and sales without a rate occur; the other
edge cases are in ``tests/skewed_fixture.py``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions.fiscal import fiscal_year
from salescope.sources.tables import SalesTables

# Fixed values of the test-data mapping (FIXTURES.md §2).
PRICE_BASE_YEAR = 1995
RETURNED = "R"
URGENT = "1-URGENT"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate"
    )
    orders = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    return li.join(orders, "l_orderkey").withColumn(
        "month", F.trunc(F.col("l_shipdate").cast("date"), "month")
    )


def _grain():
    return [F.col("month").alias("date"), F.col("o_custkey").alias("customer_code"),
            F.col("l_partkey").alias("product_code")]


def derive_tables(spark: SparkSession, sf_dir: str) -> SalesTables:
    L = _lines(spark, sf_dir)

    # every month from the first to the last ship date
    month = F.trunc(F.col("l_shipdate").cast("date"), "month")
    span = _read(spark, sf_dir, "lineitem").agg(F.min(month).alias("first"), F.max(month).alias("last"))
    months = F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MONTH")))
    dim_date = (
        span.where("first is not null").select(months.alias("calendar_date"))
        .withColumn("fiscal_year", fiscal_year("calendar_date"))
    )
    # every fiscal year of the calendar, generated per row (no join)
    ends = span.select(F.struct(fiscal_year("first").alias("first"), fiscal_year("last").alias("last")).alias("y")).scalar()
    years = F.explode(F.sequence(ends.getField("first"), ends.getField("last")))

    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")

    dim_customer = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("customer_code"),
            F.concat(F.col("c_mktsegment"), F.lit("-"), (F.col("c_custkey") % 7).cast("string")).alias("customer"),
            F.col("n_name").alias("market"),
            F.col("r_name").alias("region"),
        )
    )
    dim_product = part.select(
        F.col("p_partkey").alias("product_code"),
        F.col("p_name").alias("product"),
        F.col("p_type").alias("division"),
    )

    sales = (
        L.where(F.col("l_returnflag") != RETURNED)
        .groupBy(*_grain())
        .agg(F.sum("l_quantity").cast("int").alias("sold_quantity"))
    )
    weight = F.lit(80) + (F.col("l_partkey") * 7 + F.col("l_linenumber") * 13) % 41
    forecast = (
        L.where(F.col("o_orderpriority") != URGENT)
        .groupBy(*_grain())
        .agg(F.floor(F.sum(F.col("l_quantity") * weight) / 100).cast("int").alias("forecast_quantity"))
    )
    post = (
        L.where(F.col("l_discount") + F.col("l_tax") > 0)
        .groupBy(*_grain())
        .agg(
            F.max("l_discount").cast("decimal(5,4)").alias("discounts_pct"),
            F.max("l_tax").cast("decimal(5,4)").alias("other_deductions_pct"),
        )
    )
    # part x fiscal years: retail price grown 1% per year from the base year
    growth = F.lit(Decimal("1")) + F.lit(Decimal("0.01")) * (F.col("fiscal_year") - PRICE_BASE_YEAR)
    gross_price = part.select("p_partkey", "p_retailprice", years.alias("fiscal_year")).select(
        F.col("p_partkey").alias("product_code"),
        "fiscal_year",
        (F.col("p_retailprice").cast("decimal(10,2)") * growth).cast("decimal(15,4)").alias("gross_price"),
    )
    pre = (
        customer.select("c_custkey", years.alias("fiscal_year"))
        .select(
            F.col("c_custkey").alias("customer_code"),
            "fiscal_year",
            ((F.lit(5) + (F.col("c_custkey") * 3 + F.col("fiscal_year")) % 20) * F.lit(Decimal("0.01")))
            .cast("decimal(5,4)").alias("pre_invoice_discount_pct"),
        )
    )
    return SalesTables(
        fact_sales_monthly=sales,
        fact_forecast_monthly=forecast,
        fact_gross_price=gross_price,
        fact_pre_invoice_deductions=pre,
        fact_post_invoice_deductions=post,
        dim_customer=dim_customer,
        dim_product=dim_product,
        dim_date=dim_date,
    )
