"""Forecast versus actual: the base relation and the accuracy reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.fiscal import fiscal_year as fiscal_year_of
from salescope.functions.money import accuracy_pct
from salescope.operators.common import date_bounds_filter, fiscal_dates, merge_names
from salescope.sources.tables import SalesTables

KEYS3 = ["customer_code", "date", "product_code"]


def forecast_accuracy_base(t: SalesTables, fiscal_years: int | Iterable[int] | None = None) -> DataFrame:
    """O-10: one row per forecast row up to the last sales month.

    forecast ⨝ dim_date ⟕ sales (customer, date, product) ⨝ dim_customer;
    a forecast without a sale keeps ``sold_quantity`` NULL, a sale without a
    forecast is dropped.  ``net_error = forecast - ifnull(sold, 0)`` (signed,
    + means over-forecast), ``abs_error = |net_error|``.  Only forecast dates
    up to MAX(date) of the *whole* sales table are kept (a scalar subquery,
    evaluated once; on date-partitioned facts it prunes partitions at run
    time).

    ``fiscal_years`` restricts the relation to those years; besides the
    dim_date filter it bounds both fact scans to the years' date range.  The
    sales side of the left join could not be pruned through the dimension
    join otherwise.
    """
    rows = _errors(t, fiscal_years).join(t.dim_customer.select("customer_code", "customer", "market"), "customer_code")
    return rows.select("customer_code", "customer", "market", "fiscal_year", "forecast_quantity", "sold_quantity", "date", "net_error", "abs_error")


def _errors(t: SalesTables, fiscal_years: int | Iterable[int] | None) -> DataFrame:
    """The base relation without dim_customer."""
    f = t.forecast.where(F.col("date") <= last_sale_date(t))
    s = t.sales.select(*KEYS3, "sold_quantity")
    if fiscal_years is not None:
        f = f.where(date_bounds_filter(t, F.col("date"), fiscal_years))
        s = s.where(date_bounds_filter(t, F.col("date"), fiscal_years))
    rows = (
        f.join(fiscal_dates(t, fiscal_years), "date")
        .join(s, KEYS3, "left")
    )
    net = F.col("forecast_quantity").cast("long") - F.coalesce(F.col("sold_quantity").cast("long"), F.lit(0))
    return rows.select(*KEYS3, "fiscal_year", "forecast_quantity", "sold_quantity", net.alias("net_error"), F.abs(net).alias("abs_error"))


def last_sale_date(t: SalesTables) -> Column:
    """MAX(date) of the whole sales table as a scalar subquery (evaluated
    once per query; identical uses are shared by Spark).

    Where a catalog lists the sales table's date folders, only those from its
    newest one on are read.  The folders before it are read only if those hold
    no row: the second subquery's bound is null otherwise, which selects no
    folder at run time.
    """
    dates = t.sales.select("date")
    if t.newest_sales_date is None:
        return dates.agg(F.max("date")).scalar()
    newest = F.lit(t.newest_sales_date)
    last = dates.where(F.col("date") >= newest).agg(F.max("date")).scalar()
    before = dates.where(F.col("date") < F.when(last.isNull(), newest)).agg(F.max("date")).scalar()
    return F.coalesce(last, before)


SUMS = {"total_sold_qty": "sold_quantity", "total_forecast_qty": "forecast_quantity",
        "total_net_error": "net_error", "total_abs_error": "abs_error"}


def accuracy_metrics(base: DataFrame, keys: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """B-4: Σsold, Σforecast, Σnet_error, Σabs_error and the accuracy % per ``keys``.

    Σsold ignores NULLs, so a group without any sale has total_sold_qty NULL
    (not 0) while its errors count the missing sales as 0."""
    return _with_accuracy(base.groupBy(*keys).agg(*extra, *[F.sum(c).cast("long").alias(k) for k, c in SUMS.items()]))


def _with_accuracy(sums: DataFrame) -> DataFrame:
    return sums.withColumn("forecast_accuracy_pct", accuracy_pct("total_abs_error", "total_forecast_qty"))


def _customer_sums(t: SalesTables, fiscal_years: int | Iterable[int], *keys: str) -> DataFrame:
    """The sums per customer code (and ``keys``), joined to dim_customer only then."""
    sums = _errors(t, fiscal_years).groupBy("customer_code", *keys).agg(*[F.sum(c).cast("long").alias(k) for k, c in SUMS.items()])
    return sums.join(t.dim_customer.select("customer_code", "customer", "market"), "customer_code").select("customer_code", "customer", "market", *keys, *SUMS)


def _has_sales_through(t: SalesTables, fiscal_year: int) -> Column:
    """Guard: the fiscal year is not after the year of the last sale.

    The reference compares the year number with MAX(date) directly; its
    stated intent (no report for years without actual sales) is kept by
    comparing fiscal years."""
    return F.lit(int(fiscal_year)) <= fiscal_year_of(last_sale_date(t))


def forecast_accuracy_by_customer(t: SalesTables, fiscal_year: int) -> DataFrame:
    """O-11: accuracy metrics per customer for one fiscal year, best first.
    -> (customer_code, customer, market, total_sold_qty, total_forecast_qty,
        total_net_error, total_abs_error, forecast_accuracy_pct)"""
    # customer_code breaks ties: equal accuracies stay splittable across
    # range partitions instead of landing in one sort task
    return (
        _with_accuracy(_customer_sums(t, fiscal_year)).where(_has_sales_through(t, fiscal_year))
        .orderBy(F.col("forecast_accuracy_pct").desc_nulls_last(), F.col("customer_code").asc())
    )


def forecast_accuracy_by_market(t: SalesTables, fiscal_year: int) -> DataFrame:
    """O-12: accuracy metrics per market plus the number of distinct
    customers, best first.
    -> (market, customer_count, total_sold_qty, ..., forecast_accuracy_pct)"""
    sums = _customer_sums(t, fiscal_year).where(_has_sales_through(t, fiscal_year))
    # one row per market and code first, so a code counts once however often dim_customer holds it
    codes = merge_names(sums, ["market"], ["customer_code"], **{k: F.sum(k) for k in SUMS})
    merged = merge_names(codes, ["market"], customer_count=F.count("customer_code"), **{k: F.sum(k) for k in SUMS})
    return _with_accuracy(merged).orderBy(F.col("forecast_accuracy_pct").desc_nulls_last(), F.col("market").asc())


def forecast_decline_lag(t: SalesTables, y1: int, y2: int) -> DataFrame:
    """O-13: customers whose accuracy in ``y2`` is below the previous
    existing year's (LAG over fiscal year per customer), y2 rows only.
    -> (customer_code, customer, market, fiscal_year, total_sold_qty,
        total_forecast_qty, total_net_error, total_abs_error,
        forecast_accuracy_pct, prev_year_accuracy)

    The y2 filter stays above the window: pushing it below would empty the
    LAG.  Each window group is one customer's (at most two) years."""
    w = Window.partitionBy("customer_code").orderBy("fiscal_year")
    return (
        _with_accuracy(_customer_sums(t, sorted({int(y1), int(y2)}), "fiscal_year"))
        .withColumn("prev_year_accuracy", F.lag("forecast_accuracy_pct", 1).over(w))
        .where((F.col("forecast_accuracy_pct") < F.col("prev_year_accuracy")) & (F.col("fiscal_year") == int(y2)))
    )


def forecast_decline_pivot(t: SalesTables, y1: int, y2: int) -> DataFrame:
    """O-14: both years' accuracy side by side (conditional sums in one aggregate),
    customers whose accuracy fell, worst decline first.
    -> (customer_code, customer, market, accuracy_y1, accuracy_y2, accuracy_change)"""
    errors = _errors(t, sorted({int(y1), int(y2)}))

    def of(year: int, c: str) -> Column:
        return F.sum(F.when(F.col("fiscal_year") == int(year), F.col(c))).cast("long")

    sums = errors.groupBy("customer_code").agg(
        of(y1, "abs_error").alias("abs_y1"), of(y1, "forecast_quantity").alias("forecast_y1"),
        of(y2, "abs_error").alias("abs_y2"), of(y2, "forecast_quantity").alias("forecast_y2"),
    )
    both = sums.select("customer_code", accuracy_pct("abs_y1", "forecast_y1").alias("accuracy_y1"), accuracy_pct("abs_y2", "forecast_y2").alias("accuracy_y2"))
    return (
        both.where(F.col("accuracy_y2") < F.col("accuracy_y1"))
        .join(t.dim_customer.select("customer_code", "customer", "market"), "customer_code")
        .select("customer_code", "customer", "market", "accuracy_y1", "accuracy_y2",
                (F.col("accuracy_y2") - F.col("accuracy_y1")).alias("accuracy_change"))
        .orderBy(F.col("accuracy_change").asc(), F.col("customer_code").asc())
    )
