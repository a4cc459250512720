import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import D
from salescope.functions.fiscal import (
    fiscal_quarter,
    fiscal_year,
    fiscal_year_bounds,
    in_fiscal_year,
    register_sql_functions,
    with_fiscal_quarter,
    with_fiscal_year,
)


def _one(spark, col_fn, d):
    return spark.createDataFrame([(d,)], "d date").select(col_fn("d").alias("v")).first()["v"]


def test_fiscal_year_golden(spark):
    # worked examples: Sep-2020..Aug-2021 is FY2021
    assert _one(spark, fiscal_year, D("2020-09-01")) == 2021
    assert _one(spark, fiscal_year, D("2021-08-31")) == 2021
    assert _one(spark, fiscal_year, D("2021-09-01")) == 2022


def test_fiscal_quarter_golden(spark):
    assert _one(spark, fiscal_quarter, D("2020-09-15")) == "Q1"
    assert _one(spark, fiscal_quarter, D("2020-12-15")) == "Q2"
    assert _one(spark, fiscal_quarter, D("2021-06-15")) == "Q4"


def test_fiscal_quarter_every_month(spark):
    months = [dt.date(2020 + (m < 9), m, 15) for m in [9, 10, 11, 12, 1, 2, 3, 4, 5, 6, 7, 8]]
    df = spark.createDataFrame([(d,) for d in months], "d date").select("d", fiscal_quarter("d").alias("q"))
    got = {r["d"].month: r["q"] for r in df.collect()}
    assert [got[m] for m in [9, 10, 11, 12, 1, 2, 3, 4, 5, 6, 7, 8]] == ["Q1"] * 3 + ["Q2"] * 3 + ["Q3"] * 3 + ["Q4"] * 3


def test_month_end_clamp(spark):
    # Oct-31 + 4 months clamps to Feb-28/29: still the same fiscal year
    assert _one(spark, fiscal_year, D("2019-10-31")) == 2020
    assert _one(spark, fiscal_year, D("2020-08-31")) == 2020
    assert _one(spark, fiscal_quarter, D("2019-10-31")) == "Q1"


def test_enrichment_keeps_rows(spark):
    df = spark.createDataFrame([(1, D("2020-09-01")), (2, D("2020-08-31")), (3, None)], "id int, date date")
    out = with_fiscal_quarter(with_fiscal_year(df), "date").orderBy("id").collect()
    assert [(r.fiscal_year, r.fiscal_quarter) for r in out] == [(2021, "Q1"), (2020, "Q4"), (None, None)]


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT get_fiscal_year(DATE'2021-09-01') AS y, get_fiscal_quarter(DATE'2020-12-15') AS q").first()
    assert (r.y, r.q) == (2022, "Q2")


def test_bounds():
    assert fiscal_year_bounds(2021) == (D("2020-09-01"), D("2021-09-01"))


@pytest.mark.parametrize("fy", [1901, 2000, 2021, 2024, 2100])
def test_range_form_equals_function(spark, fy):
    # every day of the three years around fy: the pushed-down date range is
    # exactly the fiscal-year predicate (leap days and month ends included)
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(dt.date(fy - 2, 1, 1)), F.lit(dt.date(fy + 1, 12, 31)))).alias("d"))
    bad = days.where((fiscal_year("d") == fy) != in_fiscal_year("d", fy)).count()
    assert bad == 0


def test_no_python_udf_in_plan(spark):
    df = spark.range(3).select(F.date_add(F.lit(D("2020-01-01")), F.col("id").cast("int")).alias("d"))
    plan = with_fiscal_quarter(with_fiscal_year(df, "d"), "d")._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_daily_calendar(spark):
    from salescope.sources.calendar import build_dim_date
    d = build_dim_date(spark, D("2020-08-30"), D("2020-09-02"), "day").orderBy("calendar_date").collect()
    assert [(r.calendar_date.isoformat(), r.fiscal_year) for r in d] == [
        ("2020-08-30", 2020), ("2020-08-31", 2020), ("2020-09-01", 2021), ("2020-09-02", 2021)]
    m = build_dim_date(spark, D("1994-09-01"), D("2002-08-01"), "month")
    assert m.count() == 96 and m.select("fiscal_year").distinct().count() == 8
