"""September-start fiscal calendar as built-in Column expressions.

Fixed values of the business calendar: the fiscal year starts on the first
of September; a date belongs to fiscal year ``year(date + 4 months)``
(Sep 2020 .. Aug 2021 is FY2021) and to fiscal quarter
``'Q' || quarter(date + 4 months)`` (Q1 = Sep-Nov, Q2 = Dec-Feb,
Q3 = Mar-May, Q4 = Jun-Aug).

Everything here compiles to JVM expressions (whole-stage codegen); there is no
Python UDF.  ``fiscal_year(col) == fy`` cannot be pushed into a Parquet scan,
so :func:`in_fiscal_year` adds the equivalent date range, which can.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# First month of the fiscal year and the month shift that maps
# it onto January.
FISCAL_YEAR_START_MONTH = 9
FISCAL_MONTH_SHIFT = 4


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fiscal_year(date: str | Column) -> Column:
    """Fiscal year (INT) of a DATE column."""
    return F.year(F.add_months(_col(date), FISCAL_MONTH_SHIFT)).cast("int")


def fiscal_quarter(date: str | Column) -> Column:
    """Fiscal quarter label 'Q1'..'Q4' of a DATE column."""
    return F.concat(F.lit("Q"), F.quarter(F.add_months(_col(date), FISCAL_MONTH_SHIFT)).cast("string"))


def fiscal_year_bounds(fy: int) -> tuple[_dt.date, _dt.date]:
    """[first day, first day of next fiscal year) of fiscal year ``fy``."""
    return (
        _dt.date(fy - 1, FISCAL_YEAR_START_MONTH, 1),
        _dt.date(fy, FISCAL_YEAR_START_MONTH, 1),
    )


def in_fiscal_year(date: str | Column, fy: int) -> Column:
    """``fiscal_year(date) = fy`` written as a date range.

    For every DATE, ``year(add_months(d, 4)) = fy`` holds exactly when
    ``(fy-1)-09-01 <= d < fy-09-01`` (adding months never moves a date across
    a month boundary, so the shifted year changes exactly at September 1st).
    The range form is pushed to Parquet row-group statistics and prunes date
    partitions; the result is identical.
    """
    lo, hi = fiscal_year_bounds(fy)
    d = _col(date)
    return (d >= F.lit(lo)) & (d < F.lit(hi))


def with_fiscal_year(df: DataFrame, date_col: str = "date", name: str = "fiscal_year") -> DataFrame:
    """Enrich every row of ``df`` with the fiscal year of ``date_col``."""
    return df.withColumn(name, fiscal_year(date_col))


def with_fiscal_quarter(df: DataFrame, date_col: str = "date", name: str = "fiscal_quarter") -> DataFrame:
    """Enrich every row of ``df`` with the fiscal quarter label of ``date_col``."""
    return df.withColumn(name, fiscal_quarter(date_col))


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``get_fiscal_year(d)`` and ``get_fiscal_quarter(d)`` callable from SQL.

    SQL functions defined with ``RETURN <expr>`` are inlined by the analyzer,
    so they run as the same built-in expressions as the Column helpers.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION get_fiscal_year(calendar_date DATE) "
        f"RETURNS INT RETURN CAST(year(add_months(calendar_date, {FISCAL_MONTH_SHIFT})) AS INT)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION get_fiscal_quarter(calendar_date DATE) "
        f"RETURNS STRING RETURN concat('Q', CAST(quarter(add_months(calendar_date, {FISCAL_MONTH_SHIFT})) AS STRING))"
    )
