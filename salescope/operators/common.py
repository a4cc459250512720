"""Join and filter helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.sources.tables import SalesTables


def _years(fiscal_years: int | Iterable[int]) -> list[int]:
    return [int(fiscal_years)] if isinstance(fiscal_years, int) else [int(y) for y in fiscal_years]


def fiscal_dates(t: SalesTables, fiscal_years: int | Iterable[int] | None = None) -> DataFrame:
    """Rows of dim_date (as ``date``, ``fiscal_year``), optionally for some years.

    dim_date has one row per calendar date, so it is bounded by the calendar
    (at most 366 rows per fiscal year) whatever the data volume: broadcasting
    it is always safe and keeps the fact side from shuffling.
    """
    dd = t.dim_date.select(F.col("calendar_date").alias("date"), "fiscal_year")
    if fiscal_years is not None:
        dd = dd.where(F.col("fiscal_year").isin(_years(fiscal_years)))
    return F.broadcast(dd)


def every_price(t: SalesTables) -> DataFrame:
    """fact_gross_price of all years, joined by sort-merge.

    It has a row per product and year, so nothing bounds it, and Spark's
    estimate (compressed bytes, or those of the products where years are
    generated) may lie below the broadcast threshold although the driver
    can't hold its rows.  Reports join it to sums, never to single sales."""
    return t.gross_price.hint("merge")


def date_bounds_filter(t: SalesTables, date_col: Column, fiscal_years: int | Iterable[int]) -> Column:
    """``min <= date <= max`` over the dim_date rows of ``fiscal_years``.

    Redundant with the inner join on dim_date (every joined fact date lies
    in that range), so it never changes a result, but unlike the join it
    reaches the fact scan: on date-partitioned facts it is a runtime
    partition filter, elsewhere it drops rows before any join.  The bounds
    come from dim_date itself, so no calendar rule is assumed; both are read
    from one scalar subquery (Spark runs an identical subquery once).
    """
    dd = t.dim_date.where(F.col("fiscal_year").isin(_years(fiscal_years)))
    bounds = dd.agg(F.struct(F.min("calendar_date").alias("lo"), F.max("calendar_date").alias("hi"))).scalar()
    return (date_col >= bounds.getField("lo")) & (date_col <= bounds.getField("hi"))


# Fixed value: Spark's ICU collation closest to the reference engine's
# default (case- and accent-insensitive, no padding).
TEXT_COLLATION = "UNICODE_CI_AI"


def text_equals(col: str | Column, value: str | None) -> Column:
    """String match under a case- and accent-insensitive collation, like the
    reference engine's default ('india' matches 'India', 'México' matches
    'MEXICO'; trailing spaces still count).  Used for every market and
    customer-name filter; these filters run on dimension tables."""
    c = F.col(col) if isinstance(col, str) else col
    return F.collate(c, TEXT_COLLATION) == F.collate(F.lit(value).cast("string"), TEXT_COLLATION)


def same_text(c: str) -> Column:
    """A key that is equal for names that differ only in case or accents."""
    return F.collate(F.col(c), TEXT_COLLATION)


def merge_names(df: DataFrame, names: Sequence[str], keys: Sequence[str] = (), **sums: Column) -> DataFrame:
    """Merge rows whose ``names`` differ only in case or accents, as the
    reference engine's default collation does when it groups: one row per
    (names, ``keys``) with the smallest spelling and the given aggregates.
    ``df`` is already aggregated by the exact names, so this reads few rows."""
    same = [same_text(c).alias(f"_{c}") for c in names]
    out = df.groupBy(*same, *keys).agg(*[F.min(c).alias(c) for c in names], *[a.alias(k) for k, a in sums.items()])
    return out.drop(*[f"_{c}" for c in names])


# Bits of a code filter: 128 KB, whatever the number of codes.
FILTER_BITS = 1 << 20


def code_filter(codes: DataFrame, code: str) -> Column:
    """A condition on ``code`` that holds for every value in ``codes`` and for
    few others: a bitmap of hashed codes as a scalar subquery.

    Unlike a semi-join it needs neither a broadcast of all codes nor an exchange
    of the rows it is put on, so it can stand on a fact scan whatever the
    number of codes.  It is no replacement for the exact join."""
    words = FILTER_BITS // 64

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))

    def bit(c: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (place(c) % 64).cast("int"))

    def word(c: Column) -> Column:
        return F.shiftright(place(c), 6).cast("int")

    own = codes.select(word(F.col(code)).alias("word"), bit(F.col(code)).alias("bits"))
    every = codes.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    table = own.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    bitmap = table.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"])).scalar()
    return F.get(bitmap, word(F.col(code))).bitwiseAND(bit(F.col(code))) != 0
