"""RANK / DENSE_RANK / ROW_NUMBER within groups, safe for hot groups.

A window ``PARTITION BY division`` sends every row of a division to one
task.  :func:`rank_within` computes the same numbers by ranges of the total
order (value descending, tie-breakers ascending), with one plan at every size:

1. a hash picks about one row in ``SPLIT_ROWS`` as a splitter of its group: few
   enough to broadcast (a thousand for a billion rows), none in small groups;
2. one shuffle by (group, range), in which windows number the rows, ranks and
   distinct values of a range; ties are cut by their tie-breakers like any rows;
3. a scan over the summaries of a cut group's ranges (rows, distinct values,
   first and last value) gives what stands before each range, and where a value
   that spans ranges began; it is broadcast back to the rows.

Splitters only decide how the work is cut; any choice of them gives the same
ranks, and a hash makes the same choice wherever the plan is run again.
Nothing runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("rnk", "drnk", "row_num")
# Rows of a range on average; a group of fewer is seldom cut.
SPLIT_ROWS = 1_000_000


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (a NULL group is a
    window partition too); the right side's key columns are dropped."""
    r = right
    cond = None
    for k in keys:
        r = r.withColumnRenamed(k, f"_r_{k}")
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def _precedes(splitter: Column, value: str, ties: Sequence[str]) -> Column:
    """Whether a splitter stands before a row: larger values first, NULLs last;
    then smaller tie-breakers, NULLs first."""
    before: Column = F.lit(False)
    for i, c in reversed(list(enumerate([value, *ties]))):
        x, y = splitter[f"k{i}"], F.col(c)
        first = (x > y) | (x.isNotNull() & y.isNull()) if i == 0 else (x < y) | (x.isNull() & y.isNotNull())
        before = F.coalesce(first, F.lit(False)) | (x.eqNullSafe(y) & before)
    return before


def rank_within(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: str,
    tie_breakers: Sequence[str] = (),
    kinds: Sequence[str] = KINDS,
) -> DataFrame:
    """Add rank columns (``rnk``, ``drnk``, ``row_num``; LONG) of
    ``order_by`` descending (NULLs last) within ``partition_by``.  RANK and
    DENSE_RANK see only the value; ROW_NUMBER breaks ties by ``tie_breakers``
    ascending (NULLs first), without any by the other columns."""
    cols, P = df.columns, list(partition_by)
    ties = list(tie_breakers) or [c for c in cols if c not in (*P, order_by)]
    picked = df.where(F.pmod(F.xxhash64(order_by, *ties), F.lit(SPLIT_ROWS)) == 0)
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate([order_by, *ties])])
    # a row in SPLIT_ROWS: broadcast by that bound
    splitters = F.broadcast(picked.groupBy(*P).agg(F.collect_set(key).alias("_splitters")))
    rows = _join_null_safe(df, splitters, P, "left")
    place = F.size(F.filter(F.coalesce("_splitters", F.array()), lambda s: _precedes(s, order_by, ties)))
    rows = rows.withColumns({"_range": place, "_cut": F.col("_splitters").isNotNull()}).drop("_splitters")
    part = Window.partitionBy(*P, "_range")
    by_value, by_row = part.orderBy(F.col(order_by).desc_nulls_last()), part.orderBy(F.col(order_by).desc_nulls_last(), *ties)
    rows = rows.withColumn("_i", F.row_number().over(by_row)).withColumns({"_r": F.rank().over(by_value), "_d": F.dense_rank().over(by_value)})
    # what stands before each range of a cut group
    value = F.struct(F.col(order_by).alias("v"))
    ranges = rows.groupBy(*P, "_range").agg(
        F.max("_cut").alias("_cut"), F.max("_i").alias("_rows"), F.max("_d").alias("_values"), F.max("_r").alias("_last_rank"),
        F.min_by(value, "_i").alias("_first"), F.max_by(value, "_i").alias("_last"),
    ).where("_cut")
    along = Window.partitionBy(*P).orderBy("_range")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_goes_on", F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(along)), F.lit(False)).cast("int"))
    ranges = ranges.withColumns({
        "_rows0": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
        "_values0": F.coalesce(F.sum(F.col("_values") - F.col("_goes_on")).over(earlier), F.lit(0)) - F.col("_goes_on"),
    })
    # the rank of a range's last value, if it begins there; a first value that goes on has that of the last range before with one
    began = F.when((F.col("_values") > 1) | (F.col("_goes_on") == 0), F.col("_rows0") + F.col("_last_rank"))
    ranges = ranges.withColumn("_began", began).withColumn("_since", F.when(F.col("_goes_on") == 1, F.last("_began", ignorenulls=True).over(earlier)))
    starts = F.broadcast(ranges.select(*P, "_range", "_rows0", "_values0", "_since"))  # a splitter more than one each, at most
    out = _join_null_safe(rows, starts, [*P, "_range"], "left")
    before, values = F.coalesce("_rows0", F.lit(0)), F.coalesce("_values0", F.lit(0))
    made = {
        "rnk": F.when((F.col("_d") == 1) & F.col("_since").isNotNull(), F.col("_since")).otherwise(before + F.col("_r")),
        "drnk": values + F.col("_d"),
        "row_num": before + F.col("_i"),
    }
    return out.select(*cols, *[made[k].cast("long").alias(k) for k in kinds])


def top_dense_rank(df: DataFrame, partition_by: Sequence[str], order_by: str, n: int, name: str = "drnk") -> DataFrame:
    """Rows whose DENSE_RANK of ``order_by`` (descending) within
    ``partition_by`` is at most ``n`` (ties may give more than ``n`` rows).

    The ranking runs on the distinct (group, value) pairs, where the rank
    filter lets Spark put a partial WindowGroupLimit before the shuffle: each
    task forwards at most ``n`` values per group, so a group's final window
    holds at most ``n`` x tasks rows however large the group is.  The
    winning values (at most ``n`` per group) are joined back to the rows.
    """
    P = list(partition_by)
    values = df.select(*P, order_by).distinct()
    w = Window.partitionBy(*P).orderBy(F.col(order_by).desc())
    top = values.withColumn(name, F.dense_rank().over(w).cast("long")).where(F.col(name) <= int(n))
    return _join_null_safe(df, top, P + [order_by])
