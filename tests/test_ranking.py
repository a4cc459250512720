import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import D, dec, rows
from salescope import operators as op
from salescope.operators import rank
from salescope.operators.rank import rank_within, top_dense_rank


@pytest.fixture
def qty(spark):
    # golden tie sequence 9, 7, 7, 5 in division A; one more division and a NULL one
    data = [("A", "p1", 9), ("A", "p3", 7), ("A", "p2", 7), ("A", "p4", 5),
            ("B", "q1", 1), (None, "z1", 4), (None, "z2", 4), ("A", "p5", None)]
    return spark.createDataFrame(data, "division string, product string, total_qty bigint")


def windowed(df, kinds=("rnk", "drnk", "row_num")):
    """The plain window form."""
    base = Window.partitionBy("division").orderBy(F.col("total_qty").desc_nulls_last())
    numbered = Window.partitionBy("division").orderBy(F.col("total_qty").desc_nulls_last(), "product")
    made = {"rnk": F.rank().over(base), "drnk": F.dense_rank().over(base), "row_num": F.row_number().over(numbered)}
    return df.select("*", *[made[k].cast("long").alias(k) for k in kinds])


@pytest.mark.parametrize("split", [1_000_000, 2, 1])
def test_rank_golden(qty, split, monkeypatch):
    monkeypatch.setattr(rank, "SPLIT_ROWS", split)
    out = rank_within(qty, ["division"], "total_qty", ["product"])
    got = {r.product: (r.rnk, r.drnk, r.row_num) for r in out.collect()}
    # RANK 1,2,2,4 / DENSE_RANK 1,2,2,3 / ROW_NUMBER 1,2,3,4 (ties by product)
    assert [got[p] for p in ["p1", "p2", "p3", "p4"]] == [(1, 1, 1), (2, 2, 2), (2, 2, 3), (4, 3, 4)]
    assert got["p5"] == (5, 4, 5)  # NULL quantity sorts last under DESC
    assert got["q1"] == (1, 1, 1)
    assert got["z1"] == (1, 1, 1) and got["z2"] == (1, 1, 2)  # NULL division is one group


@pytest.mark.parametrize("split", [1_000_000, 300, 3, 1])
@pytest.mark.parametrize("kinds", [("rnk", "drnk", "row_num"), ("drnk",), ("rnk",), ("row_num",), ("drnk", "rnk")])
def test_equals_window_on_many_partitions(spark, kinds, split, monkeypatch):
    monkeypatch.setattr(rank, "SPLIT_ROWS", split)
    # one hot group holding most rows, many ties, spread over many partitions
    df = spark.range(0, 2000, 1, 16).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 13).cast("string"))).alias("division"),
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("product"),
        (F.col("id") * 7919 % 97).alias("total_qty"),
    )
    a = rank_within(df, ["division"], "total_qty", ["product"], kinds=kinds)
    b = windowed(df, kinds)
    assert a.columns == b.columns
    assert rows(a) == rows(b)


@pytest.mark.slow
@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("extra", [[], ["note"]])
def test_equals_window_with_many_values(spark, extra, reuse, monkeypatch):
    monkeypatch.setattr(rank, "SPLIT_ROWS", 2000)
    # 200,000 distinct values in 12 partitions, one group with most rows, one value with a third of them
    h = F.abs(F.xxhash64("id"))
    df = spark.range(0, 300_000, 1, 12).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("division"),
        F.concat(F.lit("p"), h.cast("string")).alias("product"),
        F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(h % 100_000_000).alias("total_qty"),
        *[h.cast("string").alias(c) for c in extra],
    )
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        keys = ["division", "product", "rnk", "drnk", "row_num"]
        a, b = rank_within(df, ["division"], "total_qty", ["product"]), windowed(df)
        assert a.columns == b.columns
        assert a.select(keys).exceptAll(b.select(keys)).count() == 0 and a.count() == 300_000
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_no_group_and_no_tie_breaker(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (None,)], "total_qty long")
    got = sorted((r.total_qty or 0, r.rnk, r.drnk, r.row_num) for r in rank_within(df, [], "total_qty").collect())
    assert got == [(0, 4, 3, 4), (1, 3, 2, 3), (3, 1, 1, 1), (3, 1, 1, 2)]


def test_top_dense_rank_keeps_ties(qty):
    out = top_dense_rank(qty, ["division"], "total_qty", 2)
    # dense rank <= 2 in A: 9 and both 7s -> 3 rows (more than n, as in the reference)
    got = sorted((r.division or "", r.product, r.drnk) for r in out.collect())
    assert got == [("", "z1", 1), ("", "z2", 1), ("A", "p1", 1), ("A", "p2", 2), ("A", "p3", 2), ("B", "q1", 1)]


def _division_tables(make_tables):
    s = [(D("2020-10-01"), 1, 1, 9), (D("2020-10-01"), 1, 2, 7), (D("2020-11-01"), 1, 3, 7),
         (D("2020-11-01"), 1, 4, 5), (D("2020-11-01"), 1, 5, 2), (D("2021-10-01"), 1, 1, 100)]
    prod = [(1, "a", "X"), (2, "b", "X"), (3, "c", "X"), (4, "d", "X"), (5, "e", "Y")]
    return make_tables(fact_sales_monthly=s, dim_product=prod)


def test_product_reports(make_tables):
    t = _division_tables(make_tables)
    assert rows(op.rank_products(t, 2021), "product", "rnk") == [("a", 1), ("b", 2), ("c", 2), ("d", 4), ("e", 1)]
    assert rows(op.dense_rank_products(t, 2021), "product", "drnk") == [("a", 1), ("b", 2), ("c", 2), ("d", 3), ("e", 1)]
    assert rows(op.row_number_products(t, 2021), "product", "row_num") == [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 1)]
    assert rows(op.top_products_per_division(t, 2021, 2), "product") == [("a",), ("b",), ("c",), ("e",)]
    cmp = op.rank_comparison(t, 2021)
    assert cmp.columns == ["division", "product", "total_qty", "rnk", "drnk", "row_num"]
    assert [r.product for r in cmp.collect()] == ["a", "b", "c", "d", "e"]  # ordered report


def test_division_total_alongside_rows(make_tables):
    t = _division_tables(make_tables)
    got = op.division_total_alongside_rows(t, 2021).collect()
    assert [(r.division, r.product, r.total_qty_by_division) for r in got] == [
        ("X", "a", 28), ("X", "b", 28), ("X", "c", 28), ("X", "d", 28), ("Y", "e", 2)]


def test_names_of_divisions_and_products_ignore_case_and_accents(make_tables):
    # one rule for every report: "Café" = "CAFE", "x" = "X"
    s = [(D("2020-10-01"), 1, code, qty) for code, qty in ((1, 5), (2, 4), (3, 7), (4, 1))]
    t = make_tables(fact_sales_monthly=s, dim_product=[(1, "Café", "X"), (2, "CAFE", "x"), (3, "tea", "X"), (4, "Tea", "Y")])
    assert rows(op.product_qty(t, 2021), "product", "total_qty") == [("CAFE", 9), ("Tea", 1), ("tea", 7)]
    assert [(r.product, r.rnk, r.drnk, r.row_num) for r in op.rank_comparison(t, 2021, ordered=False).orderBy("total_qty").collect()] == [("Tea", 1, 1, 1), ("tea", 2, 2, 2), ("CAFE", 1, 1, 1)]
    assert rows(op.top_products_per_division(t, 2021, 1), "product") == [("CAFE",), ("Tea",)]
    assert rows(op.division_total_alongside_rows(t, 2021), "product", "total_qty_by_division") == [("CAFE", 16), ("Café", 16), ("Tea", 1), ("tea", 16)]


def test_division_total_equals_window(make_tables, spark):
    t = _division_tables(make_tables)
    rows_ = t.sales.join(t.dim_product, "product_code").join(
        t.dim_date.withColumnRenamed("calendar_date", "date"), "date").where("fiscal_year = 2021")
    w = rows_.select("division", "product", F.sum("sold_quantity").over(Window.partitionBy("division"))
                     .cast("long").alias("total_qty_by_division"))
    assert rows(op.division_total_alongside_rows(t, 2021, ordered=False)) == rows(w)


def test_lag_lead_positional(make_tables):
    # A skipped fiscal year -> LAG/LEAD take the previous/next existing year
    s = [(D("2019-10-01"), 1, 1, 1000000), (D("2021-10-01"), 1, 1, 2000000)]
    t = make_tables(fact_sales_monthly=s, dim_customer=[(1, "c", "India", "APAC")],
                    fact_gross_price=[(1, 2020, dec("1.0000")), (1, 2022, dec("1.0000"))])
    prev = op.gross_sales_prev_year(t).collect()
    assert [(r.fiscal_year, r.gross_sales_mln, r.prev_year_sales_mln) for r in prev] == [(2020, 1.0, None), (2022, 2.0, 1.0)]
    nxt = op.gross_sales_next_year(t).collect()
    assert [(r.fiscal_year, r.next_year_sales_mln) for r in nxt] == [(2020, 2.0), (2022, None)]
