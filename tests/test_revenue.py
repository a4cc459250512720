from pyspark.sql import functions as F

from conftest import SF001, D, dec, rows
from salescope import operators as op
from salescope.operators.common import code_filter
from salescope.operators.revenue import net_sales_by_keys, parse_code_list
from salescope.sources.tables import load_tables

P20 = dec("20.0000")


def _base(make_tables, **over):
    """FY2021 (Sep-2020..Aug-2021) fixture: two customers in India/USA."""
    t = dict(
        fact_sales_monthly=[
            (D("2020-09-01"), 1, 100, 10),
            (D("2020-10-01"), 1, 100, 5),
            (D("2020-10-01"), 2, 100, 7),
            (D("2021-09-01"), 1, 100, 3),  # FY2022
        ],
        fact_gross_price=[(100, 2021, P20), (100, 2022, dec("30.0000"))],
        fact_pre_invoice_deductions=[(1, 2021, dec("0.1000")), (2, 2021, dec("0.2000")), (1, 2022, dec("0"))],
        fact_post_invoice_deductions=[
            (D("2020-09-01"), 1, 100, dec("0.0500"), dec("0.0500")),
            (D("2020-10-01"), 1, 100, dec("0.0000"), dec("0.1000")),
            (D("2020-10-01"), 2, 100, dec("0.1000"), dec("0.0000")),
            (D("2021-09-01"), 1, 100, dec("0"), dec("0")),
        ],
        dim_customer=[(1, "Acme", "India", "APAC"), (2, "Globex", "USA", "NA")],
        dim_product=[(100, "Mouse", "P & A")],
    )
    t.update(over)
    return make_tables(**t)


def test_net_sales_lines(make_tables):
    t = _base(make_tables)
    got = rows(op.net_sales_lines(t, 2021), "customer_code", "date", "total_net_sales")
    # c1 Sep: 200 -> 180 -> 162; c1 Oct: 100 -> 90 -> 81; c2 Oct: 140 -> 112 -> 100.8
    assert [(c, d, float(v)) for c, d, v in got] == [
        (1, D("2020-09-01"), 162.0), (1, D("2020-10-01"), 81.0), (2, D("2020-10-01"), 100.8)]


def test_missing_rates_drop_the_sale(make_tables):
    # Every rate lookup is an inner join
    t = _base(make_tables, fact_pre_invoice_deductions=[(1, 2021, dec("0.1000"))],
              fact_post_invoice_deductions=[(D("2020-09-01"), 1, 100, dec("0.0500"), dec("0.0500"))])
    got = rows(op.net_sales_lines(t, 2021), "customer_code", "date")
    assert got == [(1, D("2020-09-01"))]


def test_net_sales_by_customer_code_ignores_dimension(make_tables):
    # O-04 does not join dim_customer -> customer 2 counts without a dimension row
    t = _base(make_tables, dim_customer=[(1, "Acme", "India", "APAC")])
    got = rows(op.net_sales_by_customer_code(t, 2021, 5))
    assert got == [(1, dec("243.00")), (2, dec("100.80"))]
    # ...while the market report needs the dimension
    assert rows(op.top_markets_by_net_sales(t, 2021, 5)) == [("India", 0.0)]


def test_top_n_order_and_ties(make_tables):
    # Ties on the rounded value are broken by name
    t = _base(make_tables)
    out = op.top_n(op.net_sales_lines(t, 2021, with_market=True), "market", 1).collect()
    assert [(r.market, r.net_sales_mln) for r in out] == [("India", 0.0)]  # India 0.000243 = USA 0.0001008 -> 0.00


def test_top_customers_market_case_insensitive(make_tables):
    # S17: 'india' matches 'India'
    t = _base(make_tables)
    assert rows(op.top_customers_by_net_sales(t, "india", 2021, 3)) == [("Acme", 0.0)]


def test_gross_sales_routes(make_tables):
    t = _base(make_tables)
    # O-01: customer 1 by code, FY from the function on the date
    assert rows(op.gross_sales_one_customer(t, 1)) == [
        (D("2020-09-01"), 200.0), (D("2020-10-01"), 100.0), (D("2021-09-01"), 90.0)]
    # O-02: by name and market through the semi join
    assert rows(op.gross_sales_named_customer(t, "Acme", "India")) == rows(op.gross_sales_one_customer(t, 1))
    assert rows(op.gross_sales_named_customer(t, "ACME", "india")) == rows(op.gross_sales_one_customer(t, 1))
    # O-03 with one code equals O-01 (before rounding)
    assert rows(op.gross_sales_monthly(t, "1")) == rows(op.gross_sales_one_customer(t, 1))
    assert rows(op.gross_sales_monthly(t, "1,2")) == [
        (D("2020-09-01"), 200.0), (D("2020-10-01"), 240.0), (D("2021-09-01"), 90.0)]


def test_function_route_keeps_dates_missing_from_dim_date(make_tables):
    # The fiscal-year function needs no dim_date row; the dim_date join does
    t = _base(make_tables, dim_date=[(D("2020-10-01"), 2021)])
    assert len(rows(op.gross_sales_one_customer(t, 1))) == 3
    assert rows(op.net_sales_lines(t, 2021), "date") == [(D("2020-10-01"),), (D("2020-10-01"),)]


def test_code_list_semantics():
    # FIND_IN_SET - exact elements, no trimming, empty matches nothing
    assert parse_code_list("8,9") == [8, 9]
    assert parse_code_list("8, 9") == [8]
    assert parse_code_list("") == []
    assert parse_code_list(",8,,") == [8]
    assert parse_code_list("08") == []
    assert parse_code_list(None) is None
    assert parse_code_list([3, 4]) == [3, 4]


def test_code_list_none_and_empty_give_no_rows(make_tables):
    t = _base(make_tables)
    assert op.gross_sales_monthly(t, "").count() == 0
    assert op.gross_sales_monthly(t, None).count() == 0


def test_empty_sales(make_tables):
    t = _base(make_tables, fact_sales_monthly=[])
    assert op.top_markets_by_net_sales(t, 2021, 5).count() == 0
    assert op.net_sales_by_customer_code(t, 2021, 5).count() == 0


def test_code_and_market_pipelines_agree_on_sf001(spark):
    # the exploration query (per code, no dimension) and the procedure (per
    # market) sum the same net sales when every customer is in dim_customer
    from pyspark.sql import functions as F

    from conftest import SF01
    from salescope.sources.tables import load_tables
    t = load_tables(spark, SF01)
    by_code = op.net_sales_lines(t, 1998).agg(F.sum("total_net_sales")).first()[0]
    by_market = op.net_sales_lines(t, 1998, with_market=True).agg(F.sum("total_net_sales")).first()[0]
    assert by_code == by_market and by_code > 0


def test_grouping_by_name_merges_codes(make_tables):
    # Two codes share the name "Acme" -> one row in the customer report
    t = _base(make_tables, dim_customer=[(1, "Acme", "India", "APAC"), (2, "Acme", "India", "APAC")])
    assert rows(op.top_customers_by_net_sales(t, "India", 2021, 5)) == [("Acme", 0.0)]
    lines = op.net_sales_lines(t, 2021, market="India", with_customer=True)
    assert rows(op.top_n(lines, "customer", 5, out="x")) == [("Acme", 0.0)]


def test_procedure_with_fixed_five_equals_top_n(make_tables):
    # The fiscal-year procedure is the top-markets procedure with n = 5
    t = _base(make_tables)
    assert rows(op.net_sales_by_fiscal_year(t, 2021)) == rows(op.top_markets_by_net_sales(t, 2021, 5))


def test_round_half_away_from_zero(spark):
    # Decimal ROUND is half away from zero, never banker's rounding
    from salescope.functions.money import to_money
    df = spark.createDataFrame([(dec("0.125"),), (dec("-0.125"),), (dec("2.345"),), (dec("0.135"),)], "x decimal(10,3)")
    assert [r.m for r in df.select(to_money("x").alias("m")).collect()] == [dec("0.13"), dec("-0.13"), dec("2.35"), dec("0.14")]


def test_layers_equal_the_sums_on_sf001(spark):
    # B-1 to B-3 line by line against the aggregate-first form of the reports
    t = load_tables(spark, SF001)
    for keys in (["customer_code"], ["product_code"], ["customer_code", "product_code"]):
        lines = op.net_sales_lines(t, 1998).groupBy(*keys).agg(F.sum("total_net_sales").alias("total_net_sales"))
        sums = net_sales_by_keys(t, 1998, keys)
        assert lines.count() > 0 and rows(lines, *keys, "total_net_sales") == rows(sums, *keys, "total_net_sales")
    some = t.dim_customer.where("customer_code % 7 = 2").select("customer_code")
    assert rows(net_sales_by_keys(t, 1998, ["customer_code"], some)) == rows(net_sales_by_keys(t, 1998, ["customer_code"]).join(some, "customer_code"))


def test_code_filter_keeps_every_code_and_few_others(spark):
    codes = spark.range(-500, 100_000, 7).select(F.col("id").alias("code")).union(spark.sql("SELECT CAST(NULL AS LONG)"))
    kept = spark.range(-1000, 100_000).select(F.col("id").alias("code")).where(code_filter(codes, "code"))
    own = codes.where("code IS NOT NULL")
    assert kept.join(own, "code").count() == own.count() and kept.count() < 1.3 * own.count()
    assert spark.range(10).select(F.col("id").alias("code")).where(code_filter(codes.where("false"), "code")).count() == 0
