"""Sources: derived tables, Parquet round trip, catalog layout, keys."""

import datetime as dt
from dataclasses import replace

import pytest

from conftest import SF001, rows
from salescope import operators as op
from salescope.operators.forecast import last_sale_date
from salescope.schema import SCHEMAS
from salescope.sources.parquet import newest_date, save_tables, write_tables
from salescope.sources.tables import TABLE_NAMES, load_tables
from salescope.sources.tpch import derive_tables


@pytest.fixture(scope="module")
def derived(spark):
    return derive_tables(spark, SF001)


def test_derived_schemas(derived):
    for name, df in derived.as_dict().items():
        got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        want = [(f.name, f.dataType.simpleString()) for f in SCHEMAS[name].fields]
        assert got == want, name


def test_keys_are_unique(derived):
    # the joins assume these keys; a duplicate rate row would inflate sums
    assert [(r.table, r.n_dup_keys) for r in derived.duplicate_keys().collect()] == [(n, 0) for n in TABLE_NAMES]


def test_duplicate_keys_are_reported(make_tables):
    from decimal import Decimal
    t = make_tables(fact_gross_price=[(1, 2021, Decimal("1")), (1, 2021, Decimal("2")), (2, 2021, Decimal("1"))])
    got = {r.table: r.n_dup_keys for r in t.duplicate_keys().collect()}
    assert got["fact_gross_price"] == 1 and got["fact_sales_monthly"] == 0


def _reports(t):
    return [
        rows(op.top_markets_by_net_sales(t, 1998, 5)),
        rows(op.forecast_accuracy_by_market(t, 1998)),
        rows(op.rank_comparison(t, 1998)),
        rows(op.gross_sales_monthly(t, "8,9")),
        rows(op.market_badges(t, 1998, 10_000)),
    ]


def test_parquet_round_trip(spark, derived, tmp_path):
    written = write_tables(derived, str(tmp_path / "tables"))
    again = load_tables(spark, str(tmp_path / "tables"))
    assert _reports(written) == _reports(derived) == _reports(again)


def test_catalog_layout_bucketed(spark, derived, tmp_path):
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    saved = save_tables(derived, "src_checks", str(tmp_path / "db"), buckets=3)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    assert _reports(saved) == _reports(derived)
    assert _reports(load_tables(spark, "catalog:src_checks")) == _reports(derived)


def test_sql_users_get_the_same_answers(spark, derived):
    derived.register_views()
    dearest = spark.sql("""
        WITH priced AS (SELECT get_fiscal_year(date) AS fiscal_year, product_code, date, sold_quantity
                        FROM fact_sales_monthly WHERE customer_code = 8)
        SELECT date, ROUND(SUM(sold_quantity * gross_price), 2) AS amount
        FROM priced NATURAL JOIN fact_gross_price GROUP BY date""")
    assert rows(dearest) == rows(op.gross_sales_one_customer(derived, 8))
    quarters = spark.sql("SELECT DISTINCT get_fiscal_quarter(calendar_date) AS q FROM dim_date").collect()
    assert sorted(r.q for r in quarters) == ["Q1", "Q2", "Q3", "Q4"]
    base = spark.sql("SELECT market, SUM(abs_error) AS e FROM forecast_accuracy_base WHERE fiscal_year = 1998 GROUP BY market")
    want = {r.market: r.total_abs_error for r in op.forecast_accuracy_by_market(derived, 1998).collect()}
    assert {r.market: r.e for r in base.collect()} == want


def test_catalog_without_unused_columns(spark, derived, tmp_path):
    save_tables(derived, "lean_checks", str(tmp_path / "lean"))
    lean = spark.table("lean_checks.dim_customer").drop("region")
    lean.write.parquet(str(tmp_path / "dim_customer"))
    spark.sql("DROP TABLE lean_checks.dim_customer")
    spark.sql(f"CREATE TABLE lean_checks.dim_customer USING parquet LOCATION '{tmp_path / 'dim_customer'}'")
    t = load_tables(spark, "catalog:lean_checks")
    assert rows(op.top_markets_by_net_sales(t, 1998, 5)) == rows(op.top_markets_by_net_sales(derived, 1998, 5))


def test_newest_folder_without_rows(spark, derived, tmp_path):
    t = save_tables(derived, "empty_newest", str(tmp_path / "w"))
    want, last = _reports(t), t.newest_sales_date
    spark.sql("ALTER TABLE empty_newest.fact_sales_monthly ADD PARTITION (date = DATE'2090-01-01')")
    spark.sql("ALTER TABLE empty_newest.fact_sales_monthly ADD PARTITION (date = DATE'2090-02-01')")
    again = load_tables(spark, "catalog:empty_newest")
    assert again.newest_sales_date.year == 2090 > last.year
    assert spark.range(1).select(last_sale_date(again)).first()[0] == last
    assert _reports(again) == want
    # a folder newer than the listing is read as well; a table without the listing gives the same
    assert spark.range(1).select(last_sale_date(replace(again, newest_sales_date=dt.date(1999, 1, 1)))).first()[0] == last
    assert spark.range(1).select(last_sale_date(replace(again, newest_sales_date=None))).first()[0] == last


def test_tables_without_date_folders_have_no_newest(spark, derived, tmp_path):
    assert derived.newest_sales_date is None and write_tables(derived, str(tmp_path)).newest_sales_date is None
    derived.dim_date.limit(3).write.mode("overwrite").option("path", str(tmp_path / "plain")).saveAsTable("plain_dates")
    assert newest_date(spark, "plain_dates") is None
    spark.sql("DROP TABLE plain_dates")
