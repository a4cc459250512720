"""Every table-based report on skewed business tables vs its SQL (DuckDB)."""

import duckdb
import pytest

from oracle_compare import compare
from salescope.plans.catalog import QUERIES
from salescope.plans.oracle import REPORT_SQL
from salescope.sources.tables import TABLE_NAMES, load_tables
from skewed_fixture import build


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    for name, df in build(spark).items():
        df.write.mode("overwrite").parquet(str(root / name))
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}/*.parquet')")
    return str(root), con


def test_fixture_is_skewed(skewed):
    _, con = skewed
    total, hot = con.sql("SELECT COUNT(*), COUNT(*) FILTER (WHERE customer_code = 8) FROM fact_sales_monthly").fetchall()[0]
    assert hot * 3 > total * 0.9
    share = con.sql("SELECT AVG(CASE WHEN division = 'HOT' THEN 1 ELSE 0 END) FROM dim_product").fetchall()[0][0]
    assert share >= 0.9


@pytest.mark.slow
@pytest.mark.parametrize("name", sorted(REPORT_SQL))
def test_report_on_skewed_tables(spark, skewed, name):
    root, con = skewed
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")  # many partitions per hot group
    try:
        ok, msg = compare(QUERIES[name](spark, root), con, REPORT_SQL[name])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert ok, msg


def test_loaded_from_business_folder(spark, skewed):
    root, _ = skewed
    t = load_tables(spark, root)
    assert t.sales.count() > 10000
