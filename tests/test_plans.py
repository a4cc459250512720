"""t3: plan assertions (pushdown, join strategy, no cartesian, no Python)."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from salescope import operators as op
from salescope.operators.forecast import last_sale_date
from salescope.plans.inspect import final_plan, forbidden_operators, physical_plan, pushed_filters, scans
from salescope.sources.parquet import save_tables
from salescope.sources.tpch import derive_tables

QUERIES = E.queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_no_python(spark, name):
    assert forbidden_operators(QUERIES[name](spark, SF001)) == []


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    loc = str(tmp_path_factory.mktemp("tables"))
    return save_tables(derive_tables(spark, SF001), "plan_checks", loc)


def test_fiscal_year_reaches_rate_scans(saved):
    df = op.top_markets_by_net_sales(saved, 1998, 5)
    assert any("EqualTo(fiscal_year,1998)" in f for f in pushed_filters(df, "fact_gross_price"))
    assert any("EqualTo(fiscal_year,1998)" in f for f in pushed_filters(df, "fact_pre_invoice_deductions"))


def test_fact_scans_are_pruned_by_date(saved):
    # date-partitioned facts: the fiscal-year bounds become partition filters
    df = op.top_markets_by_net_sales(saved, 1998, 5)
    for table in ("fact_sales_monthly", "fact_post_invoice_deductions"):
        lines = [ln for ln in scans(df) if table in ln]
        assert lines and all("PartitionFilters: [isnotnull(date" in ln and "Subquery" in ln for ln in lines)


def test_dim_date_is_broadcast_and_topn_is_take_ordered(saved):
    plan = physical_plan(op.top_markets_by_net_sales(saved, 1998, 5))
    assert "TakeOrderedAndProject(limit=5" in plan
    assert "BroadcastHashJoin [date" in plan


def test_code_list_is_pushed_as_in(saved):
    df = op.gross_sales_monthly(saved, "8,9")
    assert any("In(customer_code, [8,9])" in f for f in pushed_filters(df, "fact_sales_monthly"))


def test_badge_year_is_pushed_as_date_range(saved):
    plan = physical_plan(op.market_badge(saved, "NATION_19", 1998))
    assert "PartitionFilters: [isnotnull(date" in plan and "1997-09-01" in plan and "1998-09-01" in plan


def test_top_dense_rank_uses_window_group_limit(saved):
    plan = physical_plan(op.top_products_per_division(saved, 1998, 3))
    assert "WindowGroupLimit" in plan


def test_full_rank_has_no_window_over_division(saved):
    # a window is never partitioned by the (possibly hot) group alone
    plan = physical_plan(op.rank_comparison(saved, 1998))
    windows = re.findall(r"windowspecdefinition\(([^)]*?) (?:ASC|DESC)", plan)
    assert windows and all("_range#" in w for w in windows)


def test_full_rank_shuffles_its_rows_once(saved):
    from salescope.plans.inspect import final_plan, plan_summary

    for report in (op.rank_products, op.row_number_products, op.rank_comparison):
        s = plan_summary(final_plan(report(saved, 1998)))
        assert s["hash_exchanges"] <= 4 and s["sort_merge_joins"] == 0


def test_market_filter_stands_on_the_fact_scans(no_broadcast):
    # whatever the broadcast threshold: below the fact-fact join, on both sides, and without an exchange
    for report in (op.top_customers_by_net_sales(no_broadcast, "NATION_19", 1998, 5), op.top_products_by_net_sales(no_broadcast, "NATION_19", 1998, 5)):
        plan = physical_plan(report).splitlines()
        join = next(i for i, x in enumerate(plan) if "SortMergeJoin [customer_code" in x and "date" in x)
        for table in ("fact_sales_monthly", "fact_post_invoice_deductions"):
            scan = next(i for i, x in enumerate(plan) if "FileScan" in x and table in x and i > join)
            assert any("Filter" in x and "xxhash64(customer_code" in x for x in plan[join:scan])
            join = scan


def test_forecast_scalar_subquery_not_cross_join(saved):
    plan = physical_plan(op.forecast_accuracy_by_market(saved, 1998))
    assert "Subquery" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _join_inputs_shuffled(plan: str, marker: str) -> bool:
    """True when an Exchange sits directly under the join line containing ``marker``."""
    lines = plan.splitlines()
    for i, ln in enumerate(lines):
        if "SortMergeJoin" in ln and marker in ln:
            indent = len(ln) - len(ln.lstrip(" :+-"))
            for sub in lines[i + 1:]:
                d = len(sub) - len(sub.lstrip(" :+-"))
                if d <= indent:
                    break
                if "Exchange hashpartitioning" in sub and "customer_code" in sub and "product_code" in sub:
                    return True
            return False
    raise AssertionError("join not found")


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    return save_tables(derive_tables(spark, SF001), "plan_checks_b", str(tmp_path_factory.mktemp("bucketed")), buckets=4)


@pytest.fixture
def no_broadcast(spark, bucketed):
    # every table beyond the broadcast thresholds (only the calendar is broadcast by its hint)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in zip(keys, ("-1", "-1", "false"), strict=True):
        spark.conf.set(k, v)
    yield bucketed
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bucketed_fact_joins_need_no_shuffle(no_broadcast):
    t = no_broadcast
    for report in (op.net_sales_by_customer_code(t, 1998, 5), op.top_markets_by_net_sales(t, 1998, 5),
                   op.top_customers_by_net_sales(t, "NATION_19", 1998, 5), op.top_products_by_net_sales(t, "NATION_19", 1998, 5)):
        plan = physical_plan(report)
        assert "Bucketed: true" in plan and not _join_inputs_shuffled(plan, "date")
    base = physical_plan(op.forecast_accuracy_base(t))
    assert "Bucketed: true" in base and not _join_inputs_shuffled(base, "LeftOuter")


def test_facts_are_summed_before_rates_and_dimensions(no_broadcast):
    # no exchange carries fact rows: each shuffle that is not below a partial sum is of a rate or a dimension
    t = no_broadcast
    for report in (op.gross_sales_monthly(t, "8,9"), op.gross_sales_prev_year(t), op.forecast_accuracy_by_customer(t, 1998), op.forecast_decline_pivot(t, 1998, 1999)):
        plan = physical_plan(report).splitlines()
        for i, line in enumerate(plan):
            if "Exchange hashpartitioning" in line:
                below = next((x for x in plan[i + 1 :] if re.search("HashAggregate|FileScan|SortMergeJoin", x)), "")
                assert "partial" in below or "fact_sales" not in below and "fact_forecast" not in below, below


def test_prices_of_all_years_are_not_broadcast(spark, saved):
    # products x years: an estimate below the threshold must not bring them to the driver
    for t in (saved, derive_tables(spark, SF001)):
        for report in (op.gross_sales_one_customer(t, 8), op.gross_sales_named_customer(t, "FURNITURE-6", "NATION_19"), op.gross_sales_monthly(t, "8,9"), op.gross_sales_prev_year(t), op.gross_sales_next_year(t)):
            for plan in (physical_plan(report), final_plan(report).toString()):
                assert "SortMergeJoin [product_code" in plan and "BroadcastHashJoin [product_code" not in plan


def test_plan_summary_counts_final_plan(saved):
    from salescope.plans.inspect import final_plan, plan_summary
    s = plan_summary(final_plan(op.top_markets_by_net_sales(saved, 1998, 5)))
    assert s["take_ordered"] == 1 and s["hash_exchanges"] >= 1
    assert s["partition_filters_with_subquery"] >= 1 and s["single_partition_exchanges"] >= 1
    assert s["cartesian_or_nested_loop"] == 0 and s["python_udf"] == 0


@pytest.mark.parametrize("name", ["with_fiscal_year", "with_fiscal_quarter"])
def test_calendar_enrichment_is_map_only(spark, name):
    from salescope.plans.inspect import final_plan, plan_summary
    s = plan_summary(final_plan(QUERIES[name](spark, SF001)))
    assert s["hash_exchanges"] == s["range_exchanges"] == s["single_partition_exchanges"] == 0
    assert s["python_udf"] == 0


def _files_read(plan) -> list[int]:
    """Files read by each scan of a plan that has run, subqueries included."""
    cls = plan.getClass().getSimpleName()
    if cls == "AdaptiveSparkPlanExec":
        return _files_read(plan.executedPlan())
    if cls.endswith("QueryStageExec"):
        return _files_read(plan.plan())
    own = [plan.metrics().apply("numFiles").value()] if cls == "FileSourceScanExec" else []
    below = [*(plan.children().apply(i) for i in range(plan.children().size())), *(plan.subqueries().apply(i) for i in range(plan.subqueries().size()))]
    return own + [n for x in below for n in _files_read(x)]


def test_last_sale_date_reads_the_newest_folder(spark, saved):
    df = spark.range(1).select(last_sale_date(saved).alias("last"))
    assert df.first().last == saved.sales.agg({"date": "max"}).first()[0] == saved.newest_sales_date
    newest = [f for f in saved.sales.inputFiles() if f"date={saved.newest_sales_date}" in f]
    assert sorted(_files_read(final_plan(df))) == [0, len(newest)]
