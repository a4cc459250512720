import pytest

from conftest import SF01, D, dec, rows
from salescope import operators as op
from salescope.sources.tables import load_tables


def _t(make_tables, sales, forecast, customers=None):
    return make_tables(
        fact_sales_monthly=sales, fact_forecast_monthly=forecast,
        dim_customer=customers or [(1, "Acme", "India", "APAC"), (2, "Globex", "USA", "NA")])


def test_base_left_join_and_errors(make_tables):
    sales = [(D("2020-10-01"), 1, 10, 90), (D("2020-10-01"), 1, 11, 5)]   # (1,11) has no forecast
    fc = [(D("2020-10-01"), 1, 10, 100), (D("2020-10-01"), 1, 12, 50)]   # (1,12) has no sale
    base = op.forecast_accuracy_base(_t(make_tables, sales, fc))
    got = rows(base, "customer_code", "forecast_quantity", "sold_quantity", "net_error", "abs_error", "fiscal_year")
    # Forecast rows kept (sold NULL), the sale without forecast dropped; S12: signed error
    assert got == [(1, 50, None, 50, 50, 2021), (1, 100, 90, 10, 10, 2021)]
    acc = op.forecast_accuracy_by_customer(_t(make_tables, sales, fc), 2021).collect()
    assert [(r.total_sold_qty, r.total_forecast_qty, r.total_net_error, r.total_abs_error,
             r.forecast_accuracy_pct) for r in acc] == [(90, 150, 60, 60, 60.0)]


def test_future_forecasts_dropped(make_tables):
    # Only forecast dates up to MAX(date) of the whole sales table
    sales = [(D("2020-10-01"), 2, 10, 1)]
    fc = [(D("2020-10-01"), 1, 10, 5), (D("2020-11-01"), 1, 10, 5)]
    base = op.forecast_accuracy_base(_t(make_tables, sales, fc))
    assert rows(base, "date") == [(D("2020-10-01"),)]


def test_null_sold_sum_and_zero_forecast(make_tables):
    # A group without any sale -> total_sold_qty NULL; S9: zero forecast -> NULL pct
    sales = [(D("2020-10-01"), 2, 10, 4)]
    fc = [(D("2020-10-01"), 1, 10, 0), (D("2020-10-01"), 2, 10, 4)]
    got = {r.customer_code: r for r in op.forecast_accuracy_by_customer(_t(make_tables, sales, fc), 2021).collect()}
    assert got[1].total_sold_qty is None and got[1].forecast_accuracy_pct is None
    assert got[2].forecast_accuracy_pct == 100.0
    out = op.forecast_accuracy_by_customer(_t(make_tables, sales, fc), 2021)
    assert [r.customer_code for r in out.collect()] == [2, 1]  # NULL accuracy last


def test_guard_future_year(make_tables):
    # No report for a fiscal year after the year of the last sale
    sales = [(D("2020-10-01"), 1, 10, 4)]
    fc = [(D("2020-10-01"), 1, 10, 5)]
    t = _t(make_tables, sales, fc)
    assert op.forecast_accuracy_by_customer(t, 2021).count() == 1
    assert op.forecast_accuracy_by_customer(t, 2022).count() == 0
    assert op.forecast_accuracy_by_market(t, 2022).count() == 0


def test_market_report_counts_distinct_customers(make_tables):
    sales = [(D("2020-10-01"), 1, 10, 4), (D("2020-10-01"), 2, 10, 4)]
    fc = [(D("2020-10-01"), 1, 10, 5), (D("2020-10-01"), 1, 11, 5), (D("2020-10-01"), 2, 10, 4)]
    cust = [(1, "Acme", "India", "APAC"), (2, "Globex", "India", "APAC")]
    r = op.forecast_accuracy_by_market(_t(make_tables, sales, fc, cust), 2021).collect()
    assert [(r_.market, r_.customer_count, r_.total_forecast_qty, r_.total_abs_error, r_.forecast_accuracy_pct)
            for r_ in r] == [("India", 2, 14, 6, dec("57.14"))]


def _two_years(make_tables):
    sales = [(D("2020-10-01"), 1, 10, 90), (D("2021-10-01"), 1, 10, 50),
             (D("2020-10-01"), 2, 10, 50), (D("2021-10-01"), 2, 10, 100)]
    fc = [(D("2020-10-01"), 1, 10, 100), (D("2021-10-01"), 1, 10, 100),
          (D("2020-10-01"), 2, 10, 100), (D("2021-10-01"), 2, 10, 100),
          (D("2021-10-01"), 3, 10, 100)]
    cust = [(1, "A", "India", "r"), (2, "B", "India", "r"), (3, "C", "USA", "r")]
    return _t(make_tables, sales, fc, cust)


def test_decline_lag_and_pivot(make_tables):
    t = _two_years(make_tables)
    lag = op.forecast_decline_lag(t, 2021, 2022).collect()
    assert [(r.customer_code, r.fiscal_year, r.forecast_accuracy_pct, r.prev_year_accuracy) for r in lag] == [
        (1, 2022, 50.0, 90.0)]
    piv = op.forecast_decline_pivot(t, 2021, 2022).collect()
    assert [(r.customer_code, r.accuracy_y1, r.accuracy_y2, r.accuracy_change) for r in piv] == [(1, 90.0, 50.0, -40.0)]


def test_decline_degenerate_years(make_tables):
    # y1 > y2 -> LAG finds no predecessor for y2 (empty); pivot still compares.
    t = _two_years(make_tables)
    assert op.forecast_decline_lag(t, 2022, 2021).count() == 0
    assert rows(op.forecast_decline_pivot(t, 2022, 2021), "customer_code") == [(2,)]
    # y1 = y2 -> nothing declines
    assert op.forecast_decline_lag(t, 2021, 2021).count() == 0
    assert op.forecast_decline_pivot(t, 2021, 2021).count() == 0


@pytest.mark.slow
def test_lag_and_pivot_find_same_customers(spark):
    # the two productionized forms agree on the sf0.01 tables for y1 < y2
    t = load_tables(spark, SF01)
    a = rows(op.forecast_decline_lag(t, 1998, 1999), "customer_code")
    b = rows(op.forecast_decline_pivot(t, 1998, 1999), "customer_code")
    assert a == b and len(a) == 704


def test_market_report_counts_a_code_once(make_tables):
    # a code that dim_customer holds twice (and once more under another spelling of the market) is one customer
    day = D("2020-10-01")
    customers = [(1, "Acme", "India", "APAC"), (1, "Acme", "India", "APAC"), (1, "Acme", "INDIA", "APAC"), (2, "Globex", "india", "APAC"), (3, "Initech", "USA", "NA")]
    t = _t(make_tables, [(day, c, 10, 5) for c in (1, 2, 3)], [(day, c, 10, 10) for c in (1, 2, 3)], customers)
    got = {r.market: (r.customer_count, r.total_forecast_qty) for r in op.forecast_accuracy_by_market(t, 2021).collect()}
    assert got == {"INDIA": (2, 40), "USA": (1, 10)}
