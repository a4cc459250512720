"""t1: the driver's smoke check."""

import __spark_entry__ as E


def test_entry_runs_on_sf0001(spark):
    df = E.entry(spark)
    assert df.columns == ["market", "net_sales_mln"]
    got = df.collect()
    assert 0 < len(got) <= 5
    vals = [r.net_sales_mln for r in got]
    assert vals == sorted(vals, reverse=True)
    # FIXTURES.md: top markets in FY1998 at sf0.001 are NATION_11 1.13, NATION_19 0.95, NATION_13 0.77
    assert [(r.market, r.net_sales_mln) for r in got[:3]] == [("NATION_11", 1.13), ("NATION_19", 0.95), ("NATION_13", 0.77)]
