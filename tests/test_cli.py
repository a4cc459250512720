from conftest import SF001
from salescope.__main__ import main


def test_cli_writes_report(spark, tmp_path):
    out = str(tmp_path / "top")
    main(["top_markets_by_net_sales", "--source", SF001, "--fiscal-year", "1998", "--n", "3", "--output", out])
    got = spark.read.parquet(out).orderBy("net_sales_mln", ascending=False).collect()
    assert [r.market for r in got] == ["NATION_11", "NATION_19", "NATION_13"]


def test_cli_requires_parameters(capsys):
    import pytest
    with pytest.raises(SystemExit):
        main(["top_markets_by_net_sales", "--source", SF001])
    assert "--fiscal-year" in capsys.readouterr().err


def test_procedure_names_and_positional_arguments(spark, tmp_path):
    from conftest import rows
    from salescope import operators as op
    from salescope.procedures import PROCEDURES, call
    from salescope.sources.tables import load_tables
    t = load_tables(spark, SF001)
    assert rows(call(t, "get_top_n_markets_by_net_sales", 1998, 3)) == rows(op.top_markets_by_net_sales(t, 1998, 3))
    assert rows(call(t, "get_market_badge", "", "1998")) == rows(op.market_badge(t, "india", 1998))
    assert rows(call(t, "get_monthly_gross_sales_for_customer", "8,9")) == rows(op.gross_sales_monthly(t, [8, 9]))
    assert len(PROCEDURES) == 11
    out = str(tmp_path / "lag")
    main(["call", "forecast_accuracy_between_years_LAG", "1998", "1999", "--source", SF001, "--output", out])
    assert spark.read.parquet(out).count() == op.forecast_decline_lag(t, 1998, 1999).count()


def test_procedure_argument_count_is_checked(spark):
    import pytest
    from salescope.procedures import call
    from salescope.sources.tables import load_tables
    with pytest.raises(TypeError):
        call(load_tables(spark, SF001), "get_top_n_markets_by_net_sales", 1998)


def test_cli_explain(capsys):
    main(["top_markets_by_net_sales", "--source", SF001, "--fiscal-year", "1998", "--n", "3", "--explain"])
    out = capsys.readouterr().out
    assert "TakeOrderedAndProject" in out and "== Physical Plan ==" in out


def test_cli_rank_report(spark, tmp_path):
    out = str(tmp_path / "ranks")
    main(["rank_products", "--source", SF001, "--fiscal-year", "1998", "--output", out])
    assert spark.read.parquet(out).count() > 0
