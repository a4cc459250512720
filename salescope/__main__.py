"""Run one report from the command line.

    python -m salescope top_markets_by_net_sales --source catalog:sales --fiscal-year 2021 --n 5
    python -m salescope gross_sales_monthly --source /data/sales --customer-codes 90002002,90002003 \\
        --output /data/reports/gross
    python -m salescope call get_top_n_markets_by_net_sales 2021 5 --source catalog:sales

``--source`` is anything ``load_tables`` accepts.  The result is written as
Parquet to ``--output`` (a distributed write, nothing passes through the
driver) or, without it, its first ``--show`` rows are printed.
"""

from __future__ import annotations

import argparse
import inspect

from salescope import operators as op
from salescope.session import get_session
from salescope.sources.tables import load_tables

REPORTS = {
    name: getattr(op, name)
    for name in [
        "gross_sales_one_customer", "gross_sales_named_customer", "gross_sales_monthly",
        "net_sales_by_customer_code", "net_sales_by_fiscal_year", "top_customers_by_net_sales",
        "top_markets_by_net_sales", "top_products_by_net_sales", "top_products_per_division",
        "forecast_accuracy_base", "forecast_accuracy_by_customer", "forecast_accuracy_by_market",
        "forecast_decline_lag", "forecast_decline_pivot", "market_badge", "market_badges",
        "division_total_alongside_rows", "rank_products", "dense_rank_products", "row_number_products",
        "rank_comparison", "gross_sales_prev_year", "gross_sales_next_year",
    ]
}


TEXT_PARAMS = ("market", "customer", "customer_codes")
SKIPPED_PARAMS = ("ordered",)


def _params(fn):
    """Parameters after the tables argument."""
    return list(inspect.signature(fn).parameters.values())[1:]


def _outputs(ap: argparse.ArgumentParser) -> None:
    ap.add_argument("--source", required=True, help="folder of tables or catalog:<database>")
    ap.add_argument("--output", help="write the result as Parquet here")
    ap.add_argument("--show", type=int, default=20, help="rows to print when --output is not given")
    ap.add_argument("--explain", action="store_true", help="print the formatted physical plan instead of running")


def _emit(df, args) -> None:
    if args.explain:
        df.explain(mode="formatted")
    elif args.output:
        df.write.mode("overwrite").parquet(args.output)  # distributed write
    else:
        df.show(args.show, truncate=False)


def _call(argv: list[str]) -> None:
    from salescope.procedures import PROCEDURES, call

    ap = argparse.ArgumentParser(prog="python -m salescope call")
    ap.add_argument("procedure", choices=sorted(PROCEDURES))
    ap.add_argument("args", nargs="*", help="the procedure's arguments, in order")
    _outputs(ap)
    a = ap.parse_args(argv)
    spark = get_session(app=f"salescope-{a.procedure}")
    try:
        df = call(load_tables(spark, a.source), a.procedure, *a.args)
    except (TypeError, ValueError) as e:
        ap.error(str(e))
    _emit(df, a)


def main(argv: list[str] | None = None) -> None:
    import sys

    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0] == "call":
        return _call(argv[1:])
    ap = argparse.ArgumentParser(prog="python -m salescope", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("report", choices=sorted(REPORTS))
    _outputs(ap)
    seen = set(SKIPPED_PARAMS)
    for fn in REPORTS.values():
        for p in _params(fn):
            if p.name not in seen:
                seen.add(p.name)
                kind = str if p.name in TEXT_PARAMS else int
                ap.add_argument("--" + p.name.replace("_", "-"), type=kind, default=None)
    args = ap.parse_args(argv)

    fn = REPORTS[args.report]
    kwargs = {}
    for p in _params(fn):
        v = getattr(args, p.name, None)
        if v is None:
            if p.default is inspect.Parameter.empty:
                ap.error(f"{args.report} needs --{p.name.replace('_', '-')}")
            continue
        kwargs[p.name] = v
    spark = get_session(app=f"salescope-{args.report}")
    _emit(fn(load_tables(spark, args.source), **kwargs), args)


if __name__ == "__main__":
    main()
