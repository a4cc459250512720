"""Call a report by the name and positional arguments of the reference's
stored procedures, so existing calls carry over unchanged:

    call(t, "get_top_n_markets_by_net_sales", 2021, 5)
    python -m salescope call get_top_n_markets_by_net_sales 2021 5 --source catalog:sales

The badge procedure's OUT parameter becomes a column of its one-row result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from salescope import operators as op
from salescope.sources.tables import SalesTables

# The reference's procedure names with their parameters in
# order (name, type), mapped to the operators implementing them.
PROCEDURES: dict[str, tuple[Callable[..., DataFrame], list[tuple[str, type]]]] = {
    "get_monthly_gross_sales_for_customer": (op.gross_sales_monthly, [("customer_codes", str)]),
    "get_net_sales_by_fiscal_year": (op.net_sales_by_fiscal_year, [("fiscal_year", int)]),
    "get_top_customers_by_net_sales": (
        op.top_customers_by_net_sales, [("market", str), ("fiscal_year", int), ("n", int)]),
    "get_top_n_markets_by_net_sales": (op.top_markets_by_net_sales, [("fiscal_year", int), ("n", int)]),
    "get_top_n_products_by_net_sales": (
        op.top_products_by_net_sales, [("market", str), ("fiscal_year", int), ("n", int)]),
    "get_top_n_products_per_division_by_qty_sold": (
        op.top_products_per_division, [("fiscal_year", int), ("n", int)]),
    "get_forecast_accuracy_by_customer": (op.forecast_accuracy_by_customer, [("fiscal_year", int)]),
    "get_forecast_accuracy_by_market": (op.forecast_accuracy_by_market, [("fiscal_year", int)]),
    "forecast_accuracy_between_years_LAG": (op.forecast_decline_lag, [("y1", int), ("y2", int)]),
    "forecast_accuracy_between_years_pivot": (op.forecast_decline_pivot, [("y1", int), ("y2", int)]),
    "get_market_badge": (op.market_badge, [("market", str), ("fiscal_year", int)]),
}


def call(t: SalesTables, procedure: str, *args) -> DataFrame:
    """Run ``procedure`` with the reference's positional arguments (strings
    are converted to the parameter types, so command-line values work)."""
    if procedure not in PROCEDURES:
        raise KeyError(f"unknown procedure {procedure!r}; known: {', '.join(sorted(PROCEDURES))}")
    fn, params = PROCEDURES[procedure]
    if len(args) != len(params):
        names = ", ".join(n for n, _ in params)
        raise TypeError(f"{procedure} takes {len(params)} argument(s) ({names}), got {len(args)}")
    kwargs = {name: (kind(a) if a is not None else None) for (name, kind), a in zip(params, args)}
    return fn(t, **kwargs)
