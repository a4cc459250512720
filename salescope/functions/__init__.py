"""Column-level building blocks: fiscal calendar and money arithmetic."""

from salescope.functions.fiscal import (
    FISCAL_YEAR_START_MONTH,
    fiscal_quarter,
    fiscal_year,
    fiscal_year_bounds,
    in_fiscal_year,
    register_sql_functions,
    with_fiscal_quarter,
    with_fiscal_year,
)
from salescope.functions.money import (
    accuracy_pct,
    gross_amount,
    net_amount,
    net_invoice_amount,
    to_money,
    to_millions,
)

__all__ = [
    "FISCAL_YEAR_START_MONTH",
    "fiscal_year",
    "fiscal_quarter",
    "fiscal_year_bounds",
    "in_fiscal_year",
    "with_fiscal_year",
    "with_fiscal_quarter",
    "register_sql_functions",
    "gross_amount",
    "net_invoice_amount",
    "net_amount",
    "to_money",
    "to_millions",
    "accuracy_pct",
]
