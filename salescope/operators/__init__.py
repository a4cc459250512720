"""User-level operators (one function per report of the reference)."""

from salescope.operators.badge import market_badge, market_badges
from salescope.operators.forecast import (
    accuracy_metrics,
    forecast_accuracy_base,
    forecast_accuracy_by_customer,
    forecast_accuracy_by_market,
    forecast_decline_lag,
    forecast_decline_pivot,
)
from salescope.operators.rank import rank_within
from salescope.operators.ranking import (
    dense_rank_products,
    division_total_alongside_rows,
    gross_sales_next_year,
    gross_sales_prev_year,
    market_year_gross,
    net_sales_by_fiscal_year,
    product_qty,
    rank_comparison,
    rank_products,
    row_number_products,
    top_customers_by_net_sales,
    top_markets_by_net_sales,
    top_n,
    top_products_by_net_sales,
    top_products_per_division,
)
from salescope.operators.revenue import (
    gross_lines,
    gross_sales_monthly,
    gross_sales_named_customer,
    gross_sales_one_customer,
    net_invoice_lines,
    net_sales_by_customer_code,
    net_sales_lines,
)

__all__ = [n for n in dir() if not n.startswith("_")]
