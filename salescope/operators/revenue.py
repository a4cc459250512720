"""Gross sales and the three-layer net-sales pipeline.

Layer 1 (B-1) joins each monthly sale to its fiscal year, gross price and
pre-invoice rate; layer 2 (B-2) applies the pre-invoice discount; layer 3
(B-3) joins the post-invoice rates of the same (customer, date, product) and
applies them.  All rate lookups are inner joins: a sale without a price or a
rate drops out of net sales, as in the reference.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.fiscal import fiscal_year as fiscal_year_of
from salescope.functions.money import NET_INVOICE_TYPE, gross_amount, net_amount, net_invoice_amount, to_money
from salescope.operators.common import code_filter, date_bounds_filter, every_price, fiscal_dates, text_equals
from salescope.sources.tables import SalesTables

KEYS3 = ["customer_code", "date", "product_code"]


def gross_lines(
    t: SalesTables,
    fiscal_year: int,
    market: str | None = None,
    with_market: bool = False,
    with_customer: bool = False,
    with_product: bool = False,
) -> DataFrame:
    """B-1: sale line + gross_price_total + pre_invoice_discount_pct for one
    fiscal year (fiscal year from dim_date), optionally one market."""
    sales = t.sales.where(date_bounds_filter(t, F.col("date"), fiscal_year))
    lines = sales.join(fiscal_dates(t, fiscal_year), "date")
    if market is not None or with_market or with_customer:
        cust = t.dim_customer.select("customer_code", "customer", "market")
        if market is not None:
            cust = cust.where(text_equals("market", market))
        lines = lines.join(cust, "customer_code")
    if with_product:
        lines = lines.join(t.dim_product.select("product_code", "product"), "product_code")
    price = t.gross_price.where(F.col("fiscal_year") == fiscal_year)
    pre = t.pre_invoice.where(F.col("fiscal_year") == fiscal_year)
    lines = lines.join(price, ["product_code", "fiscal_year"]).join(pre, ["customer_code", "fiscal_year"])
    keep = KEYS3 + [c for c, on in (("market", market is not None or with_market or with_customer),
                                    ("customer", with_customer), ("product", with_product)) if on]
    return lines.select(
        *keep,
        gross_amount("sold_quantity", "gross_price").alias("gross_price_total"),
        "pre_invoice_discount_pct",
    )


def net_invoice_lines(t: SalesTables, fiscal_year: int, **kw) -> DataFrame:
    """B-2: gross minus the pre-invoice discount."""
    g = gross_lines(t, fiscal_year, **kw)
    dims = [c for c in g.columns if c not in ("gross_price_total", "pre_invoice_discount_pct")]
    return g.select(*dims, net_invoice_amount("gross_price_total", "pre_invoice_discount_pct").alias("net_invoice_sell"))


def net_sales_lines(t: SalesTables, fiscal_year: int, **kw) -> DataFrame:
    """B-3: net invoice sales minus the post-invoice deductions of the same
    (customer, date, product).  This is the one fact-fact join: both sides
    are hash-partitioned on the three keys (or co-bucketed, or one side
    broadcast when AQE measures it small)."""
    nis = net_invoice_lines(t, fiscal_year, **kw)
    post = t.post_invoice.where(date_bounds_filter(t, F.col("date"), fiscal_year))
    joined = nis.join(post, KEYS3)
    dims = [c for c in nis.columns if c != "net_invoice_sell"]
    return joined.select(
        *dims,
        net_amount("net_invoice_sell", "discounts_pct", "other_deductions_pct").alias("total_net_sales"),
    )


def net_sales_by_keys(t: SalesTables, fiscal_year: int, keys: list[str], customers: DataFrame | None = None) -> DataFrame:
    """Σ net sales of one fiscal year per ``keys`` (customer_code and / or
    product_code), optionally of some customer codes. -> (*keys, total_net_sales)

    The fact-fact join comes first, right above the scans (co-bucketed facts
    need no exchange for it).  Price and pre-invoice rate hold for a product
    and a customer in the year, so only the quantity kept after the
    post-invoice deductions is summed per (customer, product), and rates meet
    those sums: qty * (1 - post) * price * (1 - pre) is the same exact decimal
    as the layered chain of :func:`net_sales_lines`.

    The customers asked for reach both fact scans as a filter of fixed size, so
    the fact-fact join sees their rows and few others even where they are too
    many to broadcast; the exact semi-join is on the sums."""
    sales = t.sales.where(date_bounds_filter(t, F.col("date"), fiscal_year))
    post = t.post_invoice.where(date_bounds_filter(t, F.col("date"), fiscal_year))
    if customers is not None:
        sales, post = (x.where(code_filter(customers, "customer_code")) for x in (sales, post))
    left_over = F.lit(1).cast("decimal(1,0)") - (F.col("discounts_pct") + F.col("other_deductions_pct"))
    kept = (
        sales.join(post, KEYS3).join(fiscal_dates(t, fiscal_year), "date")
        .groupBy("customer_code", "product_code")
        .agg(F.sum(F.col("sold_quantity") * left_over).cast("decimal(21,4)").alias("qty"))
    )
    if customers is not None:
        kept = kept.join(customers.select("customer_code"), "customer_code", "left_semi")
    price = t.gross_price.where(F.col("fiscal_year") == fiscal_year).select("product_code", "gross_price")
    pre = t.pre_invoice.where(F.col("fiscal_year") == fiscal_year).select(
        "customer_code", (F.lit(1).cast("decimal(1,0)") - F.col("pre_invoice_discount_pct")).alias("after_pre"))
    amount = (F.col("qty") * F.col("gross_price")).cast(NET_INVOICE_TYPE)
    net = (amount * F.col("after_pre")).cast("decimal(38,12)")
    return (
        kept.join(price, "product_code").join(pre, "customer_code")
        .groupBy(*keys).agg(F.sum(net).alias("total_net_sales"))
    )


# ---------------------------------------------------------------- gross sales

def _monthly_gross(sales: DataFrame, t: SalesTables) -> DataFrame:
    """Σ gross sales per date -> (date, gross).  The fiscal year comes from the
    function on the sale date (no dim_date join); a date has one, so quantities
    are summed per (date, product) before the price is joined."""
    qty = (
        sales.groupBy("date", "product_code").agg(F.sum("sold_quantity").alias("qty"))
        .withColumn("fiscal_year", fiscal_year_of("date"))
    )
    return (
        qty.join(every_price(t), ["product_code", "fiscal_year"])
        .groupBy("date").agg(F.sum(gross_amount("qty", "gross_price")).alias("gross"))
    )


def gross_sales_one_customer(t: SalesTables, customer_code: int) -> DataFrame:
    """O-01: monthly gross sales of one customer code, rounded to 2 places.
    -> (date, gross_sales_amount)"""
    s = t.sales.where(F.col("customer_code") == F.lit(int(customer_code)))
    return _monthly_gross(s, t).select("date", to_money("gross").alias("gross_sales_amount"))


def gross_sales_named_customer(t: SalesTables, customer: str, market: str) -> DataFrame:
    """O-02: monthly gross sales of every customer code carrying ``customer``
    in ``market`` (a name may cover several codes; both match
    case-insensitively), rounded to 2 places.
    The name lookup is an IN-subquery, planned as a left-semi join.
    -> (date, total_gross_sales_amount)"""
    codes = t.dim_customer.where(
        text_equals("customer", customer) & text_equals("market", market)
    ).select("customer_code")
    s = t.sales.join(codes, "customer_code", "left_semi")
    return _monthly_gross(s, t).select("date", to_money("gross").alias("total_gross_sales_amount"))


def parse_code_list(codes: str | Iterable[object] | None) -> list[int] | None:
    """Customer codes from a list or a comma-separated string.

    Elements follow FIND_IN_SET: the exact text of an element, no trimming, so
    only the canonical text of an integer can match a code, and one beyond
    BIGINT matches none.  Elements of a list count by their text.  An empty
    string matches nothing; None means no rows.
    """
    if codes is None:
        return None
    texts = codes.split(",") if isinstance(codes, str) else [str(c) for c in codes]
    exact = [e for e in texts if CODE.fullmatch(e)]
    return [v for v in map(int, exact) if -(1 << 63) <= v < 1 << 63]


CODE = re.compile("0|-?[1-9][0-9]{0,18}")


def gross_sales_monthly(t: SalesTables, customer_codes: str | Iterable[object] | None) -> DataFrame:
    """O-03: monthly gross sales (unrounded) of a list of customer codes.
    -> (date, gross_price_total)

    The list becomes an ``IN`` predicate, which reaches the Parquet scan."""
    codes = parse_code_list(customer_codes)
    s = t.sales.where(F.col("customer_code").isin(codes) if codes is not None else F.lit(False))
    return _monthly_gross(s, t).select("date", F.col("gross").alias("gross_price_total"))


def net_sales_by_customer_code(t: SalesTables, fiscal_year: int, n: int = 5) -> DataFrame:
    """O-04: top ``n`` customer codes by net sales (rounded to 2 places, not
    scaled).  No dim_customer join: codes missing from the dimension count.
    -> (customer_code, net_sales)"""
    return (
        net_sales_by_keys(t, fiscal_year, ["customer_code"])
        .select("customer_code", to_money("total_net_sales").alias("net_sales"))
        .orderBy(F.col("net_sales").desc_nulls_last(), F.col("customer_code").asc())
        .limit(n)
    )
