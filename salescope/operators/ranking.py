"""Top-N reports and ranking / offset window reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.money import gross_amount, to_millions
from salescope.operators.common import date_bounds_filter, every_price, fiscal_dates, merge_names, same_text, text_equals
from salescope.operators.rank import rank_within, top_dense_rank
from salescope.operators.revenue import net_sales_by_keys
from salescope.sources.tables import SalesTables


def top_n(lines: DataFrame, entity: str, n: int, value: str = "total_net_sales", out: str = "net_sales_mln") -> DataFrame:
    """B-5: Σvalue per ``entity`` in millions (2 places, DECIMAL), the ``n`` largest.

    Names that differ only in case or accents are one entity.  Ordered by the
    *rounded* value like the reference, with the entity name as tie-breaker so
    equal rounded values come out deterministically.  ``orderBy().limit()``
    plans as TakeOrderedAndProject: every task keeps its own top ``n`` and only
    those rows reach the final merge.
    """
    sums = lines.groupBy(entity).agg(F.sum(value).alias("total"))
    return (
        merge_names(sums, [entity], total=F.sum("total"))
        .select(entity, to_millions("total").alias(out))
        .orderBy(F.col(out).desc_nulls_last(), F.col(entity).asc())
        .limit(n)
    )


def net_sales_by_fiscal_year(t: SalesTables, fiscal_year: int) -> DataFrame:
    """O-05: top 5 markets by net sales in millions. -> (market, net_sales_mln)"""
    return top_markets_by_net_sales(t, fiscal_year, 5)


def _customers(t: SalesTables, market: str | None = None) -> DataFrame:
    c = t.dim_customer if market is None else t.dim_customer.where(text_equals("market", market))
    return c.select("customer_code", "customer", "market")


def top_customers_by_net_sales(t: SalesTables, market: str, fiscal_year: int, n: int = 5) -> DataFrame:
    """O-06: top ``n`` customer names in one market. -> (customer, net_sales_mln)"""
    codes = _customers(t, market)
    return top_n(net_sales_by_keys(t, fiscal_year, ["customer_code"], codes).join(codes, "customer_code"), "customer", n)


def top_markets_by_net_sales(t: SalesTables, fiscal_year: int, n: int = 5) -> DataFrame:
    """O-07: top ``n`` markets. -> (market, net_sales_mln)"""
    return top_n(net_sales_by_keys(t, fiscal_year, ["customer_code"]).join(_customers(t), "customer_code"), "market", n)


def top_products_by_net_sales(t: SalesTables, market: str, fiscal_year: int, n: int = 5) -> DataFrame:
    """O-08: top ``n`` product names in one market. -> (product, net_sales_mln)"""
    sums = net_sales_by_keys(t, fiscal_year, ["product_code"], _customers(t, market))
    return top_n(sums.join(t.dim_product.select("product_code", "product"), "product_code"), "product", n)


# ------------------------------------------------------------ quantity ranks

def _product_sums(t: SalesTables, fiscal_year: int) -> DataFrame:
    """Σsold_quantity per product code in one fiscal year, with its names: the
    sales are summed before dim_product is joined. -> (product_code, product,
    division, total_qty)"""
    sales = t.sales.where(date_bounds_filter(t, F.col("date"), fiscal_year))
    sums = sales.join(fiscal_dates(t, fiscal_year), "date").groupBy("product_code").agg(F.sum("sold_quantity").cast("long").alias("total_qty"))
    return sums.join(t.dim_product.select("product_code", "product", "division"), "product_code")


def product_qty(t: SalesTables, fiscal_year: int) -> DataFrame:
    """B-6: Σsold_quantity per (division, product name) in one fiscal year;
    names that differ only in case or accents are one, under the smallest
    spelling. -> (division, product, total_qty)"""
    return merge_names(_product_sums(t, fiscal_year), ["division", "product"], total_qty=F.sum("total_qty"))


def top_products_per_division(t: SalesTables, fiscal_year: int, n: int = 3) -> DataFrame:
    """O-09: products whose DENSE_RANK of quantity within their division is
    at most ``n`` (ties can return more than ``n`` rows, as in the reference).
    -> (division, product, total_qty, drnk)

    Ranked on the distinct quantities with a partial WindowGroupLimit, so a
    hot division never reaches one task whole (see ``top_dense_rank``).
    """
    qty = product_qty(t, fiscal_year).withColumn("_division", same_text("division"))
    return top_dense_rank(qty, ["_division"], "total_qty", n).select("division", "product", "total_qty", "drnk")


def division_total_alongside_rows(t: SalesTables, fiscal_year: int, ordered: bool = True) -> DataFrame:
    """O-18: every sale row of the year with the total quantity of its
    division beside it (SUM OVER (PARTITION BY division) without collapsing).
    -> (division, product, total_qty_by_division)

    The window has no order and no frame, so it equals a per-division
    aggregate joined back.  Sales are summed per product, then per division
    (names under the collation), and the totals meet the sale rows with the
    other columns of their product, in one join by its code.  A window would
    instead send each division whole to one task.
    """
    totals = _product_sums(t, fiscal_year).groupBy(same_text("division").alias("_d")).agg(F.sum("total_qty").alias("total_qty_by_division"))
    products = t.dim_product.select("product_code", "product", "division")
    # null-safe: a NULL division is one window partition too
    products = products.join(totals, same_text("division").eqNullSafe(F.col("_d"))).drop("_d")
    sales = t.sales.where(date_bounds_filter(t, F.col("date"), fiscal_year)).join(fiscal_dates(t, fiscal_year), "date")
    out = sales.select("product_code", "customer_code", "date").join(products, "product_code")
    if ordered:
        # the sale key after (division, product) keeps the range-partitioned
        # sort splittable when one product holds many rows
        out = out.orderBy("division", "product", "customer_code", "date", "product_code")
    return out.select("division", "product", "total_qty_by_division")


def _ranked(t: SalesTables, fiscal_year: int, kinds: tuple[str, ...], ordered: bool) -> DataFrame:
    qty = product_qty(t, fiscal_year).withColumn("_division", same_text("division"))
    out = rank_within(qty, ["_division"], "total_qty", ["product"], kinds).drop("_division")
    return out.orderBy("division", kinds[0], "product") if ordered else out


def rank_products(t: SalesTables, fiscal_year: int, ordered: bool = True) -> DataFrame:
    """O-19: RANK (gaps after ties) of Σquantity per division.
    -> (division, product, total_qty, rnk)"""
    return _ranked(t, fiscal_year, ("rnk",), ordered)


def dense_rank_products(t: SalesTables, fiscal_year: int, ordered: bool = True) -> DataFrame:
    """O-20: DENSE_RANK (no gaps) of Σquantity per division.
    -> (division, product, total_qty, drnk)"""
    return _ranked(t, fiscal_year, ("drnk",), ordered)


def row_number_products(t: SalesTables, fiscal_year: int, ordered: bool = True) -> DataFrame:
    """O-21: ROW_NUMBER of Σquantity per division; equal quantities are
    numbered by product name. -> (division, product, total_qty, row_num)"""
    return _ranked(t, fiscal_year, ("row_num",), ordered)


def rank_comparison(t: SalesTables, fiscal_year: int, ordered: bool = True) -> DataFrame:
    """O-22: RANK, DENSE_RANK and ROW_NUMBER side by side.
    -> (division, product, total_qty, rnk, drnk, row_num)"""
    out = _ranked(t, fiscal_year, ("rnk", "drnk", "row_num"), False)
    return out.orderBy("division", "drnk", "product") if ordered else out


# ------------------------------------------------------------ offset windows

def market_year_gross(t: SalesTables) -> DataFrame:
    """B-7: gross sales in millions (2 places) per (market, fiscal year), all
    years. -> (market, fiscal_year, gross_sales_mln)

    A price holds for a product and year, so quantities are summed per
    (customer, product, year) before it is joined, and amounts per (customer,
    year) before the market is."""
    qty = (
        t.sales.join(fiscal_dates(t), "date")
        .groupBy("customer_code", "product_code", "fiscal_year").agg(F.sum("sold_quantity").alias("qty"))
    )
    gross = (
        qty.join(every_price(t), ["product_code", "fiscal_year"])
        .groupBy("customer_code", "fiscal_year").agg(F.sum(gross_amount("qty", "gross_price")).alias("gross"))
        .join(t.dim_customer.select("customer_code", "market"), "customer_code")
        .groupBy("market", "fiscal_year").agg(F.sum("gross").alias("gross"))
    )
    return merge_names(gross, ["market"], ["fiscal_year"], gross=F.sum("gross")).select(
        "market", "fiscal_year", to_millions("gross").alias("gross_sales_mln"))


def gross_sales_prev_year(t: SalesTables, ordered: bool = True) -> DataFrame:
    """O-23: each market's yearly gross sales with the previous *existing*
    fiscal year's value (LAG 1, positional, NULL for the first year).
    -> (market, fiscal_year, gross_sales_mln, prev_year_sales_mln)

    A window group is one market's years: bounded by the calendar, not by
    the data volume."""
    w = Window.partitionBy("market").orderBy("fiscal_year")
    out = market_year_gross(t).withColumn("prev_year_sales_mln", F.lag("gross_sales_mln", 1).over(w))
    return out.orderBy("market", "fiscal_year") if ordered else out


def gross_sales_next_year(t: SalesTables, ordered: bool = True) -> DataFrame:
    """O-24: same with the next existing fiscal year's value (LEAD 1).
    -> (market, fiscal_year, gross_sales_mln, next_year_sales_mln)"""
    w = Window.partitionBy("market").orderBy("fiscal_year")
    out = market_year_gross(t).withColumn("next_year_sales_mln", F.lead("gross_sales_mln", 1).over(w))
    return out.orderBy("market", "fiscal_year") if ordered else out
