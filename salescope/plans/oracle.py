"""Independent DuckDB SQL for every registered query.

Each string is the FIXTURES.md mapping of the driver's tables onto the
business schema (a CTE prefix) followed by the report in one flat statement,
product per sale line, ranks count the better rows, a previous year is found by
a self-join, years side by side are filtered sums.  Money is exact decimals,
rounded once, then DOUBLE; sums, counts and ranks are BIGINT.
"""

from __future__ import annotations

from salescope.plans.catalog import PARAMS as P

FY = P["fiscal_year"]
MKT = P["market"]

TABLES = """
shipped AS (
  SELECT CAST(date_trunc('month', li.l_shipdate) AS DATE) AS ship_month, od.o_custkey, od.o_orderpriority, li.*
  FROM orders od, lineitem li WHERE li.l_orderkey = od.o_orderkey
),
dim_date AS (
  SELECT CAST(d AS DATE) AS calendar_date, CAST(year(d + INTERVAL 4 MONTH) AS INTEGER) AS fiscal_year
  FROM (SELECT unnest(generate_series(date_trunc('month', MIN(l_shipdate)), date_trunc('month', MAX(l_shipdate)), INTERVAL 1 MONTH)) AS d
        FROM lineitem)
),
all_years AS (SELECT DISTINCT fiscal_year FROM dim_date),
dim_customer AS (
  SELECT c_custkey AS customer_code, concat(c_mktsegment, '-', c_custkey % 7) AS customer, n_name AS market, r_name AS region
  FROM region, nation, customer WHERE r_regionkey = n_regionkey AND n_nationkey = c_nationkey
),
dim_product AS (SELECT p_partkey AS product_code, p_name AS product, p_type AS division FROM part),
fact_sales_monthly AS (
  SELECT ship_month AS date, o_custkey AS customer_code, l_partkey AS product_code, CAST(SUM(l_quantity) AS INTEGER) AS sold_quantity
  FROM shipped WHERE l_returnflag <> 'R' GROUP BY ALL
),
fact_forecast_monthly AS (
  SELECT ship_month AS date, o_custkey AS customer_code, l_partkey AS product_code,
         CAST(floor(SUM(l_quantity * (80 + (l_partkey * 7 + l_linenumber * 13) % 41)) / 100) AS INTEGER) AS forecast_quantity
  FROM shipped WHERE o_orderpriority <> '1-URGENT' GROUP BY ALL
),
fact_post_invoice_deductions AS (
  SELECT ship_month AS date, o_custkey AS customer_code, l_partkey AS product_code,
         CAST(MAX(l_discount) AS DECIMAL(5,4)) AS discounts_pct, CAST(MAX(l_tax) AS DECIMAL(5,4)) AS other_deductions_pct
  FROM shipped WHERE l_discount + l_tax > 0 GROUP BY ALL
),
fact_gross_price AS (
  SELECT p_partkey AS product_code, fiscal_year,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * (1 + 0.01 * (fiscal_year - 1995)) AS DECIMAL(15,4)) AS gross_price
  FROM part, all_years
),
fact_pre_invoice_deductions AS (
  SELECT c_custkey AS customer_code, fiscal_year,
         CAST((5 + (3 * c_custkey + fiscal_year) % 20) * 0.01 AS DECIMAL(5,4)) AS pre_invoice_discount_pct
  FROM customer, all_years
)"""


_TABLES_MARK = "WITH __business_tables__"


def _text_eq(col: str, value: str) -> str:
    # case- and accent-insensitive match (the Spark side uses UNICODE_CI_AI)
    return f"lower(strip_accents({col})) = lower(strip_accents('{value}'))"


def _fy_of(d: str) -> str:
    return f"CAST(year({d} + INTERVAL 4 MONTH) AS INTEGER)"


def _report(sql: str) -> str:
    return _TABLES_MARK + "\n" + sql


def _mln(amount: str) -> str:
    return f"CAST(ROUND(CAST({amount} AS DECIMAL(30,12)) * CAST(0.000001 AS DECIMAL(7,6)), 2) AS DOUBLE)"


# net sales of one sale line: quantity times price, less the pre-invoice rate, less both post-invoice rates
NET = """CAST(CAST(u.sold_quantity * gp.gross_price AS DECIMAL(24,4)) * (1 - pi.pre_invoice_discount_pct) AS DECIMAL(30,8))
    * CAST(1 - po.discounts_pct - po.other_deductions_pct AS DECIMAL(6,4))"""


def _net(select: str, group: str, tail: str, more: str = "", where: str = "") -> str:
    return _report(f"""SELECT {select}
FROM fact_post_invoice_deductions po
  JOIN fact_sales_monthly u USING (product_code, date, customer_code)
  JOIN dim_date cal ON cal.calendar_date = po.date AND cal.fiscal_year = {FY}
  JOIN fact_pre_invoice_deductions pi ON pi.customer_code = u.customer_code AND pi.fiscal_year = {FY}
  JOIN fact_gross_price gp ON gp.product_code = u.product_code AND gp.fiscal_year = {FY}{more}
{where}GROUP BY {group}
ORDER BY 2 DESC NULLS LAST, 1 LIMIT {tail}""")


CUSTOMER = "\n  JOIN dim_customer who ON who.customer_code = u.customer_code"
PRODUCT = "\n  JOIN dim_product what ON what.product_code = u.product_code"


def _in_market(alias: str) -> str:
    return f"WHERE {_text_eq(alias + '.market', MKT)}\n"


def _accuracy(error: str, forecast: str) -> str:
    """100 - 100 * error / forecast, rounded once, half away from zero, in whole numbers."""
    n = f"(CAST(10000 AS HUGEINT) * ({forecast} - {error}))"
    size = f"((2 * abs({n}) + abs({forecast})) // (2 * abs({forecast})))"
    return f"CASE WHEN {forecast} <> 0 THEN CAST(sign({n}) * sign({forecast}) * {size} AS DOUBLE) / 100 END"


# forecast rows up to the last sale, each with what was sold
COMPARED = f"""(SELECT fc.*, sold.sold_quantity, cal.fiscal_year,
    fc.forecast_quantity::BIGINT - ifnull(sold.sold_quantity, 0) AS net_error,
    abs(fc.forecast_quantity::BIGINT - ifnull(sold.sold_quantity, 0)) AS abs_error
  FROM fact_forecast_monthly fc
    LEFT JOIN fact_sales_monthly sold USING (date, customer_code, product_code), dim_date cal
  WHERE cal.calendar_date = fc.date AND NOT fc.date > (SELECT MAX(date) FROM fact_sales_monthly))"""

TOTALS = """SUM(e.sold_quantity)::BIGINT AS total_sold_qty, SUM(e.forecast_quantity)::BIGINT AS total_forecast_qty,
  SUM(e.net_error)::BIGINT AS total_net_error, SUM(e.abs_error)::BIGINT AS total_abs_error"""
ACCURACY = _accuracy("SUM(e.abs_error)::HUGEINT", "SUM(e.forecast_quantity)::HUGEINT") + " AS forecast_accuracy_pct"
ENDED = f"{FY} <= (SELECT {_fy_of('MAX(date)')} FROM fact_sales_monthly)"


def _year_accuracy(year: int) -> str:
    """Totals and accuracy of each customer in one year."""
    return f"(SELECT e.customer_code, {TOTALS}, {ACCURACY} FROM {COMPARED} e WHERE e.fiscal_year = {year} GROUP BY e.customer_code)"


EARLIER, LATER = min(P["y1"], P["y2"]), max(P["y1"], P["y2"])

# quantity of each product name of a division in the year
QUANTITY = f"""(SELECT what.division, what.product, SUM(u.sold_quantity)::BIGINT AS total_qty
  FROM dim_product what, fact_sales_monthly u, dim_date cal
  WHERE what.product_code = u.product_code AND cal.calendar_date = u.date AND cal.fiscal_year = {FY}
  GROUP BY 1, 2)"""


def _ranks(*kinds: str) -> str:
    """Ranks as one more than the number of better rows or better values."""
    better = {
        "rnk": "1 + COUNT(b.product) FILTER (b.total_qty > a.total_qty)",
        "drnk": "1 + COUNT(DISTINCT b.total_qty) FILTER (b.total_qty > a.total_qty)",
        "row_num": "1 + COUNT(b.product) FILTER (b.total_qty > a.total_qty OR b.total_qty = a.total_qty AND b.product < a.product)",
    }
    return f"""SELECT a.division, a.product, a.total_qty, {', '.join(f'CAST({better[k]} AS BIGINT) AS {k}' for k in kinds)}
FROM {QUANTITY} a JOIN {QUANTITY} b ON a.division IS NOT DISTINCT FROM b.division
GROUP BY a.division, a.product, a.total_qty"""


GROSS = "SUM(u.sold_quantity * gp.gross_price)"


def _gross(column: str, amount: str, who: str) -> str:
    return _report(f"""SELECT u.date, {amount} AS {column}
FROM fact_gross_price gp, fact_sales_monthly u
WHERE gp.fiscal_year = {_fy_of('u.date')} AND gp.product_code = u.product_code AND {who}
GROUP BY 1""")


MARKET_YEARS = f"""(SELECT who.market, gp.fiscal_year, {_mln(GROSS)} AS gross_sales_mln
  FROM dim_date cal, dim_customer who, fact_sales_monthly u, fact_gross_price gp
  WHERE cal.calendar_date = u.date AND who.customer_code = u.customer_code
    AND gp.product_code = u.product_code AND gp.fiscal_year = cal.fiscal_year
  GROUP BY 1, 2)"""


def _beside(column: str, pick: str, side: str) -> str:
    """The nearest existing year of the market on one side, by self-join."""
    return _report(f"""SELECT m.market, m.fiscal_year, m.gross_sales_mln, {pick}(o.gross_sales_mln, o.fiscal_year) AS {column}
FROM {MARKET_YEARS} m LEFT JOIN {MARKET_YEARS} o ON o.market = m.market AND o.fiscal_year {side} m.fiscal_year
GROUP BY 1, 2, 3""")


def _badge(qty: str) -> str:
    return f"if({qty} > {P['badge_threshold']}, 'Gold', 'Silver')"


SOLD = f"{_fy_of('u.date')} = {FY}"

_REPORTS: dict[str, str] = {
    "gross_sales_one_customer": _gross("gross_sales_amount", f"CAST(ROUND({GROSS}, 2) AS DOUBLE)", f"u.customer_code = {P['customer_code']}"),
    "gross_sales_named_customer": _gross(
        "total_gross_sales_amount", f"CAST(ROUND({GROSS}, 2) AS DOUBLE)",
        f"EXISTS (FROM dim_customer who WHERE who.customer_code = u.customer_code AND {_text_eq('who.customer', P['customer_name'])} AND {_text_eq('who.market', MKT)})"),
    "gross_sales_monthly": _gross("gross_price_total", f"CAST({GROSS} AS DOUBLE)", f"concat(',', '{P['customer_codes']}', ',') LIKE concat('%,', u.customer_code, ',%')"),
    "net_sales_by_customer_code": _net(f"u.customer_code, CAST(ROUND(SUM({NET}), 2) AS DOUBLE) AS net_sales", "1", str(P["n"])),
    "net_sales_by_fiscal_year": _net(f"who.market, {_mln(f'SUM({NET})')} AS net_sales_mln", "1", "5", CUSTOMER),
    "top_customers_by_net_sales": _net(f"who.customer, {_mln(f'SUM({NET})')} AS net_sales_mln", "1", str(P["n"]), CUSTOMER, _in_market("who")),
    "top_markets_by_net_sales": _net(f"who.market, {_mln(f'SUM({NET})')} AS net_sales_mln", "1", str(P["n"]), CUSTOMER),
    "top_products_by_net_sales": _net(f"what.product, {_mln(f'SUM({NET})')} AS net_sales_mln", "1", str(P["n"]), CUSTOMER + PRODUCT, _in_market("who")),
    "top_products_per_division": _report(f"SELECT * FROM ({_ranks('drnk')}) WHERE drnk <= {P['n_per_division']}"),
    "forecast_accuracy_base": _report(f"""SELECT e.customer_code, who.customer, who.market, e.fiscal_year, e.forecast_quantity, e.sold_quantity, e.date, e.net_error, e.abs_error
FROM {COMPARED} e, dim_customer who WHERE who.customer_code = e.customer_code"""),
    "forecast_accuracy_by_customer": _report(f"""SELECT who.*EXCLUDE (region), t.*EXCLUDE (customer_code)
FROM {_year_accuracy(FY)} t, dim_customer who WHERE who.customer_code = t.customer_code AND {ENDED}"""),
    "forecast_accuracy_by_market": _report(f"""SELECT who.market, COUNT(DISTINCT who.customer_code) AS customer_count, {TOTALS}, {ACCURACY}
FROM {COMPARED} e, dim_customer who WHERE who.customer_code = e.customer_code AND e.fiscal_year = {FY} AND {ENDED}
GROUP BY who.market"""),
    "forecast_decline_lag": _report(f"""SELECT who.*EXCLUDE (region), CAST({P['y2']} AS INTEGER) AS fiscal_year, late.*EXCLUDE (customer_code), early.forecast_accuracy_pct AS prev_year_accuracy
FROM {_year_accuracy(LATER)} late, {_year_accuracy(EARLIER)} early, dim_customer who
WHERE {P['y2']} = {LATER} AND {EARLIER} <> {LATER} AND late.customer_code = early.customer_code AND who.customer_code = late.customer_code
  AND late.forecast_accuracy_pct < early.forecast_accuracy_pct"""),
    "forecast_decline_pivot": _report(f"""SELECT p.*, ROUND(p.accuracy_y2 - p.accuracy_y1, 2) AS accuracy_change
FROM (SELECT who.customer_code, who.customer, who.market,
    {', '.join(_accuracy(f"SUM(e.abs_error) FILTER (e.fiscal_year = {P[y]})::HUGEINT", f"SUM(e.forecast_quantity) FILTER (e.fiscal_year = {P[y]})::HUGEINT") + f" AS accuracy_{y}" for y in ("y1", "y2"))}
  FROM {COMPARED} e, dim_customer who WHERE who.customer_code = e.customer_code GROUP BY ALL) p
WHERE p.accuracy_y2 < p.accuracy_y1"""),
    "market_badge": _report(f"""SELECT '{MKT}' AS market, CAST({FY} AS INTEGER) AS fiscal_year, q.total_qty, {_badge('q.total_qty')} AS badge
FROM (SELECT if(COUNT(*) = 0, 0, SUM(u.sold_quantity))::BIGINT AS total_qty FROM fact_sales_monthly u
  WHERE {SOLD} AND u.customer_code IN (SELECT customer_code FROM dim_customer {_in_market('dim_customer').strip()})) q"""),
    "market_badges": _report(f"""SELECT who.market, CAST({FY} AS INTEGER) AS fiscal_year, ifnull(SUM(u.sold_quantity), 0)::BIGINT AS total_qty,
  {_badge('ifnull(SUM(u.sold_quantity), 0)')} AS badge
FROM dim_customer who LEFT JOIN fact_sales_monthly u ON u.customer_code = who.customer_code AND {SOLD}
GROUP BY who.market"""),
    "with_fiscal_year": f"""SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date,
  {_fy_of('CAST(l_shipdate AS DATE)')} AS fiscal_year
FROM lineitem""",
    "with_fiscal_quarter": """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date,
  concat('Q', quarter(CAST(l_shipdate AS DATE) + INTERVAL 4 MONTH)) AS fiscal_quarter
FROM lineitem""",
    "division_total_alongside_rows": _report(f"""SELECT what.division, what.product,
  (SELECT SUM(q.total_qty) FROM {QUANTITY} q WHERE q.division IS NOT DISTINCT FROM what.division)::BIGINT AS total_qty_by_division
FROM dim_date cal, dim_product what, fact_sales_monthly u
WHERE u.date = cal.calendar_date AND u.product_code = what.product_code AND cal.fiscal_year = {FY}"""),
    "rank_products": _report(_ranks("rnk")),
    "dense_rank_products": _report(_ranks("drnk")),
    "row_number_products": _report(_ranks("row_num")),
    "rank_comparison": _report(_ranks("rnk", "drnk", "row_num")),
    "gross_sales_prev_year": _beside("prev_year_sales_mln", "arg_max", "<"),
    "gross_sales_next_year": _beside("next_year_sales_mln", "arg_min", ">"),
}


def _on_driver_tables(sql: str) -> str:
    return sql.replace(_TABLES_MARK, "WITH" + TABLES)


def _on_business_tables(sql: str) -> str:
    return sql.replace(_TABLES_MARK + ",\n", "WITH ").replace(_TABLES_MARK + "\n", "")


# the oracle of each registered query on the driver's tables (business
# tables derived in SQL by the FIXTURES.md mapping)
ORACLE_SQL: dict[str, str] = {k: _on_driver_tables(v) for k, v in _REPORTS.items()}

# the same reports on views named after the eight business tables (used to
# check the operators on hand-made, skewed business tables)
REPORT_SQL: dict[str, str] = {
    k: _on_business_tables(v) for k, v in _REPORTS.items() if _TABLES_MARK in v
}
