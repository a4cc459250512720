"""Spark schemas of the business tables (one row per unique key below)."""

from pyspark.sql import types as T

PRICE = T.DecimalType(15, 4)
RATE = T.DecimalType(5, 4)

SCHEMAS: dict[str, T.StructType] = {
    # key: date, customer_code, product_code
    "fact_sales_monthly": T.StructType([
        T.StructField("date", T.DateType()),
        T.StructField("customer_code", T.LongType()),
        T.StructField("product_code", T.LongType()),
        T.StructField("sold_quantity", T.IntegerType()),
    ]),
    # key: date, customer_code, product_code
    "fact_forecast_monthly": T.StructType([
        T.StructField("date", T.DateType()),
        T.StructField("customer_code", T.LongType()),
        T.StructField("product_code", T.LongType()),
        T.StructField("forecast_quantity", T.IntegerType()),
    ]),
    # key: product_code, fiscal_year
    "fact_gross_price": T.StructType([
        T.StructField("product_code", T.LongType()),
        T.StructField("fiscal_year", T.IntegerType()),
        T.StructField("gross_price", PRICE),
    ]),
    # key: customer_code, fiscal_year
    "fact_pre_invoice_deductions": T.StructType([
        T.StructField("customer_code", T.LongType()),
        T.StructField("fiscal_year", T.IntegerType()),
        T.StructField("pre_invoice_discount_pct", RATE),
    ]),
    # key: date, customer_code, product_code
    "fact_post_invoice_deductions": T.StructType([
        T.StructField("date", T.DateType()),
        T.StructField("customer_code", T.LongType()),
        T.StructField("product_code", T.LongType()),
        T.StructField("discounts_pct", RATE),
        T.StructField("other_deductions_pct", RATE),
    ]),
    # key: customer_code (the name is NOT unique)
    "dim_customer": T.StructType([
        T.StructField("customer_code", T.LongType()),
        T.StructField("customer", T.StringType()),
        T.StructField("market", T.StringType()),
        T.StructField("region", T.StringType()),
    ]),
    # key: product_code (the name is NOT unique)
    "dim_product": T.StructType([
        T.StructField("product_code", T.LongType()),
        T.StructField("product", T.StringType()),
        T.StructField("division", T.StringType()),
    ]),
    # key: calendar_date
    "dim_date": T.StructType([
        T.StructField("calendar_date", T.DateType()),
        T.StructField("fiscal_year", T.IntegerType()),
    ]),
}

KEYS: dict[str, list[str]] = {
    "fact_sales_monthly": ["date", "customer_code", "product_code"],
    "fact_forecast_monthly": ["date", "customer_code", "product_code"],
    "fact_gross_price": ["product_code", "fiscal_year"],
    "fact_pre_invoice_deductions": ["customer_code", "fiscal_year"],
    "fact_post_invoice_deductions": ["date", "customer_code", "product_code"],
    "dim_customer": ["customer_code"],
    "dim_product": ["product_code"],
    "dim_date": ["calendar_date"],
}
