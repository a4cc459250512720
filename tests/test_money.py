from decimal import Decimal


from salescope.functions.money import accuracy_pct, gross_amount, net_amount, net_invoice_amount, to_millions


def test_three_layers(spark):
    # qty 10, price 20, pre 0.10, discount 0.05, other 0.05 -> 200 / 180 / 162
    df = spark.createDataFrame(
        [(10, Decimal("20.0000"), Decimal("0.1000"), Decimal("0.0500"), Decimal("0.0500"))],
        "q int, p decimal(15,4), pre decimal(5,4), d decimal(5,4), o decimal(5,4)")
    r = (df.select(gross_amount("q", "p").alias("g"), "pre", "d", "o")
         .select("g", net_invoice_amount("g", "pre").alias("nis"), "d", "o")
         .select("g", "nis", net_amount("nis", "d", "o").alias("net")).first())
    assert (r.g, r.nis, r.net) == (Decimal("200"), Decimal("180"), Decimal("162"))


def test_net_is_exact_at_full_width(spark):
    # widest price and rates: the chain must not lose digits
    q, p, pre, d, o = 2_000_000_000, Decimal("99999999999.9999"), Decimal("0.1234"), Decimal("0.0567"), Decimal("0.0891")
    df = spark.createDataFrame([(q, p, pre, d, o)], "q int, p decimal(15,4), pre decimal(5,4), d decimal(5,4), o decimal(5,4)")
    r = df.select(net_amount(net_invoice_amount(gross_amount("q", "p"), "pre"), "d", "o").alias("n")).first()
    g = q * p
    nis = g - g * pre
    assert r.n == nis - nis * (d + o)


def test_millions_are_rounded_once(spark):
    df = spark.createDataFrame([(Decimal(x),) for x in ("1234567.891234567890", "-5000", "1004999.995", "1005000")], "x decimal(38,12)")
    got = sorted(r.m for r in df.select(to_millions("x").alias("m")).collect())
    assert got == [Decimal("-0.01"), Decimal("1.00"), Decimal("1.01"), Decimal("1.23")]


def _acc(spark, a, f):
    df = spark.createDataFrame([(a, f)], "a bigint, f bigint")
    p = df.select(accuracy_pct("a", "f").alias("p")).first().p
    return None if p is None else float(p)


def test_accuracy_golden(spark):
    # forecast 100/50, sold 90/NULL -> abs errors 10 + 50 over 150 -> 60.00
    assert _acc(spark, 60, 150) == 60.0
    assert _acc(spark, 0, 10) == 100.0
    assert _acc(spark, 30, 10) == -200.0  # accuracy can go negative


def test_accuracy_is_rounded_once(spark):
    assert _acc(spark, 4, 128) == 96.88
    assert _acc(spark, 3, 32) == 90.63
    assert _acc(spark, 2469, 20000) == 87.66
    assert _acc(spark, 1, 3) == 66.67 and _acc(spark, 2, 3) == 33.33
    assert _acc(spark, 20001, 10000) == -100.01  # half away from zero below zero too
    assert _acc(spark, 400_002, 200_000) == -100.0


def test_accuracy_zero_forecast_is_null(spark):
    assert _acc(spark, 5, 0) is None


def test_accuracy_huge_sums_exact(spark):
    a, f = 123_456_789_012_345_678, 987_654_321_098_765_432
    expect = ((f - a) * 10000 * 2 + f) // (2 * f) / 100
    assert _acc(spark, a, f) == expect


def test_accuracy_negative_forecast_sum(spark):
    assert _acc(spark, 10, -20) == 150.0
    assert _acc(spark, 1, -3) == 133.33
