"""Scalar rules (X1-X13) against independent Python / Spark formulations."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanlife.functions import exprs as X

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

yyyymm = st.builds(lambda y, m: y * 100 + m, st.integers(1900, 2100), st.integers(1, 12))


@SETTINGS
@given(st.lists(st.tuples(yyyymm, yyyymm), min_size=1, max_size=40))
def test_month_diff_matches_calendar(spark, pairs):
    df = spark.createDataFrame(pairs, "a int, b int")
    d = lambda c: F.make_date(X.idiv(c, 100).cast("int"), (F.col(c) % 100).cast("int"), F.lit(1))
    rows = df.select(X.month_diff("a", "b").alias("x"),
                     F.months_between(d("b"), d("a")).cast("int").alias("y")).collect()
    assert all(r.x == r.y for r in rows)


def _py_accrued(p: Decimal, r: Decimal, days: int) -> Decimal:
    v = p * (r - Decimal("0.35")) * days / 360 / 100
    return v.copy_abs().quantize(Decimal("0.1"), rounding=ROUND_HALF_UP).copy_sign(v) if v else Decimal("0.0")


money = st.decimals(min_value=Decimal("-99999999.99"), max_value=Decimal("99999999.99"), places=2)
rate = st.decimals(min_value=Decimal("0"), max_value=Decimal("99.999"), places=3)


@SETTINGS
@given(st.lists(st.tuples(money, rate, st.integers(-20000, 20000)), min_size=1, max_size=40))
def test_accrued_interest_exact(spark, rows):
    df = spark.createDataFrame(rows, "p decimal(15,2), r decimal(6,3), d int")
    got = df.select("p", "r", "d", X.accrued_interest("p", "r", "d").alias("x")).collect()
    for g in got:
        assert g.x == _py_accrued(g.p, g.r, g.d), g


def test_accrued_interest_half_cases(spark):
    # 900 * 5.65 * 180 / 36000 = 25.425 -> 25.4 ; values landing exactly on .x5 round away from 0
    rows = [(Decimal("900.00"), Decimal("6.000"), 180), (Decimal("100.00"), Decimal("0.600"), 360),
            (Decimal("-100.00"), Decimal("0.600"), 360), (None, Decimal("6.000"), 10)]
    got = [r.x for r in spark.createDataFrame(rows, "p decimal(15,2), r decimal(6,3), d int")
           .select(X.accrued_interest("p", "r", "d").alias("x")).collect()]
    assert got == [Decimal("25.4"), Decimal("0.3"), Decimal("-0.3"), None]


def test_waterfall_rate_nullsum(spark):
    rows = [(Decimal("5"), Decimal("7"), Decimal("9")), (Decimal("0"), Decimal("7"), Decimal("9")),
            (None, Decimal("0"), Decimal("9")), (None, None, None), (Decimal("0"), None, Decimal("0"))]
    got = spark.createDataFrame(rows, "a decimal(14,2), b decimal(14,2), c decimal(14,2)").select(
        X.waterfall("a", "b", "c").alias("w"), X.rate_fallback("a", "b").alias("r"),
        X.nullsum("a", "b").alias("s")).collect()
    assert [g.w for g in got] == [5, 7, 9, None, 0]
    assert [g.r for g in got] == [5, 7, 0, None, None]
    assert [g.s for g in got] == [12, 7, 0, None, 0]


def test_number_parsing_is_strict(spark):
    vals = ["6", " 7 ", "6.5", "-3", ".5", "6d", "1e2", "R", "", "XX", None, "NaN", "Infinity"]
    got = [r.x for r in spark.createDataFrame([(v,) for v in vals], "s string")
           .select(X.as_number("s").alias("x")).collect()]
    assert got == [6.0, 7.0, 6.5, -3.0, 0.5, None, None, None, None, None, None, None, None]


def test_labels(spark):
    df = spark.createDataFrame([("F199Q1000123", "00", "3", None, 200001, "1999-02-10")],
                               "id string, a string, b string, p int, q int, d string")
    r = df.select(X.vintage("id").alias("v"), X.transition_label("a", "b").alias("t"),
                  X.transition_label("p", "q").alias("m"), X.transition_label("b", "p").alias("n"),
                  X.quarter_label(F.to_date("d")).alias("ql"), X.is_blank(F.lit("  ")).alias("bl")).first()
    assert (r.v, r.t, r.m, r.n, r.ql, r.bl) == ("99", "00 to 3", "to 200001", "3 to", "Q11999", True)


def test_null_safe_inequality(spark):
    got = [r.x for r in spark.createDataFrame([("R",), ("3",), (None,)], "s string")
           .select(X.ne_null_safe("s", "R").alias("x")).collect()]
    assert got == [False, True, True]


def test_accrued_interest_of_huge_balances_in_both_ansi_modes(spark):
    rows = [(Decimal("900000000000.00"), Decimal("6.000"), 18000), (Decimal("-900000000000.00"), Decimal("6.000"), 18000),
            (Decimal("999999999999.99"), Decimal("99.999"), 36000)]
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            got = (spark.createDataFrame(rows, "p decimal(14,2), r decimal(6,3), d int")
                   .select("p", "r", "d", X.accrued_interest("p", "r", "d").alias("x")).collect())
            assert [g.x for g in got] == [_py_accrued(g.p, g.r, g.d) for g in got], mode
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_money_beyond_the_type_is_no_number(spark):
    rows = [("9999999999999999",), ("999999999999.99",), ("C",), (None,)]
    got = [r.x for r in spark.createDataFrame(rows, "s string").select(X.as_money("s").alias("x")).collect()]
    assert got == [None, Decimal("999999999999.99"), None, None]


def test_quarters_back(spark):
    df = spark.sql("SELECT DATE'1999-02-15' AS d, DATE'2000-01-01' AS e")
    row = df.select(X.quarter_start("d").alias("a"), X.quarter_start("d", 5).alias("b"),
                    X.quarter_starts("d", "e").alias("c")).first()
    assert (str(row.a), str(row.b), [str(x) for x in row.c]) == (
        "1999-01-01", "1997-10-01", ["1999-01-01", "1999-04-01", "1999-07-01", "1999-10-01", "2000-01-01"])
