"""Column expressions for the scalar rules (all JVM-side; no Python UDFs).

Every helper accepts column names or Columns and returns a Column, so it composes
inside ``select`` / ``agg`` and stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = "Column | str"

# A number as text: optional sign, digits with an optional fraction, or a bare
# fraction.  Anything else (codes such as 'R', 'C', 'XX', blanks) is not a number.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nonzero(x) -> Column:
    """x, or NULL when x is 0 (so that coalesce skips both 0 and missing)."""
    x = _c(x)
    return F.when(x != 0, x)


def waterfall(*cols) -> Column:
    """First value that is neither 0 nor NULL; the last argument is the fallback as is.

    Used for the UPB at an event: ending balance, else prior balance, else the
    origination balance.
    """
    cs = [_c(c) for c in cols]
    return F.coalesce(*[nonzero(c) for c in cs[:-1]], cs[-1])


def rate_fallback(new_rate, prior_rate) -> Column:
    """Current rate: the new rate unless it is 0 or missing, then the prior rate."""
    return waterfall(new_rate, prior_rate)


def idiv(a, b) -> Column:
    """Integer division (truncates toward zero), exact for longs."""
    return F.call_function("div", _c(a), _c(b) if not isinstance(b, int) else F.lit(b))


def month_index(yyyymm) -> Column:
    """Months since year 0 for an int YYYYMM (calendar months, not YYYYMM arithmetic)."""
    p = _c(yyyymm)
    return (idiv(p, 100) * 12 + p % 100).cast("int")


def month_diff(start_yyyymm, end_yyyymm) -> Column:
    """Whole calendar months from start to end; NULL if either is NULL."""
    return (month_index(end_yyyymm) - month_index(start_yyyymm)).cast("int")


def nullsum(*cols) -> Column:
    """Sum that skips NULLs; NULL only when every argument is NULL."""
    cs = [_c(c) for c in cols]
    any_present = F.lit(False)
    total = None
    for c in cs:
        any_present = any_present | c.isNotNull()
        total = F.coalesce(c, F.lit(0)) if total is None else total + F.coalesce(c, F.lit(0))
    return F.when(any_present, total)


def ne_null_safe(x, value) -> Column:
    """x <> value where a missing x counts as different (NOT (x <=> value))."""
    return ~_c(x).eqNullSafe(F.lit(value))


def as_number(x) -> Column:
    """Text holding a number → double; any other text (codes, blanks, NULL) → NULL."""
    t = F.trim(_c(x))
    return F.when(t.rlike(NUMBER_PATTERN), t.cast("double"))


def as_money(x, dtype: str = "decimal(14,2)") -> Column:
    """Text holding a number → decimal; codes such as 'C' or 'U', and numbers that the type cannot hold → NULL."""
    t = F.trim(_c(x))
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast(dtype))


def is_blank(x) -> Column:
    """Missing or only blanks."""
    x = _c(x)
    return x.isNull() | (F.trim(x) == "")


def transition_label(before, after) -> Column:
    """'<before> to <after>', missing parts as blank, outer blanks trimmed."""
    return F.trim(F.concat(F.coalesce(_c(before).cast("string"), F.lit("")), F.lit(" to "),
                           F.coalesce(_c(after).cast("string"), F.lit(""))))


def vintage(id_loan) -> Column:
    """Origination year digits embedded in the loan id (characters 3-4)."""
    return F.substring(_c(id_loan), 3, 2)


def quarter_label(date_col) -> Column:
    """'Q<q><yyyy>' for a date / timestamp."""
    d = _c(date_col)
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.year(d).cast("string"))


def quarter_start(date_col, back: int = 0) -> Column:
    """First day of the quarter that lies ``back`` quarters before the date's own."""
    return F.add_months(F.trunc(_c(date_col), "quarter"), -3 * back)


def quarter_starts(first, last) -> Column:
    """First days of all quarters from the one of ``first`` to the one of ``last``."""
    return F.sequence(quarter_start(first), quarter_start(last), F.expr("INTERVAL 3 MONTHS"))


# Fixed value: the loss rule's servicing-fee spread, in thousandths.
SERVICING_SPREAD_MILLI = 350


def accrued_interest(principal, rate, days) -> Column:
    """round(principal * (rate - 0.35) * days / 360 / 100, 1), exact and half away from zero.

    ``principal`` is money with 2 decimals and ``rate`` has 3 decimals, so the
    product is an integer count of 1e-5 units.  It is held in decimals of up to
    34 digits: principals below 1e16, rates below 1e5 and days below 1e6 cannot overflow.
    """
    cents = (_c(principal) * 100).cast("decimal(18,0)")
    milli = (_c(rate) * 1000 - SERVICING_SPREAD_MILLI).cast("decimal(8,0)")
    num = (cents * milli * _c(days).cast("decimal(6,0)")).cast("decimal(35,0)")   # value * 3.6e9
    den = F.lit(360_000_000).cast("decimal(9,0)")          # one tenth, in the same units
    half = F.lit(180_000_000).cast("decimal(9,0)")
    tenths = F.when(num < 0, -idiv(half - num, den)).otherwise(idiv(num + half, den))
    return (tenths.cast("decimal(18,0)") / 10).cast("decimal(18,1)")
