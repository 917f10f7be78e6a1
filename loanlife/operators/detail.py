"""Servicing detail (M1): per-loan lag features, first-row priors and derived status.

One plan for every panel, whatever the size of its loans: exact copies collapse
in a partial aggregate before the first shuffle; the lags come from a window per
(loan, year), and those that reach over the turn of a year from a summary with
one row per loan-year (``generic.lags_split``).  No task gets a whole loan.
Callers that know every loan to be small may ask for the plan with one window
per loan (``bounded_loans=True``), which saves the second shuffle of the panel.

The order within a loan (period, then every other column) is total once exact
copies are removed, so ties on ``period`` resolve the same way on every run:
first events take the lowest row, the terminal record the highest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlife.functions.exprs import idiv, month_diff, ne_null_safe
from loanlife.operators import generic as G

KEY = "id_loan"
ORDER_HEAD = ["period", "act_endg_upb"]

# Status rule for 'R' rows one calendar month after the previous row
# (previous raw status → derived status).
R_TRANSITIONS = [("5", "6"), ("3", "4"), ("2", "3")]

PRIOR_COLUMNS = ["prior_delq_sts", "prior_delq_sts_2", "prior_period", "prior_upb",
                 "prior_int_rt", "prior_frb_upb"]

# lag name → (column, offset); offsets are 1 or 2.
LAGS = {
    "_l1_sts": ("delq_sts", 1),
    "_l2_sts": ("delq_sts", 2),
    "_l1_upb": ("act_endg_upb", 1),
    "_l1_period": ("period", 1),
    "_l1_rate": ("new_int_rt", 1),
    "_l1_frb": ("amt_non_int_brng_upb", 1),
}


def order_columns(df: DataFrame, key: str = KEY, head=ORDER_HEAD) -> list[str]:
    """Ordering key: ``head`` then every remaining column in schema order."""
    head = [c for c in head if c in df.columns]
    return head + [c for c in df.columns if c != key and c not in head]


def _asc(cols) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def loan_window(df: DataFrame, key: str = KEY, head=ORDER_HEAD) -> Window:
    return Window.partitionBy(key).orderBy(*_asc(order_columns(df, key, head)))


def dedupe_panel(svcg: DataFrame) -> DataFrame:
    """Exact duplicate rows removed.

    ``dropDuplicates`` plans a partial aggregate before its exchange, so copies
    of a row collapse inside each map task: a row repeated a billion times costs
    one row per task in the shuffle, never one hot task.
    """
    return svcg.dropDuplicates()


def year_group() -> Column:
    """Year of a YYYYMM period: never decreases along the order of a loan's rows."""
    return idiv("period", 100)


def lags_one_window(df: DataFrame, key: str = KEY) -> DataFrame:
    """``rn`` and the LAGS columns from one window per loan."""
    return G.lags_one_window(df, key, _asc(order_columns(df, key)), LAGS)


def lags_split(df: DataFrame, key: str = KEY, keep: str | None = None, dealt: str | None = None) -> DataFrame:
    """Same rows as ``lags_one_window``, from windows per (loan, year)."""
    order = order_columns(df.drop(dealt) if dealt else df, key)
    return G.lags_split(df, key, year_group(), _asc(order), LAGS, keep=keep, dealt=dealt)


def priors_from_lags(lagged: DataFrame) -> DataFrame:
    """prior_* columns, period_diff and delq_sts_new from ``rn`` and the LAGS columns."""
    first = F.col("rn") == 1
    upb_type = dict(lagged.dtypes)["act_endg_upb"]
    priors = lagged.select(
        *[c for c in lagged.columns if c not in LAGS],
        F.when(first, F.lit("00")).otherwise(F.col("_l1_sts")).alias("prior_delq_sts"),
        F.when(first, F.lit("00")).when(F.col("rn") >= 3, F.col("_l2_sts")).alias("prior_delq_sts_2"),
        F.when(~first, F.col("_l1_period")).alias("prior_period"),
        F.when(first, F.lit(0).cast(upb_type)).otherwise(F.col("_l1_upb")).alias("prior_upb"),
        F.when(first, F.col("new_int_rt")).otherwise(F.col("_l1_rate")).alias("prior_int_rt"),
        F.when(~first, F.col("_l1_frb")).alias("prior_frb_upb"),
    )
    priors = priors.withColumn("period_diff", month_diff("prior_period", "period"))
    return priors.withColumn("delq_sts_new", delq_state())


def with_priors(df: DataFrame, key: str = KEY, bounded_loans: bool = False, keep: str | None = None,
                dealt: str | None = None) -> DataFrame:
    """Exact copies removed; ``rn`` (row order within the loan), the prior_* columns,
    period_diff and delq_sts_new added.  ``keep`` names a column for the year by
    which (with the loan) the rows come out partitioned (not for bounded loans).
    ``dealt`` names the group of rows that lie dealt by loan and group (see ``generic.lags_split``)."""
    if dealt:
        return priors_from_lags(lags_split(drop_adjacent_copies(df, key, dealt), key, keep, dealt))
    if bounded_loans:
        return priors_from_lags(lags_one_window(drop_adjacent_copies(df, key), key))
    return priors_from_lags(lags_split(dedupe_panel(df), key, keep))


def drop_adjacent_copies(df: DataFrame, key: str = KEY, dealt: str | None = None) -> DataFrame:
    """Exact copies removed inside the window stage per loan, or per (loan, ``dealt``).

    Sorted by every column, copies of a row are adjacent, so one streaming window
    that compares each row with its predecessor removes them; it shares the
    exchange and the sort of the lag window that follows.
    """
    w = Window.partitionBy(key, dealt).orderBy(*_asc(order_columns(df.drop(dealt), key))) if dealt else loan_window(df, key)
    row = F.struct(*df.columns)
    return (df.select("*", F.lag(row, 1).over(w).alias("_prev"))
            .where(~F.col("_prev").eqNullSafe(row)).drop("_prev"))


def delq_state() -> Column:
    """Derived status: the raw status, except 'R' one month after a raw 2 / 3 / 5,
    which becomes 3 / 4 / 6; any other 'R' is missing."""
    one_month = F.col("period_diff") == 1
    rule = F.when(ne_null_safe("delq_sts", "R"), F.col("delq_sts"))
    for before, after in R_TRANSITIONS:
        rule = rule.when(one_month & (F.col("prior_delq_sts") == before), F.lit(after))
    return rule


def servicing_detail(svcg: DataFrame, orig: DataFrame, key: str = KEY,
                     bounded_loans: bool = False, dealt: str | None = None) -> DataFrame:
    """Servicing rows without copies, of loans present in ``orig``, with ``orig_upb``,
    lags, priors and derived status.

    The balance joins last: it is no input of the lags.  A loan with several
    origination balances has its rows once per balance.  Rows of ``svcg`` that lie ``dealt``
    (see ``with_priors``) stay where they are: the balance goes to each group of its loan.
    """
    # Of rows made by a generator Spark expects few: without the hint all of them may be broadcast.
    origin = dedupe_panel(orig.select(key, "orig_upb")).hint("merge")
    if not dealt:
        return with_priors(svcg, key, bounded_loans).join(origin, key, "inner")
    several = svcg.where(F.col(dealt) != G.WHOLE).groupBy(key).agg(F.collect_set(dealt).alias("_groups"))
    whole = F.array(F.lit(G.WHOLE).cast("long"))
    origin = origin.join(several, key, "left").select(key, "orig_upb", F.explode(F.coalesce("_groups", whole)).alias("_group"))
    return with_priors(svcg, key, keep="_group", dealt=dealt).join(origin.hint("merge"), [key, "_group"], "inner").drop("_group")
