"""Per-loan lifecycle events (M2-M5) as conditional aggregates over the detail.

Each event is ``min_by(payload, rn)`` restricted to the rows that satisfy its
condition (rows failing it get a NULL ordering value, which ``min_by`` skips);
the terminal record is ``max_by(payload, rn)``.  All of them run in one
``groupBy(id_loan)``.  ``segments`` gives the same events from the panel without
a detail row ever being joined or moved again: one row per loan-year is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlife.functions.exprs import as_number, nonzero

# Delinquency buckets (derived status text) and their output names.
BUCKETS = [("1", "dlq_ever30"), ("2", "dlq_ever60"), ("3", "dlq_everd90"),
           ("4", "dlq_everd120"), ("6", "dlq_everd180")]

# Zero-balance code groups.
PREPAY_CODES = ["01", "06"]
DEFAULT_CODES = ["03", "09"]


def event_payload() -> list[Column]:
    """Period and balance at an event: ending, else prior balance; NULL leaves it to the origination balance."""
    return [F.col("period"), F.coalesce(nonzero("act_endg_upb"), nonzero("prior_upb")).alias("upb")]


TERMINAL_PAYLOAD = [
    "period", "act_endg_upb", "delq_sts", "repch_flag", "flag_mod", "cd_zero_bal",
    "dt_zero_bal", "new_int_rt", "dt_lst_pi", "net_sale_proceeds", "mi_recoveries",
    "non_mi_recoveries", "expenses", "legal_costs", "maint_pres_costs", "taxes_ins_costs",
    "misc_costs", "actual_loss", "modcost", "prior_delq_sts", "prior_delq_sts_2",
    "prior_period", "prior_upb", "prior_int_rt", "prior_frb_upb",
]


def bucket_condition(bucket: str) -> Column:
    """First time in a bucket: derived status equals the bucket (a jump over a
    bucket does not count as being in it)."""
    return F.col("delq_sts_new") == F.lit(bucket)


def d180_condition() -> Column:
    """D180, or an earlier default: derived status '6', or (code '03' or raw 'R')
    when the derived status is not a number >= 6."""
    severe = F.coalesce(as_number("delq_sts_new") >= 6, F.lit(False))
    default_like = (F.col("cd_zero_bal") == "03") | (F.col("delq_sts") == "R")
    return (F.col("delq_sts_new") == "6") | (F.coalesce(default_like, F.lit(False)) & ~severe)


def mod_condition() -> Column:
    return F.col("flag_mod") == "Y"


def first_where(cond: Column, payload: list, order: str = "rn") -> Column:
    """Payload struct of the lowest-ordered row meeting ``cond`` (NULL if none)."""
    return F.min_by(F.struct(*payload), F.when(cond, F.col(order)))


def last_row(payload: list[str], order: str = "rn") -> Column:
    return F.max_by(F.struct(*payload), F.col(order))


def event_columns() -> dict[str, Column]:
    """Name → aggregate for every lifecycle event."""
    aggs = {name: first_where(bucket_condition(b), event_payload()) for b, name in BUCKETS}
    aggs["pd_d180"] = first_where(d180_condition(), event_payload())
    aggs["first_mod"] = first_where(mod_condition(), event_payload())
    aggs["terminal"] = last_row(TERMINAL_PAYLOAD)
    return aggs


def loan_events(detail: DataFrame, key: str = "id_loan", only: list[str] | None = None) -> DataFrame:
    """One row per loan: a struct column per event (NULL when the event never happened)."""
    aggs = event_columns()
    names = only or list(aggs)
    return detail.groupBy(key).agg(*[aggs[n].alias(n) for n in names])
