"""Lifecycle state of a run of a loan's rows, mergeable with the run that follows it.

A *segment* is one row for a loan's rows of one group (a year, a quarter; any integer
that never decreases along the loan's order).  It holds what the lifecycle events need
and nothing that depends on rows outside the segment:

    n                          rows
    head_period, head_upb, head_met
                               the first row, whose previous row lies in the segment before: a bit for
                               each event that it meets whatever that row is, and one for status 'R'
    <event>_at, <event>_upb    the first row after the head that meets the event's condition: its order
                               and period packed into one long, and the balance
    last_period, last_sts, last_upb
                               what the next head needs of the last row
    last, second, third_sts    for the terminal record: the last row, what lags take of the one before it,
                               the status before that

Segments of a loan that follow one another merge into one of the same form
(``fold``): the head of each is judged against the last row of the one before.
Merging is associative, so the same function serves the panel in one go (loan-years
to loans), a stored state and the quarter that comes next, and the repair of a
loan whose rows arrive out of order.  ``finish`` turns the segment of a whole loan into
its events.

Rows move once, dealt by (loan, group); after that only segments do.  All but the
terminal record are fixed-width values (status and events as small integers), so
that events alone are found by hash aggregation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlife.functions.exprs import month_diff, nonzero
from loanlife.operators.detail import R_TRANSITIONS, dedupe_panel, delq_state, order_columns
from loanlife.operators.events import BUCKETS, TERMINAL_PAYLOAD, bucket_condition, d180_condition, mod_condition

SEG = "seg"

EVENTS = tuple(name for _, name in BUCKETS) + ("pd_d180", "first_mod")
IS_R = 1 << len(EVENTS)      # bit of ``head_met``
NO_PERIOD = -(1 << 31)

# What the terminal record reads of the last row, and of the row before it.
LAST = [c for c in TERMINAL_PAYLOAD if not c.startswith("prior_")] + ["amt_non_int_brng_upb"]
LAGGED = ["period", "delq_sts", "act_endg_upb", "new_int_rt", "amt_non_int_brng_upb"]


def conditions() -> dict[str, Column]:
    """Event → condition on a row with its own columns, ``prior_*`` and ``delq_sts_new``."""
    out = {name: bucket_condition(b) for b, name in BUCKETS}
    return out | {"pd_d180": d180_condition(), "first_mod": mod_condition()}


def _at(order: Column, period: Column) -> Column:
    """Order and period in one long that sorts by order."""
    low = F.coalesce(period, F.lit(NO_PERIOD)).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(order.cast("long"), 32).bitwiseOR(low)


def _period_of(at: Column) -> Column:
    period = F.shiftright(F.shiftleft(at, 32), 32).cast("int")
    return F.when(period != NO_PERIOD, period)


def _bit(mask: str, name: str) -> Column:
    return F.col(mask).bitwiseAND(F.lit(1 << EVENTS.index(name))) != 0


def _state_code(sts: Column) -> Column:
    """Statuses that an 'R' row looks back at, as their number; 0 for all others."""
    rule = F.lit(0)
    for before, _ in R_TRANSITIONS:
        rule = F.when(sts == before, F.lit(int(before))).otherwise(rule)
    return rule


def deal(svcg: DataFrame, group: Column, key: str = "id_loan", distinct: bool = True) -> DataFrame:
    """Rows without copies, with their group as ``seg``, dealt by loan and group.

    Copies collapse in a partial aggregate before they move; ``distinct=False``
    is for rows known to have none.
    """
    rows = dedupe_panel(svcg) if distinct else svcg
    first = F.lit(-(2 ** 63)).cast("long")
    return rows.withColumn(SEG, F.coalesce(group.cast("long"), first)).repartition(key, SEG)


def segments(dealt: DataFrame, key: str = "id_loan", events: Iterable[str] = EVENTS, terminal: bool = True) -> DataFrame:
    """One row per (loan, ``seg``) of rows that are partitioned by them, made where the rows are.  Copies count once.

    ``events`` and ``terminal`` choose what is kept.  There is one window, over rows packed into one value each: copies
    are neighbours in its order and share a dense rank, and the row before the first of them is the one
    before all, so that lags need no second window once copies are gone.
    """
    names, order = list(events), order_columns(dealt.drop(SEG), key)
    # A value orders by its fields in turn; the last stands beside it too, so that the plan tells how far the order goes.
    w = Window.partitionBy(key, SEG).orderBy(F.col("_row").asc_nulls_first(), F.col(order[-1]).asc_nulls_first())
    packed = dealt.select(key, SEG, F.struct(*order).alias("_row"), order[-1])
    # Only the terminal record asks which row is the last but one; events need an order alone.
    number = F.dense_rank() if terminal else F.row_number()
    looked = packed.select("*", number.over(w).alias("rn"), F.lag("_row").over(w).alias("_before"))
    lagged = LAGGED if terminal else LAGGED[:3]
    looked = looked.where(~F.col("_before").eqNullSafe(F.col("_row"))).select(
        key, SEG, "rn", "_row", "_before", *[F.col("_row")[c].alias(c) for c in order], *[F.col("_before")[c].alias(f"_l1_{c}") for c in lagged])
    # What conditions read: a head's previous row is not here, so that it meets what needs none.
    rows = (looked.withColumns({"prior_delq_sts": F.col("_l1_delq_sts"), "prior_period": F.col("_l1_period")})
            .withColumn("period_diff", month_diff("prior_period", "period")).withColumn("delq_sts_new", delq_state()))
    found = conditions()
    met = F.when(F.col("delq_sts") == "R", F.lit(IS_R)).otherwise(0)
    for name in names:
        met = met + F.when(found[name], F.lit(1 << EVENTS.index(name))).otherwise(0)
    upb = F.coalesce(nonzero("act_endg_upb"), nonzero("_l1_act_endg_upb"))
    rows = rows.withColumns({"_met": met, "_upb": upb, "_order": _at(F.col("rn"), F.col("period"))})
    is_head = F.col("rn") == 1
    aggs = [F.count(F.lit(1)).alias("n"), F.max(F.when(is_head, F.col("period"))).alias("head_period"),
            F.max(F.when(is_head, F.col("act_endg_upb"))).alias("head_upb"), F.max(F.when(is_head, F.col("_met"))).alias("head_met"),
            F.max_by("period", "rn").alias("last_period"), F.max_by(_state_code(F.col("delq_sts")), "rn").alias("last_sts"),
            F.max_by("act_endg_upb", "rn").alias("last_upb")]
    for name in names:
        at = F.when(~is_head & _bit("_met", name), F.col("_order"))
        aggs += [F.min(at).alias(f"{name}_at"), F.min_by("_upb", at).alias(f"{name}_upb")]
    if not terminal:
        return rows.groupBy(key, SEG).agg(*aggs)
    # The last row but one is of the other parity than the last.
    told = [F.max_by("_row", "rn").alias("_last"), F.max_by("_before", "rn").alias("_second"),
            *[F.max_by("_l1_delq_sts", F.when(F.col("rn") % 2 == i, F.col("rn"))).alias(f"_third_{i}") for i in (0, 1)]]
    made = rows.groupBy(key, SEG).agg(*aggs, *told)
    second = F.struct(*[F.col("_second")[c].alias(c) for c in LAGGED])
    return made.select(*[c for c in made.columns if c not in ("_last", "_second", "_third_0", "_third_1")],
                       F.struct(*[F.col("_last")[c].alias(c) for c in LAST]).alias("last"),
                       F.when(F.col("n") >= 2, second).alias("second"),
                       F.when(F.col("n") % 2 == 0, F.col("_third_1")).otherwise(F.col("_third_0")).alias("third_sts"))


def _names(segs: DataFrame) -> list[str]:
    return [name for name in EVENTS if f"{name}_at" in segs.columns]


def _head_meets(name: str, before_period: Column | None, before_sts: Column | None) -> Column:
    """Whether a segment's head meets an event, given the row before it (None: there is none)."""
    flag = _bit("head_met", name)
    into = {after: before for before, after in R_TRANSITIONS}
    bucket = next((b for b, n in BUCKETS if n == name), None)
    if before_sts is None or bucket not in into:
        return flag
    is_r = F.col("head_met").bitwiseAND(F.lit(IS_R)) != 0
    turned = is_r & (month_diff(before_period, F.col("head_period")) == 1) & (before_sts == int(into[bucket]))
    return flag | F.coalesce(turned, F.lit(False))


def fold(segs: DataFrame, key: str = "id_loan") -> DataFrame:
    """Each loan's segments, of different ``seg``, merged into one; its ``seg`` is that of the last."""
    names, terminal, columns = _names(segs), "second" in segs.columns, segs.columns
    w = Window.partitionBy(key).orderBy(SEG)
    looked = segs.select(
        "*", F.row_number().over(w).alias("_no"), F.lead(F.lit(1)).over(w).isNull().alias("_is_last"),
        *[F.lag(c, 1).over(w).alias(f"_l1_{c}") for c in ("last_period", "last_sts", "last_upb")],
        # Few nested fields: beyond 100 of them Spark leaves code generation.
        *([F.lag(F.struct(*[F.col("last")[c].alias(c) for c in LAGGED], "n", F.col("second.delq_sts").alias("second_sts")), 1)
           .over(w).alias("_one"), F.lag("last.delq_sts", 2).over(w).alias("_two_sts")] if terminal else []))
    # The head of the first segment is judged later, when what comes before it is known.
    is_first, is_last = F.col("_no") == 1, F.col("_is_last")
    by_head = F.lit(0)
    for name in names:
        meets = ~is_first & _head_meets(name, F.col("_l1_last_period"), F.col("_l1_last_sts"))
        by_head = by_head + F.when(meets, F.lit(1 << EVENTS.index(name))).otherwise(0)
    looked = looked.withColumns({"_by_head": by_head, "_head_upb": F.coalesce(nonzero("head_upb"), nonzero("_l1_last_upb"))})
    aggs = [F.max(SEG).alias(SEG), F.sum("n").alias("n"),
            *[F.max(F.when(is_first, F.col(c))).alias(c) for c in ("head_period", "head_upb", "head_met")],
            *[F.max(F.when(is_last, F.col(c))).alias(c) for c in ("last_period", "last_sts", "last_upb")]]
    for name in names:
        here, kept = _bit("_by_head", name), F.col(f"{name}_at")
        at = (F.when(here, _at(F.col("_no"), F.col("head_period")))
              .when(kept.isNotNull(), _at(F.col("_no"), _period_of(kept))))
        upb = F.when(here, F.col("_head_upb")).otherwise(F.col(f"{name}_upb"))
        aggs += [F.min(at).alias(f"{name}_at"), F.min_by(upb, at).alias(f"{name}_upb")]
    if terminal:
        one = F.struct(*[F.col("_one")[c].alias(c) for c in LAGGED])
        second = F.when(F.col("n") >= 2, F.col("second")).when(~is_first, one)
        third = (F.when(F.col("n") >= 3, F.col("third_sts")).when(F.col("n") == 2, F.col("_one.delq_sts"))
                 .when(F.col("_one.n") >= 2, F.col("_one.second_sts")).otherwise(F.col("_two_sts")))
        aggs.append(F.max(F.when(is_last, F.struct("last", second.alias("second"), third.alias("third_sts")))).alias("_end"))
    made = looked.groupBy(key).agg(*aggs)
    return (made.select("*", "_end.*") if terminal else made).select(*columns)


def finish(state: DataFrame, key: str = "id_loan") -> DataFrame:
    """Events of whole loans, one segment each: a struct column per event (NULL when it never
    happened) and, if kept, the terminal record."""
    events = []
    for name in _names(state):
        at_head = F.struct(F.col("head_period").alias("period"), nonzero("head_upb").alias("upb"))
        later = F.struct(_period_of(F.col(f"{name}_at")).alias("period"), F.col(f"{name}_upb").alias("upb"))
        events.append(F.when(_head_meets(name, None, None), at_head).when(F.col(f"{name}_at").isNotNull(), later).alias(name))
    if "second" not in state.columns:
        return state.select(key, *events)
    first, last, second = F.col("n") == 1, F.col("last"), F.col("second")
    upb = state.schema["last"].dataType["act_endg_upb"].dataType.simpleString()
    prior = {
        "prior_delq_sts": F.when(first, F.lit("00")).otherwise(second["delq_sts"]),
        "prior_delq_sts_2": F.when(first, F.lit("00")).otherwise(F.col("third_sts")),
        "prior_period": second["period"],
        "prior_upb": F.when(first, F.lit(0).cast(upb)).otherwise(second["act_endg_upb"]),
        "prior_int_rt": F.when(first, last["new_int_rt"]).otherwise(second["new_int_rt"]),
        "prior_frb_upb": second["amt_non_int_brng_upb"],
    }
    terminal = F.struct(*[prior.get(c, last[c]).alias(c) for c in TERMINAL_PAYLOAD])
    return state.select(key, *events, terminal.alias("terminal"))


def loan_events(svcg: DataFrame, group: Column, key: str = "id_loan", events: Iterable[str] = EVENTS,
                terminal: bool = True) -> DataFrame:
    """Panel → events of each loan (see ``finish``).  Rows with a column ``seg`` lie dealt by loan and
    ``seg`` already and stay where they are."""
    dealt = svcg if SEG in svcg.columns else deal(svcg, group, key)
    return finish(fold(segments(dealt, key, events, terminal), key), key)


def first_event(events: DataFrame, orig: DataFrame, name: str, ind: str, upb: str, key: str = "id_loan") -> DataFrame:
    """Loans of ``orig`` on which event ``name`` occurred: indicator 1 and the balance at it.  Of several
    origination balances of a loan the least counts."""
    e = events.where(F.col(name).isNotNull()).select(key, f"{name}.upb")
    origin = orig.groupBy(key).agg(F.min("orig_upb").alias("orig_upb"))
    return e.hint("merge").join(origin, key).select(key, F.lit(1).alias(ind), F.coalesce("upb", "orig_upb").alias(upb))
