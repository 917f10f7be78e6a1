"""Registered queries: name → (spark, sf_dir) → DataFrame, each with DuckDB oracle SQL.

Every query reads the driver tables in ``sf_dir`` (or data Spark derives from
them), over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlife.operators import outcomes, segments
from loanlife.operators.detail import servicing_detail, year_group
from loanlife.operators.events import BUCKETS
from loanlife.operators.master import loan_master
from loanlife.plans import oracle
from loanlife.plans.master_store import MasterStore
from loanlife.session import scratch_path
from loanlife.sources.panel import dealt_panel, dealt_parts, panel
from loanlife.sources.panel_table import PanelTable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- loan lifecycle (M1-M9) -------------------------------------------------

def _detail(spark, sf):
    orig, svcg = dealt_panel(spark, sf)
    return servicing_detail(svcg, orig, dealt=segments.SEG)


register("servicing_detail", f"{oracle.BASE}\nSELECT * FROM detail")(_detail)


@register("delq_state", f"{oracle.BASE}\nSELECT id_loan, period, delq_sts, prior_delq_sts, "
          "period_diff, delq_sts_new FROM detail")
def q_delq_state(spark, sf):
    return _detail(spark, sf).select("id_loan", "period", "delq_sts", "prior_delq_sts",
                                     "period_diff", "delq_sts_new")


def _first_event(name: str, ind: str, upb: str) -> Query:
    def q(spark, sf):
        orig, svcg = dealt_panel(spark, sf)
        events = segments.loan_events(svcg, year_group(), events=[name], terminal=False)
        return segments.first_event(events, orig, name, ind, upb)
    return q


for (_b, _name), _key in zip(BUCKETS, ["dlq_30", "dlq_60", "dlq_90", "dlq_120", "dlq_180"]):
    register(_key, oracle.bucket_sql(_b))(_first_event(_name, f"{_name}_ind", f"{_name}_upb"))

register("pd_d180", oracle.pd_d180_sql())(_first_event("pd_d180", "pd_d180_ind", "pd_d180_upb"))
register("first_mod", oracle.first_mod_sql())(_first_event("first_mod", "mod_ind", "mod_upb"))


def _events(spark, sf):
    orig, svcg = dealt_panel(spark, sf)
    return segments.loan_events(svcg, year_group(), events=[]), orig


def _known(events, orig):
    """Events of loans that have an origination row."""
    return events.join(orig.select("id_loan"), "id_loan", "left_semi")


@register("terminal_record", oracle.terminal_sql())
def q_terminal_record(spark, sf):
    ev, orig = _events(spark, sf)
    return outcomes.terminal_record(ev, orig)


@register("default_loss", oracle.default_loss_sql())
def q_default_loss(spark, sf):
    ev, orig = _events(spark, sf)
    return outcomes.default_loss(ev, orig)


@register("outcome_flags", oracle.outcome_flags_sql())
def q_outcome_flags(spark, sf):
    ev, orig = _events(spark, sf)
    return outcomes.outcome_flags(_known(ev, orig))


@register("default_disposition", oracle.default_disposition_sql())
def q_default_disposition(spark, sf):
    ev, orig = _events(spark, sf)
    return outcomes.default_disposition(_known(ev, orig))


@register("loan_master", oracle.master_sql())
def q_loan_master(spark, sf):
    orig, svcg = dealt_panel(spark, sf)
    return loan_master(svcg, orig)


@register("loan_master_batches", oracle.master_sql())
def q_loan_master_batches(spark, sf):
    """The panel in three batches, the oldest periods last, merged into a stored state as they come."""
    orig = panel(spark, sf, cluster=True)[0]
    store = MasterStore(spark, scratch_path(spark, "master-store"))
    for name, first, last in (("middle", 199501, 199612), ("later", 199701, 999912), ("earlier", 0, 199412)):
        svcg = panel(spark, sf, cluster=True, between=(first, last))[1]
        store.load(svcg.where(F.col("period").between(first, last)), name)
    return store.master(orig)


@register("loan_master_stored", oracle.master_sql())
def q_loan_master_stored(spark, sf):
    """The panel stored in buckets by loan and year when the query is built; the master reads it as it lies."""
    orig, svcg = dealt_panel(spark, sf, by_year=True)
    table = PanelTable(spark, scratch_path(spark, "panel-table"), dealt_parts(spark, sf))
    table.append(svcg)
    return table.master(orig)


from loanlife.plans import generic_queries as _generic  # noqa: E402,F401  (registers the rest)
