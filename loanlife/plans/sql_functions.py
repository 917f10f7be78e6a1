"""The lifecycle rules for SQL users: scalar functions, and the detail and events as SQL over two views.

``register(spark)`` declares temporary SQL functions (Spark inlines their bodies, so a
call costs what the expression costs).  ``sql_detail`` and ``sql_events`` hold the text of the
servicing detail and of the loans' events; ``sql_surface.sql_master`` can build on them, so
that a master is SQL from the lags to its last select.  The detail's windows take a whole loan at a time,
as the original's do: for panels whose loans are small (the ``bounded_loans`` contract).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from loanlife.functions.exprs import NUMBER_PATTERN
from loanlife.operators.detail import R_TRANSITIONS
from loanlife.operators.events import BUCKETS, TERMINAL_PAYLOAD

MONEY, RATE = "DECIMAL(14,2)", "DECIMAL(6,3)"

_MONTHS = "({0} div 100 * 12 + {0} % 100)"

# name → (parameters, type, body)
FUNCTIONS = {
    "loan_waterfall": (f"a {MONEY}, b {MONEY}, c {MONEY}", MONEY, "COALESCE(NULLIF(a, 0), NULLIF(b, 0), c)"),
    "loan_rate": (f"new_rate {RATE}, prior_rate {RATE}", RATE, "COALESCE(NULLIF(new_rate, 0), prior_rate)"),
    "loan_month_gap": ("a INT, b INT", "INT", f"CAST({_MONTHS.format('b')} - {_MONTHS.format('a')} AS INT)"),
    "loan_number": ("x STRING", "DOUBLE", f"CASE WHEN trim(x) RLIKE r'{NUMBER_PATTERN}' THEN CAST(trim(x) AS DOUBLE) END"),
    "loan_status": ("sts STRING, prior_sts STRING, gap INT", "STRING",
                    "CASE WHEN NOT (sts <=> 'R') THEN sts "
                    + " ".join(f"WHEN gap = 1 AND prior_sts = '{a}' THEN '{b}'" for a, b in R_TRANSITIONS) + " END"),
    "loan_d180": ("status STRING, sts STRING, code STRING", "BOOLEAN",
                  "COALESCE(status = '6', false) OR COALESCE(code = '03' OR sts = 'R', false) "
                  "AND NOT COALESCE(loan_number(status) >= 6, false)"),
}


def register(spark: SparkSession) -> None:
    """Declare the functions in the session (again, if they are there)."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")


def sql_detail(panel_view: str, columns: Sequence[str], key: str = "id_loan") -> str:
    """Rows without copies, their order, lags, priors and derived status.  ``columns``: those of the panel."""
    order = ["period", "act_endg_upb"] + [c for c in columns if c not in (key, "period", "act_endg_upb")]
    ordered = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return f"""
      SELECT *, loan_status(delq_sts, prior_delq_sts, period_diff) AS delq_sts_new FROM (
        SELECT {", ".join(columns)}, rn,
          CASE WHEN rn = 1 THEN '00' ELSE l1.delq_sts END AS prior_delq_sts,
          CASE WHEN rn = 1 THEN '00' WHEN rn >= 3 THEN l2 END AS prior_delq_sts_2,
          l1.period AS prior_period,
          CASE WHEN rn = 1 THEN CAST(0 AS {MONEY}) ELSE l1.act_endg_upb END AS prior_upb,
          CASE WHEN rn = 1 THEN new_int_rt ELSE l1.new_int_rt END AS prior_int_rt,
          l1.amt_non_int_brng_upb AS prior_frb_upb, loan_month_gap(l1.period, period) AS period_diff
        FROM (SELECT *, row_number() OVER w AS rn, lag(delq_sts, 2) OVER w AS l2,
                     lag(struct(delq_sts, period, act_endg_upb, new_int_rt, amt_non_int_brng_upb)) OVER w AS l1
              FROM (SELECT DISTINCT * FROM {panel_view})
              WINDOW w AS (PARTITION BY {key} ORDER BY {ordered})))"""


def sql_events(detail: str, key: str = "id_loan") -> str:
    """One row per loan: a struct per event and the terminal record, from the text of a detail."""
    conditions = {name: f"delq_sts_new = '{bucket}'" for bucket, name in BUCKETS}
    conditions |= {"pd_d180": "loan_d180(delq_sts_new, delq_sts, cd_zero_bal)", "first_mod": "flag_mod = 'Y'"}
    payload = "struct(period, COALESCE(NULLIF(act_endg_upb, 0), NULLIF(prior_upb, 0)) AS upb)"
    events = ", ".join(f"min_by({payload}, rn) FILTER (WHERE {cond}) AS {name}" for name, cond in conditions.items())
    return f"SELECT {key}, {events}, max_by(struct({', '.join(TERMINAL_PAYLOAD)}), rn) AS terminal FROM ({detail}) GROUP BY {key}"
