"""The loan master through SQL over temporary views.

The views' names are unique per call, so that two callers in one session never
replace each other's.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from loanlife.functions.exprs import NUMBER_PATTERN
from loanlife.operators.events import BUCKETS
from loanlife.operators.master import loan_events_from_panel
from loanlife.plans import sql_functions


def _event(event: str, ind: str, upb: str) -> str:
    return f"CASE WHEN {event} IS NOT NULL THEN 1 END AS {ind}, CASE WHEN {event} IS NOT NULL THEN COALESCE({event}.upb, o.orig_upb) END AS {upb}"


def _months(period: str) -> str:
    return f"({period} div 100 * 12 + {period} % 100)"


def sql_master(orig: DataFrame, svcg: DataFrame, all_sql: bool = False) -> DataFrame:
    """Every column of the loan master, written as SQL over the origination and the loans' events.

    With ``all_sql`` the events are SQL over the panel too (``sql_functions``), for panels
    whose loans are small.
    """
    spark, tag = orig.sparkSession, uuid.uuid4().hex
    if all_sql:
        sql_functions.register(spark)
        svcg.createOrReplaceTempView(f"panel_{tag}")
        detail = sql_functions.sql_detail(f"panel_{tag}", svcg.columns)
        spark.sql(sql_functions.sql_events(detail)).createOrReplaceTempView(f"events_{tag}")
    else:
        loan_events_from_panel(svcg).createOrReplaceTempView(f"events_{tag}")
    orig.createOrReplaceTempView(f"origination_{tag}")
    buckets = ", ".join(_event(name, f"{name}_ind", f"{name}_upb") for _, name in BUCKETS)
    return spark.sql(f"""
      WITH loans AS (
        SELECT o.*, terminal AS t, {", ".join(name for _, name in BUCKETS)}, first_mod, pd_d180,
               terminal.cd_zero_bal IN ('03', '09') AS defaulted,
               COALESCE(NULLIF(terminal.act_endg_upb, 0), NULLIF(terminal.prior_upb, 0), o.orig_upb) AS last_upb,
               COALESCE(NULLIF(terminal.new_int_rt, 0), terminal.prior_int_rt) AS rate,
               COALESCE(terminal.period div 100 = 1999, false) AS no_loss_year,
               COALESCE(trim(terminal.net_sale_proceeds) = 'C', false) AS covered,
               CASE WHEN trim(terminal.net_sale_proceeds) RLIKE r'{NUMBER_PATTERN}'
                    THEN try_cast(trim(terminal.net_sale_proceeds) AS DECIMAL(14,2)) END AS proceeds,
               ({_months("terminal.period")} - {_months("terminal.dt_lst_pi")}) * 30 AS days
        FROM (SELECT DISTINCT * FROM origination_{tag}) o LEFT JOIN events_{tag} USING (id_loan)),
      amounts AS (
        SELECT *, CASE WHEN defaulted THEN last_upb END AS default_upb,
               CAST((COALESCE(last_upb, 0) - COALESCE(t.prior_frb_upb, 0)) * 100 AS DECIMAL(18,0))
               * CAST(rate * 1000 - 350 AS DECIMAL(8,0)) * CAST(days AS DECIMAL(6,0)) AS units
        FROM loans)
      SELECT {", ".join(f"o.{c}" for c in orig.columns)},
        CAST(CASE WHEN defaulted AND NOT no_loss_year THEN CASE WHEN covered THEN 0
             WHEN default_upb IS NOT NULL OR proceeds IS NOT NULL
             THEN COALESCE(default_upb, 0) - COALESCE(proceeds, 0) END END AS DECIMAL(16,2)) AS collateral_deficiency,
        rate AS current_int_rt, t.repch_flag, t.cd_zero_bal, t.dt_zero_bal AS zero_bal_period, t.expenses,
        t.mi_recoveries, t.non_mi_recoveries, t.net_sale_proceeds, t.actual_loss, t.legal_costs,
        t.maint_pres_costs, t.taxes_ins_costs, t.misc_costs, t.modcost, t.dt_lst_pi,
        t.delq_sts AS zero_bal_delq_sts, default_upb,
        CAST(CASE WHEN defaulted AND NOT no_loss_year THEN CASE WHEN covered THEN 0
             WHEN default_upb IS NOT NULL OR t.prior_frb_upb IS NOT NULL
             THEN CAST(sign(units) * ((abs(units) + 180000000) div 360000000) AS DECIMAL(18,0)) / 10 END END
             AS DECIMAL(18,1)) AS dlq_accrued_interest,
        {buckets},
        CASE WHEN t.cd_zero_bal IN ('01', '06') THEN 1 END AS prepay_count,
        CASE WHEN defaulted THEN 1 END AS default_count,
        CASE WHEN t.cd_zero_bal IN ('01', '06') THEN t.prior_upb END AS prepay_upb,
        CASE WHEN t.cd_zero_bal IS NULL OR trim(t.cd_zero_bal) = '' THEN t.act_endg_upb END AS rmng_upb,
        {_event("first_mod", "mod_ind", "mod_upb")}, {_event("pd_d180", "pd_d180_ind", "pd_d180_upb")}
      FROM amounts o""")
