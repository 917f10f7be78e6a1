"""DuckDB SQL for every registered query (the driver's correctness oracle).

The loan operators are written here in a different shape from the Spark code on
purpose: a loan's rows are one ordered list whose elements look back by index
(no windows), events are ``arg_min`` / ``arg_max`` over the detail, and amounts
are rounded through absolute values in 128-bit integers, so that a mistake shared
by both is unlikely.
"""

from __future__ import annotations

from loanlife.sources.panel import ORIG_COLUMNS, SVCG_COLUMNS

MONEY = "DECIMAL(14,2)"


def _ym(e: str) -> str:
    return f"CAST(CAST(FLOOR(({e})/12.0) AS INT)*100 + ({e})%12 + 1 AS INT)"


LOANS = f"""loans AS (
SELECT o_orderkey AS k,
  CAST(year(o_orderdate)*12 + month(o_orderdate) - 1 AS INT) AS b0,
  CAST(6 + o_orderkey % 31 AS INT) AS n, CAST(o_orderkey % 10 AS INT) AS path,
  CONCAT('F1', SUBSTR(CAST(year(o_orderdate) AS VARCHAR), 3, 2), 'Q',
         CAST(CAST(FLOOR((month(o_orderdate)-1)/3.0) AS INT)+1 AS VARCHAR),
         CASE WHEN o_orderkey < 1000000 THEN LPAD(CAST(o_orderkey AS VARCHAR), 6, '0')
              ELSE CAST(o_orderkey AS VARCHAR) END) AS id_loan,
  CONCAT('Q', CAST(CAST(FLOOR((month(o_orderdate)-1)/3.0) AS INT)+1 AS VARCHAR),
         CAST(year(o_orderdate) AS VARCHAR)) AS orign_qtr,
  CAST(CAST(o_totalprice AS {MONEY}) + 5000 AS {MONEY}) AS orig_upb,
  CAST((300 + o_orderkey % 600)*0.01 AS DECIMAL(6,3)) AS int_rt,
  CAST(550 + o_orderkey % 300 AS INT) AS fico,
  CAST(year(o_orderdate)*100 + month(o_orderdate) AS INT) AS dt_first_pi,
  CAST(360 AS INT) AS orig_loan_term,
  LPAD(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') AS zipcode,
  o_orderpriority AS seller_name
FROM orders)"""

ORIG = f"orig AS (SELECT {', '.join(ORIG_COLUMNS)} FROM loans)"

_DFLT = "m = n-1 AND path IN (5,6,7,9)"
_MONEY_COLS = [("mi_recoveries", 700), ("non_mi_recoveries", 90), ("expenses", 1000),
               ("legal_costs", 210), ("maint_pres_costs", 310), ("taxes_ins_costs", 410),
               ("misc_costs", 110), ("actual_loss", 3000)]

SVCG = f"""svcg AS (
SELECT id_loan, {_ym('b0+m')} AS period,
  CASE WHEN m=n-1 AND path IN (1,5,6,7,8,9) THEN CAST(0 AS {MONEY})
       WHEN path=9 AND k%11=0 AND m=2 THEN CAST(0 AS {MONEY})
       WHEN path=6 AND k%9=0 AND m=n-2 THEN CAST(0 AS {MONEY})
       ELSE CAST(orig_upb - 100*m AS {MONEY}) END AS act_endg_upb,
  CASE WHEN k%19=0 AND m=1 THEN 'XX'
       WHEN m<2 THEN '0'
       WHEN path=3 AND m=3 THEN '1'
       WHEN path=4 AND m<=5 THEN CAST(m-1 AS VARCHAR)
       WHEN path=5 AND m=n-1 AND n>=10 THEN 'R'
       WHEN path=5 THEN CAST(m-1 AS VARCHAR)
       WHEN path=6 AND m>=5 THEN 'R'
       WHEN path=7 AND m>=7 THEN 'R'
       WHEN path IN (6,7) THEN CAST(m-1 AS VARCHAR)
       WHEN path=9 THEN CAST(LEAST(m-1,4) AS VARCHAR)
       ELSE '0' END AS delq_sts,
  m AS loan_age, CAST(360-m AS INT) AS mths_remng,
  CASE WHEN m=n-1 AND path IN (1,5,6,7,8,9) THEN CASE WHEN path=1 THEN 'Y' ELSE 'N' END END AS repch_flag,
  CASE WHEN k%13=0 AND m>=n-2 THEN 'Y' END AS flag_mod,
  CASE WHEN m=n-1 THEN CASE path WHEN 1 THEN '06' WHEN 5 THEN '09' WHEN 6 THEN '09' WHEN 7 THEN '09'
       WHEN 8 THEN '01' WHEN 9 THEN '03' END END AS cd_zero_bal,
  CASE WHEN m=n-1 AND path IN (1,5,6,7,8,9) THEN {_ym('b0+m')} END AS dt_zero_bal,
  CASE WHEN m=n-1 AND path>=5 THEN CAST(0 AS DECIMAL(6,3)) ELSE int_rt END AS new_int_rt,
  CASE WHEN k%7=0 THEN CAST(1000 AS {MONEY}) ELSE CAST(0 AS {MONEY}) END AS amt_non_int_brng_upb,
  {_ym('b0+1')} AS dt_lst_pi,
  CASE WHEN {_DFLT} THEN CASE k%4 WHEN 0 THEN 'C' WHEN 1 THEN 'U'
       ELSE CAST(1000 + k%5000 AS VARCHAR) END END AS net_sale_proceeds,
  {', '.join(f"CASE WHEN {_DFLT} THEN CAST(k%{mod} AS {MONEY}) END AS {name}" for name, mod in _MONEY_COLS)},
  CASE WHEN k%13=0 AND m>=n-2 THEN CAST(k%50 AS {MONEY}) END AS modcost
FROM (SELECT l.*, CAST(UNNEST(range(0, n)) AS INT) AS m FROM loans l) x
WHERE NOT (k%17=0 AND m=5))"""

_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in
                   ["period", "act_endg_upb"] + [c for c in SVCG_COLUMNS
                                                 if c not in ("id_loan", "period", "act_endg_upb")])


def _mi(e: str) -> str:
    return f"(({e})//100*12 + ({e})%100)"


def _num(e: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({e}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') "
            f"THEN CAST(trim({e}) AS DOUBLE) END")


def _detail(src: str, extra: str = "") -> str:
    """Detail rows over CTE ``src`` (deduplicated rows): each loan's rows as one ordered list."""
    columns = SVCG_COLUMNS[1:] + ([extra] if extra else [])
    order = _ORDER + (f", {extra} ASC NULLS FIRST" if extra else "")
    return f"""listed AS (
  SELECT id_loan, list(struct_pack({', '.join(f'{c} := {c}' for c in columns)}) ORDER BY {order}) AS h
  FROM {src} GROUP BY id_loan),
placed AS (SELECT id_loan, h, UNNEST(range(1, len(h) + 1)) AS i FROM listed),
looked AS (
  SELECT id_loan, {', '.join(f'h[i].{c} AS {c}' for c in columns)}, i::INTEGER AS rn,
    CASE WHEN i > 1 THEN h[i - 1].delq_sts ELSE '00' END AS prior_delq_sts,
    CASE WHEN i > 2 THEN h[i - 2].delq_sts WHEN i = 1 THEN '00' END AS prior_delq_sts_2,
    CASE WHEN i > 1 THEN h[i - 1].period END AS prior_period,
    CASE WHEN i > 1 THEN h[i - 1].act_endg_upb ELSE 0::{MONEY} END AS prior_upb,
    h[greatest(i - 1, 1)].new_int_rt AS prior_int_rt,
    CASE WHEN i > 1 THEN h[i - 1].amt_non_int_brng_upb END AS prior_frb_upb
  FROM placed),
detail AS (
  SELECT *, CAST({_mi('period')} - {_mi('prior_period')} AS INT) AS period_diff,
    CASE WHEN COALESCE(delq_sts, '') <> 'R' THEN delq_sts
         WHEN {_mi('period')} = {_mi('prior_period')} + 1
         THEN CASE prior_delq_sts WHEN '2' THEN '3' WHEN '3' THEN '4' WHEN '5' THEN '6' END END AS delq_sts_new
  FROM looked)"""


JOINED = """sv AS (SELECT DISTINCT * FROM svcg),
og AS (SELECT DISTINCT * FROM orig),
j AS (SELECT sv.*, og.orig_upb FROM sv JOIN og ON sv.id_loan = og.id_loan)"""

BASE = f"WITH {LOANS},\n{ORIG},\n{SVCG},\n{JOINED},\n{_detail('j', 'orig_upb')}"

_WF = "COALESCE(NULLIF({a}, 0), NULLIF({b}, 0), {c})"


def _event(cond: str, ind: str, upb: str) -> str:
    """(id_loan, indicator, balance) at a loan's first detail row meeting ``cond``."""
    return (f"SELECT id_loan, 1 AS {ind}, {_WF.format(a='e.a', b='e.b', c='e.c')} AS {upb} "
            f"FROM (SELECT id_loan, arg_min(struct_pack(a := act_endg_upb, b := prior_upb, c := orig_upb), rn) AS e "
            f"FROM detail WHERE {cond} GROUP BY id_loan)")


BUCKET_SQL = {"1": "dlq_ever30", "2": "dlq_ever60", "3": "dlq_everd90", "4": "dlq_everd120",
              "6": "dlq_everd180"}

D180_COND = (f"(delq_sts_new = '6' OR ((cd_zero_bal = '03' OR delq_sts = 'R') "
             f"AND NOT COALESCE({_num('delq_sts_new')} >= 6, FALSE)))")


def bucket_sql(bucket: str) -> str:
    name = BUCKET_SQL[bucket]
    return f"{BASE}\n" + _event(f"delq_sts_new = '{bucket}'", f"{name}_ind", f"{name}_upb")


def pd_d180_sql() -> str:
    return f"{BASE}\n" + _event(D180_COND, "pd_d180_ind", "pd_d180_upb")


def first_mod_sql() -> str:
    return f"{BASE}\n" + _event("flag_mod = 'Y'", "mod_ind", "mod_upb")


TERMINAL_PAYLOAD_SQL = (
    "period, act_endg_upb, delq_sts, repch_flag, flag_mod, cd_zero_bal, dt_zero_bal, new_int_rt, "
    "dt_lst_pi, net_sale_proceeds, mi_recoveries, non_mi_recoveries, expenses, legal_costs, "
    "maint_pres_costs, taxes_ins_costs, misc_costs, actual_loss, modcost, prior_delq_sts, "
    "prior_delq_sts_2, prior_period, prior_upb, prior_int_rt, prior_frb_upb")

_LABEL = "TRIM(CONCAT(COALESCE(CAST({a} AS VARCHAR), ''), ' to ', COALESCE(CAST({b} AS VARCHAR), '')))"

_TERMINAL = [c.strip() for c in TERMINAL_PAYLOAD_SQL.split(",")]

TRM = f"""ends AS (
  SELECT id_loan, arg_max(struct_pack({', '.join(f'{c} := {c}' for c in _TERMINAL)}), rn) AS e
  FROM detail GROUP BY id_loan),
trm AS (
  SELECT id_loan, e.*, orig_upb,
    CASE WHEN e.cd_zero_bal IN ('03','09') THEN {_WF.format(a='e.act_endg_upb', b='e.prior_upb', c='orig_upb')} END AS default_upb,
    COALESCE(NULLIF(e.new_int_rt, 0), e.prior_int_rt) AS current_int_rt,
    {_LABEL.format(a='e.prior_delq_sts', b='e.delq_sts')} AS delq_string,
    {_LABEL.format(a='e.prior_period', b='e.period')} AS month_string,
    orign_qtr, id_loan[3:4] AS vintage
  FROM ends JOIN og USING (id_loan))"""


def terminal_sql() -> str:
    return f"{BASE},\n{TRM}\nSELECT * FROM trm"


def _accrued(principal: str, rate: str, days: str) -> str:
    """Half away from zero, by the absolute value in 128-bit integers (units of 1e-5 times 360 x 100)."""
    units = f"(({principal}) * 100)::HUGEINT * ((({rate}) - 0.35) * 1000)::HUGEINT * ({days})::HUGEINT"
    return (f"CAST((sign({units}) * ((2 * abs({units}) + 360000000) // 720000000))::DECIMAL(18,0) / 10 "
            "AS DECIMAL(18,1))")


def _nullsum(a: str, b: str) -> str:
    return f"CASE WHEN ({a}) IS NOT NULL OR ({b}) IS NOT NULL THEN COALESCE({a}, 0) + COALESCE({b}, 0) END"


def _money_num(e: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({e}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') "
            f"THEN CAST(trim({e}) AS {MONEY}) END")


LOSS = f"""loss AS (
  SELECT *,
    CASE WHEN period // 100 = 1999 THEN NULL
         WHEN trim(net_sale_proceeds) = 'C' THEN CAST(0 AS DECIMAL(16,2))
         ELSE CAST({_nullsum('default_upb', '-' + _money_num('net_sale_proceeds'))} AS DECIMAL(16,2)) END
      AS collateral_deficiency,
    CASE WHEN period // 100 = 1999 THEN NULL
         WHEN trim(net_sale_proceeds) = 'C' THEN CAST(0 AS DECIMAL(18,1))
         ELSE {_accrued(_nullsum('default_upb', '-prior_frb_upb'), 'current_int_rt', 'days_dlq')} END
      AS dlq_accrued_interest
  FROM (SELECT *, CAST(({_mi('period')} - {_mi('dt_lst_pi')}) * 30 AS INT) AS days_dlq
        FROM trm WHERE cd_zero_bal IN ('03','09')) d)"""


def default_loss_sql() -> str:
    return (f"{BASE},\n{TRM},\n{LOSS}\nSELECT id_loan, period, cd_zero_bal, net_sale_proceeds, days_dlq, "
            f"default_upb, current_int_rt, collateral_deficiency, dlq_accrued_interest FROM loss")


def outcome_flags_sql() -> str:
    return (f"{BASE},\n{TRM}\nSELECT id_loan, cd_zero_bal,"
            " CASE WHEN cd_zero_bal IN ('01','06') THEN 1 END AS prepay_count,"
            " CASE WHEN cd_zero_bal IN ('03','09') THEN 1 END AS default_count,"
            " CASE WHEN cd_zero_bal IN ('01','06') THEN prior_upb END AS prepay_upb,"
            " CASE WHEN cd_zero_bal IS NULL OR trim(cd_zero_bal) = '' THEN act_endg_upb END AS rmng_upb"
            " FROM trm")


def default_disposition_sql() -> str:
    dflt = ("CASE WHEN cd_zero_bal = '03' THEN delq_sts WHEN cd_zero_bal = '09' THEN "
            "CASE WHEN prior_delq_sts IS DISTINCT FROM 'R' THEN prior_delq_sts ELSE prior_delq_sts_2 END END")
    acqn = ("CASE WHEN cd_zero_bal = '09' THEN CASE WHEN prior_delq_sts IS DISTINCT FROM 'R' THEN 0 "
            f"ELSE CAST({_mi('period')} - {_mi('prior_period')} AS INT) END END")
    return (f"{BASE},\n{TRM},\ndd AS (SELECT id_loan, cd_zero_bal, {dflt} AS dflt_delq_sts, {acqn} AS acqn_to_dispn, "
            "prior_frb_upb AS frb_upb, vintage FROM trm WHERE cd_zero_bal IN ('03','09'))\n"
            f"SELECT id_loan, cd_zero_bal, dflt_delq_sts, acqn_to_dispn, "
            f"{_nullsum(_num('dflt_delq_sts'), 'CAST(acqn_to_dispn AS DOUBLE)')} AS mths_dlq_dflt_dispn, "
            f"{_nullsum(_num('dflt_delq_sts'), 'CAST(0 AS DOUBLE)')} AS mths_dlq_dflt_acqn, frb_upb, vintage FROM dd")


def master_sql() -> str:
    """One aggregate over the detail for all events, one join to the origination."""
    events = [(f"delq_sts_new = '{b}'", f"{name}_ind", f"{name}_upb") for b, name in BUCKET_SQL.items()]
    events += [("flag_mod = 'Y'", "mod_ind", "mod_upb"), (D180_COND, "pd_d180_ind", "pd_d180_upb")]
    firsts = ",\n    ".join(
        f"arg_min(struct_pack(a := act_endg_upb, b := prior_upb, c := orig_upb), rn) FILTER (WHERE {cond}) AS {upb}"
        for cond, _, upb in events)
    told = ",\n  ".join(f"CASE WHEN s.{upb} IS NOT NULL THEN 1 END AS {ind}, "
                         + _WF.format(a=f"s.{upb}.a", b=f"s.{upb}.b", c=f"s.{upb}.c") + f" AS {upb}"
                         for _, ind, upb in events)
    return f"""{BASE},
{TRM},
{LOSS},
story AS (
  SELECT id_loan,
    {firsts}
  FROM detail GROUP BY id_loan)
SELECT og.*,
  loss.collateral_deficiency, trm.current_int_rt, trm.repch_flag, trm.cd_zero_bal, trm.dt_zero_bal AS zero_bal_period,
  trm.expenses, trm.mi_recoveries, trm.non_mi_recoveries, trm.net_sale_proceeds, trm.actual_loss, trm.legal_costs,
  trm.maint_pres_costs, trm.taxes_ins_costs, trm.misc_costs, trm.modcost, trm.dt_lst_pi,
  trm.delq_sts AS zero_bal_delq_sts, trm.default_upb, loss.dlq_accrued_interest,
  {told},
  CASE WHEN trm.cd_zero_bal IN ('01','06') THEN 1 END AS prepay_count,
  CASE WHEN trm.cd_zero_bal IN ('03','09') THEN 1 END AS default_count,
  CASE WHEN trm.cd_zero_bal IN ('01','06') THEN trm.prior_upb END AS prepay_upb,
  CASE WHEN COALESCE(trim(trm.cd_zero_bal), '') = '' THEN trm.act_endg_upb END AS rmng_upb
FROM og LEFT JOIN trm ON trm.id_loan = og.id_loan LEFT JOIN loss ON loss.id_loan = og.id_loan
  LEFT JOIN story s ON s.id_loan = og.id_loan"""


PANEL = f"WITH {LOANS},\n{ORIG},\n{SVCG}"

NUM = _num
NULLSUM = _nullsum
MONTH_INDEX = _mi
