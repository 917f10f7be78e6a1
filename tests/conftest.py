from __future__ import annotations

import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loanlife.session import local_session  # noqa: E402
from loanlife.sources.panel import ORIG_COLUMNS, SVCG_COLUMNS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="loanlife-tests")
    yield s
    s.stop()


SVCG_DDL = ", ".join(f"{c} {t}" for c, t in [
    ("id_loan", "string"), ("period", "int"), ("act_endg_upb", "decimal(14,2)"), ("delq_sts", "string"),
    ("loan_age", "int"), ("mths_remng", "int"), ("repch_flag", "string"), ("flag_mod", "string"),
    ("cd_zero_bal", "string"), ("dt_zero_bal", "int"), ("new_int_rt", "decimal(6,3)"),
    ("amt_non_int_brng_upb", "decimal(14,2)"), ("dt_lst_pi", "int"), ("net_sale_proceeds", "string"),
    ("mi_recoveries", "decimal(14,2)"), ("non_mi_recoveries", "decimal(14,2)"),
    ("expenses", "decimal(14,2)"), ("legal_costs", "decimal(14,2)"),
    ("maint_pres_costs", "decimal(14,2)"), ("taxes_ins_costs", "decimal(14,2)"),
    ("misc_costs", "decimal(14,2)"), ("actual_loss", "decimal(14,2)"), ("modcost", "decimal(14,2)")])

ORIG_DDL = ("id_loan string, orign_qtr string, orig_upb decimal(14,2), int_rt decimal(6,3), fico int, "
            "dt_first_pi int, orig_loan_term int, zipcode string, seller_name string")

assert [c.split()[0] for c in SVCG_DDL.split(", ")] == SVCG_COLUMNS
assert [c.split()[0] for c in ORIG_DDL.split(", ")] == ORIG_COLUMNS


def svcg_row(loan: str, spec: str, **extra) -> dict:
    """``period:upb:status[:code][:mod]`` → servicing row dict (rate 6.000)."""
    parts = spec.split(":") + [""] * 5
    period, upb, sts, code, mod = parts[:5]
    row = {c: None for c in SVCG_COLUMNS}
    row.update(id_loan=loan, period=int(period), act_endg_upb=Decimal(upb) if upb else None,
               delq_sts=sts or None, cd_zero_bal=code or None, flag_mod=mod or None,
               new_int_rt=Decimal("6.000"), amt_non_int_brng_upb=Decimal("0.00"))
    row.update(extra)
    return row


def orig_row(loan: str, upb: str = "1000.00") -> dict:
    return {"id_loan": loan, "orign_qtr": "Q11999", "orig_upb": Decimal(upb), "int_rt": Decimal("6.000"),
            "fico": 700, "dt_first_pi": 199901, "orig_loan_term": 360, "zipcode": "01234",
            "seller_name": "S"}


def frames(spark, svcg_rows: list[dict], orig_rows: list[dict]):
    svcg = spark.createDataFrame([tuple(r[c] for c in SVCG_COLUMNS) for r in svcg_rows], SVCG_DDL)
    orig = spark.createDataFrame([tuple(r[c] for c in ORIG_COLUMNS) for r in orig_rows], ORIG_DDL)
    return svcg, orig
