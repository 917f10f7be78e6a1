from loanlife.operators import generic as G
from loanlife.plans import generic_queries as Q

from conftest import frames, orig_row, svcg_row


def test_spells_move_only_the_columns_that_tell_them_apart(spark, monkeypatch):
    spec = ["199901:100:0", "199901:100:0", "199901:100:1", "199901::2", "199902:90:1", "199902:90:", "199903:80:", "199904:70:0"]
    # Rows that tie on period, balance and status and differ in a later column, in both orders.
    rows = [svcg_row(loan, s, misc_costs=None, loan_age=age) for loan in ("A", "B", None) for s in spec for age in (2, None, 1)]
    svcg, _ = frames(spark, rows, [orig_row("A")])
    whole = G.drop_adjacent(svcg, Q._STATUS_ORDER, compare=["id_loan", "delq_sts"]).select("id_loan", "period", "delq_sts")
    moved, drop = [], G.drop_adjacent
    monkeypatch.setattr(Q, "_svcg", lambda *_: svcg)
    monkeypatch.setattr(Q.G, "drop_adjacent", lambda df, *a, **k: moved.append(df.columns) or drop(df, *a, **k))
    got = Q.q_status_spells(spark, "")
    assert moved == [["id_loan", "period", "act_endg_upb", "delq_sts"]]
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and got.count() == 21
