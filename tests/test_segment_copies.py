"""Segments of rows that hold copies: one window drops them and tells each row's neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import frames, orig_row, svcg_row
from loanlife.operators import generic as G
from loanlife.operators import segments as S
from loanlife.operators.detail import servicing_detail, year_group
from loanlife.operators.events import loan_events

SPECS = {
    "A": ["199911:990:3", "199912:980:5", "199912:980:5", "200001:970:R"],
    "B": ["200001:990:0", "200001:990:0", "200001:990:0"],
    "C": ["200001:990:1", "200001:980:2", "200001:980:2", "200002:980:R", "200002:980:R", "200003:0:0:09"],
    "D": ["200001:990::", "200001:990::", "200002::0::Y", "200002::0::Y"],
    "E": ["199901:990:0", "199902:980:1", "199903:970:2", "199904:960:3", "199905:950:R:03"],
    "F": ["200001:990:4", "200002:980:5"],
}


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_copies_count_once_in_one_window(spark):
    rows = [svcg_row(k, s) for k, specs in SPECS.items() for s in specs] * 2
    svcg, orig = frames(spark, rows, [orig_row(k) for k in SPECS])
    expected = loan_events(servicing_detail(svcg, orig, bounded_loans=True))
    whole = svcg.withColumn(S.SEG, F.lit(G.WHOLE).cast("long"))
    assert _rows(S.loan_events(whole, year_group()).select(expected.columns)) == _rows(expected)
    made = S.segments(whole)
    assert made.agg(F.sum("n")).first()[0] == len({(k, s) for k, specs in SPECS.items() for s in specs})
    assert made._jdf.queryExecution().executedPlan().toString().count("Window [") == 1


def test_events_alone_are_those_of_the_detail(spark):
    rows = [svcg_row(k, s) for k, specs in SPECS.items() for s in specs] * 2
    svcg, orig = frames(spark, rows, [orig_row(k) for k in SPECS])
    expected = loan_events(servicing_detail(svcg, orig, bounded_loans=True))
    by_year = svcg.withColumn(S.SEG, year_group().cast("long"))
    alone = S.loan_events(by_year, year_group(), terminal=False)
    assert _rows(alone) == _rows(expected.select(alone.columns))
