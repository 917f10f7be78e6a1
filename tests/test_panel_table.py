"""The stored panel: same master, no exchange of its rows, and a layout that cannot be mistaken."""

from __future__ import annotations

import pytest

from loanlife.operators.master import loan_master
from loanlife.sources.panel import panel
from loanlife.sources.panel_table import PanelTable

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    orig, svcg = panel(spark, SF)
    return orig, svcg, _rows(loan_master(svcg, orig, bounded_loans=True))


def test_master_without_an_exchange_of_panel_rows(spark, tables, tmp_path):
    orig, svcg, expected = tables
    table = PanelTable(spark, str(tmp_path / "panel"), buckets=6)
    table.append(svcg.unionByName(svcg))
    assert _rows(table.master(orig)) == expected
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        p = _plan(table.master(orig))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    panel_side = p[p.index("Bucketed: true") - 20000 if p.index("Bucketed: true") > 20000 else 0:p.index("Bucketed: true")]
    rows_window = panel_side.rindex("Window [")
    assert "Exchange" not in panel_side[rows_window:]                 # rows: scan, sort, window
    assert p.count("Exchange hashpartitioning") == 3                  # segments by loan; origination: copies, then by loan
    table.close()


def test_reopened_with_the_layout_it_has(spark, tables, tmp_path):
    orig, svcg, expected = tables
    path = str(tmp_path / "panel")
    table = PanelTable(spark, path, buckets=5)
    table.append(svcg.where("period < 199601"))
    table.close()
    again = PanelTable(spark, path)
    assert again.buckets == 5
    again.append(svcg.where("period >= 199512"))                     # a month that both appends hold
    assert _rows(again.master(orig)) == expected and again.rows().count() == svcg.distinct().count()
    again.compact()
    assert len(again._layout()) == 1 and _rows(again.master(orig)) == expected
    with pytest.raises(ValueError):
        PanelTable(spark, path, buckets=7)
    with pytest.raises(ValueError):
        again.append(svcg.drop("modcost"))
    again.close()
    with pytest.raises(ValueError):
        PanelTable(spark, str(tmp_path / "empty")).rows()
