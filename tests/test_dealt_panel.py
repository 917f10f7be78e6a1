"""Panel rows made where the windows need them: the same rows, no shuffle of them, none broadcast."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loanlife.operators import generic as G
from loanlife.operators.detail import servicing_detail
from loanlife.operators.master import loan_master
from loanlife.plans.queries import QUERIES
from loanlife.session import scratch_path
from loanlife.sources import panel as P
from loanlife.sources.panel_table import PanelTable

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def orders(spark):
    """Loans of one, two (copies) and three (another balance) orders, some without a key or a date."""
    rows = [(k, k, 1000.5 + 7 * k, f"199{3 + k % 4}-{1 + k % 12:02}-05", "1-URGENT") for k in range(60)]
    rows += [r for r in rows if r[0] % 5 == 0] + [(k, 9, 50000.0, d, p) for k, _, _, d, p in rows if k % 10 == 0]
    rows += [(None, 1, 1.0, "1995-01-01", "X"), (7, 1, 1.0, None, "X"), (-3, 1, 1.0, "1995-01-01", "X")]
    df = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_totalprice double, d string, o_orderpriority string")
    path = scratch_path(spark, "orders")
    df.withColumn("o_orderdate", F.to_timestamp("d")).drop("d").write.parquet(f"{path}/orders.parquet")
    return path


@pytest.mark.parametrize("hot", [0, 1, 1 << 12])
def test_the_same_rows_and_results_however_many_loans_are_dealt_by_year(spark, orders, monkeypatch, hot):
    monkeypatch.setattr(P, "HOT_ORDERS", hot)
    orig, svcg = P.panel(spark, orders)
    dealt_orig, dealt = P.dealt_panel(spark, orders)
    assert _rows(dealt.drop("seg")) == _rows(svcg) and _rows(dealt_orig) == _rows(orig)
    assert (dealt.where(F.col("seg") != G.WHOLE).count() > 0) == (hot < 2)
    assert _rows(servicing_detail(dealt, dealt_orig, dealt="seg")) == _rows(servicing_detail(svcg, orig))
    assert _rows(loan_master(dealt, dealt_orig)) == _rows(loan_master(svcg, orig))


@pytest.mark.parametrize("name", ["waterfall", "rate_fallback", "delq_state", "transition_label"])
def test_rows_made_by_a_generator_are_not_broadcast(spark, name):
    """balances of all loans and summaries of all loan-years went through the driver."""
    joins = [line for line in _plan(QUERIES[name](spark, SF)).splitlines() if "BroadcastHashJoin" in line]
    assert all("LeftOuter" in j for j in joins)        # the few loans that are dealt by year


def test_general_detail_is_not_broadcast(spark):
    orig, svcg = P.panel(spark, SF)
    detail = servicing_detail(svcg, orig).select("id_loan", "prior_upb", "orig_upb")
    assert "BroadcastHashJoin" not in _plan(detail)


def test_panel_rows_are_not_shuffled(spark):
    """the first exchange above the generated months holds no panel row but summaries."""
    for name in ("servicing_detail", "loan_master", "terminal_record", "dlq_90"):
        lines = _plan(QUERIES[name](spark, SF)).splitlines()
        above = [line for line in lines if "Exchange hashpartitioning" in line and "REPARTITION" not in line]
        made = next(i for i, line in enumerate(lines) if "Window [" in line and "lag(" in line and "modcost" in line)
        month = next(i for i, line in enumerate(lines) if i > made and "Generate explode" in line)
        assert above and not any("Exchange" in line for line in lines[made:month]), name


def test_one_split_of_many_rows_is_spread_over_tasks(spark, monkeypatch):
    """a file of one split was parsed by one task, however many rows it had."""
    assert QUERIES["typed_parse"](spark, SF).rdd.getNumPartitions() == 1
    monkeypatch.setattr(P, "TASK_BYTES", 1 << 13)
    many = QUERIES["typed_parse"](spark, SF)
    assert many.rdd.getNumPartitions() == 5
    assert many.count() == P.panel(spark, SF)[1].count()


def test_rows_dealt_by_year_are_stored_where_they_are(spark, orders):
    """rows were moved twice, by all columns and by loan and year, before they were stored."""
    orig, svcg = P.panel(spark, orders)
    dealt_orig, dealt = P.dealt_panel(spark, orders, by_year=True)
    assert _rows(dealt.drop("seg")) == _rows(svcg) and _rows(dealt_orig) == _rows(orig)
    dated = dealt.where("period IS NOT NULL")
    assert dated.where(F.col("seg") == F.expr("period div 100")).count() == dated.count() > 0
    table = PanelTable(spark, scratch_path(spark, "panel-by-year"), P.dealt_parts(spark, orders))
    table.append(dealt)
    assert _rows(table.rows()) == _rows(svcg.distinct())
    files = table.dealt().inputFiles()
    assert 0 < len(files) <= P.dealt_parts(spark, orders)
    table.close()
