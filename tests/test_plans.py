"""Plan shape: no Python in the hot path, no cartesian products, one window + one join."""

from __future__ import annotations

import pytest

from loanlife.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def static_plans(spark):
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_no_python_udf_or_cartesian_anywhere(spark):
    for name, q in QUERIES.items():
        if name in ("io_roundtrip", "ingest_by_quarter", "append_quarters", "loan_master_batches", "lag_runs",
                    "quarantine", "status_spells"):
            continue  # these write files while being built; covered by test_ingest
        p = _plan(q(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def _on_plain_files(spark):
    from loanlife.session import scratch_path
    from loanlife.sources.panel import panel
    orig, svcg = panel(spark, SF)
    po, ps = scratch_path(spark, "orig"), scratch_path(spark, "svcg")
    orig.write.parquet(po)
    svcg.write.parquet(ps)
    return spark.read.parquet(ps), spark.read.parquet(po)


def test_loan_master_shape_on_plain_files(spark, static_plans):
    from loanlife.operators.master import loan_master
    p = _plan(loan_master(*_on_plain_files(spark)))
    by = [line.split("], [")[1] for line in p.splitlines() if "Window [" in line]
    # rows are windowed per (loan, year); only segments, one row for each of these, per loan
    assert len(by) == 2 and "seg#" not in by[0] and "seg#" in by[1]
    assert p.count("SortMergeJoin") == 1          # origination with events; no row is joined
    # segments are made where the windows left the rows
    made = p[p.index("Window ["):p.rindex("Window [")]
    assert made.count("Exchange") == 1 and "hashpartitioning(id_loan" in made and "seg#" not in made.split("Exchange")[1].split("\n")[0]
    # the rows move twice: copies collapse in a partial aggregate before the first, the second deals them out
    assert p[p.rindex("Window ["):].count("Exchange") == 2 + 0


def test_events_alone_are_found_by_hash_aggregation(spark, static_plans):
    for name in ("dlq_30", "dlq_60", "dlq_90", "dlq_120", "dlq_180", "pd_d180", "first_mod"):
        p = _plan(QUERIES[name](spark, SF))
        assert "SortAggregate" not in p and "ObjectHashAggregate" not in p and "HashAggregate" in p, name


def test_loan_master_shape_for_bounded_loans(spark, static_plans):
    """The caller's contract that every loan is small: one exchange and one sort of the panel."""
    from loanlife.operators.master import loan_master
    p = _plan(loan_master(*_on_plain_files(spark), bounded_loans=True))
    # panel: one exchange by id_loan; origination: dedupe exchange + exchange by id_loan
    assert p.count("Exchange hashpartitioning") == 3
    assert p.count("SortMergeJoin") == 1
    assert p.count("Window [") == 2  # adjacent-copy filter, then the lags, over one sort
    panel_side = p[p.index("SortAggregate"):]
    assert panel_side.count("Sort [") == 1 and panel_side.count("Exchange") == 1


def test_narrow_queries_have_no_exchange(spark):
    for name in ("vintage", "filter_eq", "filter_range", "filter_in", "filter_null_safe", "month_diff", "nullsum",
                 "typed_parse", "drop_null_key"):
        assert "Exchange" not in _plan(QUERIES[name](spark, SF)), name


def test_scan_prunes_columns(spark):
    p = _plan(QUERIES["loan_master"](spark, SF))
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert scans and all("o_comment" not in s and "o_orderstatus" not in s for s in scans)


def test_filter_reaches_scan(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_returnflag = 'R'").select("l_orderkey")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p


def test_first_row_is_partially_aggregated(spark, static_plans):
    p = _plan(QUERIES["first_by_min"](spark, SF))
    assert "partial_min_by" in p  # reduced per key inside each map task, before the exchange
    p = _plan(QUERIES["window_first"](spark, SF))
    assert "WindowGroupLimit" in p


def test_union_of_filters_computes_the_detail_once(spark):
    for name in ("union_all", "union_distinct"):
        p = _plan(QUERIES[name](spark, SF))
        assert p.count("explode") >= 1 and "Union" not in p, name
        assert p.count("Scan parquet") == _plan(QUERIES["servicing_detail"](spark, SF)).count("Scan parquet"), name
