from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loanlife.llm import mixing as M
from loanlife.llm.queries import MIX_BLOCK, op8_mixing

from .conftest import EDGE_DOCS, SMALL


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=12).filter(any))
def test_schedule_keeps_every_source_within_one_block(weights):
    weights = {f"s{i}": w for i, w in enumerate(weights)}
    plan = M.schedule(weights)
    period = sum(weights.values())
    assert sorted(slot for _, _, slot, _, _ in plan) == list(range(period))
    served = Counter()
    for source, j, slot, release, deadline in sorted(plan, key=lambda p: p[2]):
        assert release <= slot < deadline and j == served[source]
        served[source] += 1
        for s, w in weights.items():
            assert abs(served[s] - (slot + 1) * w / period) < 1


def test_query_orders_every_document(spark):
    rows = op8_mixing(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs)
    weights = M.tempered_weights(spark.read.parquet(f"{SMALL}/documents.parquet"), temperature=2.0)
    period, plan = sum(weights.values()), defaultdict(dict)
    for source, j, slot, _, _ in M.schedule(weights):
        plan[source][j] = slot
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append((r["slot"], r["place"], r["release"], r["deadline"]))
    for source, got in by_source.items():
        want = [((n // MIX_BLOCK) // weights[source] * period + plan[source][(n // MIX_BLOCK) % weights[source]], n % MIX_BLOCK)
                for n in range(len(got))]
        assert sorted((s, p) for s, p, _, _ in got) == sorted(want)
        assert all(r <= s < d for s, _, r, d in got)


def test_edge_cases_and_clashing_columns(spark, edge_docs):
    docs = edge_docs.withColumnRenamed("lang", "slot").withColumnRenamed("n_chars", "Place")
    out = M.interleave(docs, {"": 3, "a": 2, "c": 1}, buckets=3)
    assert out.columns == docs.columns + ["_slot", "_place", "release", "deadline"]
    rows = out.collect()
    assert len(rows) == len(EDGE_DOCS)
    slots = [r["_slot"] for r in rows if r["_slot"] is not None]
    assert len(set(slots)) == len(slots) == sum(r[3] in (None, "", "a", "c") for r in EDGE_DOCS)
    assert all((r["_slot"] is None) == (r["source"] in ("b", "d")) for r in rows)


def test_weights(spark, no_docs):
    assert M.quantise({"a": 2, "b": 1, "c": 0.001}, 10) == {"a": 6, "b": 3, "c": 1}
    with pytest.raises(ValueError):
        M.quantise({"a": 1, "b": 1}, 1)
    with pytest.raises(ValueError):
        M.schedule({"a": M.MAX_PERIOD + 1})
    assert M.tempered_weights(no_docs) == {}
    many = spark.range(50).selectExpr("cast(id as string) as source")
    assert M.tempered_weights(many, period=10) == {str(i): 1 for i in range(50)}


def test_weights_follow_the_targets_for_many_sources(spark):
    for n in (900, 1000):
        rows = spark.range(n - 1).selectExpr("cast(id as string) as source").union(
            spark.range((n - 1) // 2).selectExpr("'large' as source"))
        weights = M.tempered_weights(rows)
        share = ((n - 1) // 2) / (n - 1 + (n - 1) // 2)
        assert abs(weights["large"] / sum(weights.values()) - share) < share / M.SLOTS_A_SOURCE + 2e-5


def test_more_sources_than_slots(spark, monkeypatch):
    monkeypatch.setattr(M, "MAX_PERIOD", 2000)
    monkeypatch.setattr(M, "MOST_SOURCES", 20)
    sizes = {f"s{i}": 1 + i % 3 for i in range(3000)} | {"large": 3000}
    rows = spark.createDataFrame([(f"{s}-{k}", s) for s, n in sizes.items() for k in range(n)], "doc_id string, source string")
    with pytest.raises(ValueError):
        M.tempered_weights(rows)
    got = sorted(M.mix(rows, period=10).collect(), key=lambda r: (r["slot"], r["place"]))
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in rows.collect())
    assert len({r["slot"] for r in got}) == len(got) and all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    total, served = len(got), Counter()
    for at, r in enumerate(got[:total // 2], 1):
        served[r["source"]] += 1
        assert abs(served["large"] - at * 3000 / total) < at * 0.05 + 2
        assert served[r["source"]] - r["slot"] * sizes[r["source"]] / total < 2 + 0.1 * sizes[r["source"]]
    assert {s for s, n in sizes.items() if n == 3} <= set(served)


def test_hundred_thousand_sources(spark):
    rows = spark.range(100_001).selectExpr("id as doc_id", "cast(id as string) as source").union(
        spark.range(50_000).selectExpr("id as doc_id", "'large' as source"))
    told = M.mix(rows).selectExpr("source = 'large' as large", "slot").where("slot < 30000").collect()
    assert len(told) == 30_000 and abs(sum(r["large"] for r in told) - 10_000) < 200


def test_empty_table(spark, no_docs, as_tables):
    assert op8_mixing(spark, as_tables(documents=no_docs)).collect() == []
