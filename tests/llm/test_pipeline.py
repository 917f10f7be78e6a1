import corpus_pipeline as C
from loanlife.llm.language_id import normalise

from .conftest import EDGE_DOCS, DOCS_DDL
from .test_byte_bpe import REFERENCE
from .test_exact_dedup import LOWER
from .test_jaccard_join import brute as grouped


def test_pipeline_equals_brute_force(spark, as_tables, small_docs):
    rows = EDGE_DOCS + [(d + 100, t, "en", f"s{d % 3}", len(t)) for d, t in small_docs]
    rows = [r for r in rows if r[0] is not None]
    docs = spark.createDataFrame(rows, DOCS_DDL)
    told = C.language_id.identify(docs, C.language_id.fit(docs)).collect()
    left = {(r["doc_id"], r["text"]) for r in told if not r["rejected"]}
    assert all(normalise(t) for _, t in left) and len(left) > 0.9 * len(set(rows)) - 5
    latest = {}
    for d, t in sorted(left):
        latest[t.translate(LOWER)] = (d, t)
    once = list(latest.values())
    kept = {d for d, _, component in grouped(once) if component == d}
    want = sorted((d, REFERENCE.encode_ordinary(t)) for d, t in once if d in kept)
    got = C.run(spark, as_tables(documents=docs)).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in got) == want
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) == len(r["offsets"]) for r in got)


def test_stages_take_empty_tables_and_edge_cases(spark, edge_docs, no_docs):
    clash = edge_docs.withColumnRenamed("lang", "Digest").withColumnRenamed("n_chars", "ids").selectExpr("*", "source as lang")
    for docs in (no_docs, edge_docs, clash):
        for name, stage in C.STAGES:
            out = stage(spark, docs, "")
            if name != "byte_bpe":
                assert out.columns == docs.columns
            rows = out.collect()
            assert len(rows) <= docs.count()


def test_result_holds_the_mixture(spark, as_tables, small_docs):
    """Fails without the mixing stage: positions are then those of the stage before."""
    rows = [(d, t, "en", "large" if d % 8 else f"small{d % 3}", len(t)) for d, t in small_docs]
    packed, coalesced = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.enabled"
    before = {k: spark.conf.get(k) for k in (packed, coalesced)}
    path = as_tables(documents=spark.createDataFrame(rows, DOCS_DDL))
    try:
        spark.conf.set(packed, "20k")         # files of several splits, packed by size
        spark.conf.set(coalesced, "false")    # several files
        got = sorted(C.run(spark, path).collect(), key=lambda r: r["position"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [r["position"] for r in got] == list(range(len(got)))
    kept = spark.createDataFrame([(r["doc_id"], r["source"]) for r in got], "doc_id bigint, source string")
    mixed = C.mixing.mix(kept, period=C.MIX_PERIOD, temperature=C.MIX_TEMPERATURE, block_rows=C.MIX_BLOCK)
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in sorted(mixed.collect(), key=lambda r: (r["slot"], r["place"]))]
    sizes = {s: sum(r["source"] == s for r in got) for s in {r["source"] for r in got}}
    roots = sum(n ** 0.5 for n in sizes.values())
    early = int(min(n ** 0.5 for n in sizes.values()) * roots)        # no source has run out by then
    for s, n in sizes.items():
        assert abs(sum(r["source"] == s for r in got[:early]) - early * n ** 0.5 / roots) < 2
