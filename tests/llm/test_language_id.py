import zlib

from loanlife.llm import language_id as L
from loanlife.llm.queries import op5_language_id

from .conftest import EDGE_DOCS


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    told = op5_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = told.collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edge_cases(spark, edge_docs, as_tables):
    rows = op5_language_id(spark, as_tables(documents=edge_docs)).collect()
    assert len(rows) == len(EDGE_DOCS)
    langs = {"en", "de", "la", "fr"}
    for r in rows:
        if r["doc_id"] in (3, 4, 5, 6):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in langs
        assert r["held_out"] is (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_prediction_uses_the_text_only(spark, edge_docs):
    dictionaries = L.fit(edge_docs)
    swapped = edge_docs.withColumnRenamed("lang", "score").withColumnRenamed("source", "Lang_Pred")
    out = L.identify(swapped, dictionaries)
    assert out.columns[-3:] == ["_lang_pred", "_score", "rejected"]
    plain = L.identify(edge_docs, dictionaries)
    assert sorted((str(r["text"]), r["_lang_pred"], r["_score"]) for r in out.collect()) == \
        sorted((str(r["text"]), r["lang_pred"], r["score"]) for r in plain.collect())


def test_sample_is_bounded_and_takes_copies_once(spark):
    rows = [("copy " * 20, "en")] * 500 + [(f"word{i} text", "en") for i in range(50)] + [("mot", "fr"), (None, "fr"), ("x", None)]
    sample = L.training_sample(spark.createDataFrame(rows, "text string, lang string"), texts=20).collect()
    assert len([r for r in sample if r["lang"] == "en"]) <= 20 and [r["text"] for r in sample if r["lang"] == "fr"] == ["mot"]
    assert len({(r["lang"], r["text"]) for r in sample}) == len(sample)


def test_copies_and_unusable_rows_leave_the_sample_full(spark):
    texts = spark.range(2000).selectExpr("concat('satz nummer ', id) as text", "'de' as lang")
    unusable = spark.range(50_000).selectExpr("if(id % 2 = 0, null, cast(id as string)) as text", "'de' as lang")
    copies = spark.range(1_998_000).selectExpr("'immer derselbe satz' as text", "'de' as lang")
    lowest = {r["text"] for r in L.training_sample(texts, texts=50).collect()}
    sample = L.training_sample(texts.union(copies).union(unusable), texts=50).collect()
    assert len(lowest) == len(sample) == 50
    assert len(lowest - {r["text"] for r in sample}) <= 1      # the copied text may take one place


def test_no_or_one_language_and_empty_tables(spark, no_docs, as_tables):
    assert L.Classifier({}).predict("some text") == ("und", 0.0)
    assert L.Classifier({"en": b"the words of a text"}).predict("some text") == ("en", 1.0)
    assert op5_language_id(spark, as_tables(documents=no_docs)).collect() == []
