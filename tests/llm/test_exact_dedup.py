import hashlib
from collections import defaultdict

import pytest

from loanlife.llm.exact_dedup import DigestIndex
from loanlife.llm.queries import op1_exact_dedup
from loanlife.session import scratch_path

from .conftest import EDGE_DOCS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()].append(doc_id)
    out = []
    for sha, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=str)


def test_query_equals_brute_force_on_edge_cases(spark, edge_docs, as_tables):
    got = op1_exact_dedup(spark, as_tables(documents=edge_docs))
    assert sorted(map(tuple, got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()),
                  key=str) == brute([(r[0], r[1]) for r in EDGE_DOCS])


def test_kept_rows_are_one_per_text_with_own_columns(spark, edge_docs):
    batch = edge_docs.withColumnRenamed("lang", "Digest").withColumnRenamed("source", "stays_id")
    index = DigestIndex(spark, scratch_path(spark, "ix"))
    kept = index.kept_rows(batch, index.append(batch))
    assert kept.columns == batch.columns
    texts = [(r["text"] or "").translate(LOWER) for r in kept.collect()]
    assert sorted(texts) == sorted({(r[1] or "").translate(LOWER) for r in EDGE_DOCS})


def test_index_persists_and_later_batches_keep_only_new_texts(spark):
    path = scratch_path(spark, "ix")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id bigint, text string")
    second = spark.createDataFrame([(4, "b"), (5, "c"), (6, "c")], "doc_id bigint, text string")
    DigestIndex(spark, path, 3).append(first)
    again = DigestIndex(spark, path, 3)
    name = again.append(second)
    assert [r["doc_id"] for r in again.kept_rows(second, name).collect()] == [6]
    told = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in again.label(second, name).collect()}
    assert told == {4: (2, False), 5: (6, False), 6: (6, True)}
    assert sorted(r["keep_id"] for r in again.rows().collect()) == [2, 3, 6]
    assert again.kept_rows(second, again.append(second)).count() == 0


def test_reopened_with_other_settings_no_digest_comes_twice(spark):
    path = scratch_path(spark, "ix")
    batch = spark.range(300).selectExpr("id as doc_id", "concat('text ', id) as text")
    DigestIndex(spark, path, 8).append(batch, name="first")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            index = DigestIndex(spark, path)
            assert index.buckets == 8
            name = index.append(batch)
            assert index.kept_rows(batch, name).count() == 0 and index.label(batch, name).count() == 300
            assert index.rows().count() == 300
            index.close()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(ValueError):
        DigestIndex(spark, path, 4)


def test_a_batch_lost_half_way_is_appended_again(spark):
    index = DigestIndex(spark, scratch_path(spark, "ix"), 4)
    batch = spark.range(60).selectExpr("id as doc_id", "concat('text ', id % 40) as text")
    index.append(batch.where("doc_id % 40 < 13"), name="b")       # what the lost run had written
    assert index.append(batch, name="b") == "b" == index.append(batch, name="b")
    told = index.label(batch, "b").collect()
    assert len(told) == 60 and sum(r["kept"] for r in told) == 40 == index.rows().count()
    assert {r["keep_id"] for r in told} == set(range(20, 60))


def test_join_with_the_index_does_not_shuffle_it(spark, edge_docs):
    index = DigestIndex(spark, scratch_path(spark, "ix"), 4)
    index.append(edge_docs)
    # Each bucket file is written sorted by one task.
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {index.table}").collect()}
    assert described["Num Buckets"] == "4" and "digest" in described["Sort Columns"]


def test_empty_table(spark, no_docs, as_tables):
    assert op1_exact_dedup(spark, as_tables(documents=no_docs)).collect() == []
