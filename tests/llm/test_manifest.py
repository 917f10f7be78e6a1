"""Manifest: brute force over whole trees, edge rows, parts of a table, and the octopus on its own."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlife.llm import manifest as M
from loanlife.llm.queries import op11_manifest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS)


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, place):
    out = []
    for nodes in levels[:-1]:
        first = place // 3 * 3
        out.append((nodes[first:place], nodes[place + 1:first + 3]))
        place //= 3
    return out


def brute_force(rows):
    """Rows (dicts) to sorted result rows, every proof built and folded on its own."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, own in by_source.items():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[source] = tree_of([leaf_of(r) for r in own])
    top = tree_of([trees[s][-1][0] for s in order])
    out = []
    for at, source in enumerate(order):
        for place, row in enumerate(by_source[source]):
            path = way(trees[source], place) + way(top, at)
            claim = row
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and row["text"]:
                claim = {**row, "text": row["text"].replace("\n", "")}
            folded = leaf_of(claim)
            for left, right in path:
                folded = h([*left, folded, *right])
            out.append((row["doc_id"], leaf_of(row), trees[source][-1][0], top[-1][0],
                        h(x for left, right in path for x in (*left, *right)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def run(spark, df, as_tables):
    got = op11_manifest(spark, as_tables(documents=df))
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))
                   for r in got.collect()), key=repr)


def test_edge_rows_equal_brute_force(spark, edge_docs, as_tables):
    clashing = edge_docs.withColumns({"tree": F.lit(1), "block": F.lit("x"), "NODE": F.lit(None).cast("int")})
    assert run(spark, clashing, as_tables) == brute_force([r.asDict() for r in edge_docs.collect()])


def test_several_blocks_of_a_hot_source_equal_brute_force(spark, as_tables):
    n = F.col("id")
    docs = spark.range(0, 7000, numPartitions=5).select(
        (n * 7919 % 7001).alias("doc_id"), F.concat(F.lit("line\n"), n.cast("string"), F.repeat(F.lit("\né"), (n % 3).cast("int"))).alias("text"),
        F.when(n % 5 == 0, F.lit("en")).alias("lang"),
        F.when(n % 20 == 0, F.concat(F.lit("s"), (n % 700).cast("string"))).when(n % 21 != 0, F.lit("hot")).alias("source"),
        (n % 11).alias("n_chars"))
    got = run(spark, docs, as_tables)
    assert got == brute_force([r.asDict() for r in docs.collect()])
    assert sum(r[-1] for r in got) < len(got)


def test_repeated_rows_are_leaves_of_their_own(spark, as_tables):
    rows = [(5, "a\nb", "en", "x", 3)] * 4 + [(None, None, None, None, None)] * 2 + [(5, "other", "en", "x", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert run(spark, docs, as_tables) == brute_force([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("rows", [0, 1])
def test_empty_table_and_one_leaf(spark, no_docs, as_tables, rows):
    docs = no_docs if not rows else spark.createDataFrame([(1, "a", "en", "s", 1)], no_docs.schema)
    got = run(spark, docs, as_tables)
    assert got == brute_force([r.asDict() for r in docs.collect()])
    if rows:
        assert got[0][1] == got[0][3] and got[0][4] == sha256(b"").hexdigest()


def test_a_part_is_proved_like_the_whole(spark, tmp_path):
    docs = spark.range(0, 5000, numPartitions=3).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(None).cast("string").alias("lang"),
        F.when(F.col("id") % 9 == 0, F.lit("b")).otherwise("a").alias("source"), F.lit(1).alias("n_chars"))
    made = M.Manifest(docs, str(tmp_path / "kept"))
    whole = {r["doc_id"]: r for r in made.audit().collect()}
    keys = docs.select("doc_id").where("doc_id % 611 = 3 or doc_id between 2180 and 2200")
    part = made.audit(keys).collect()
    assert len(part) == keys.count() and all(r == whole[r["doc_id"]] for r in part) and all(r["verified"] for r in part)


def test_missing_is_the_least_union():
    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 4, 10, 100, 731):
        levels = tree_of([h([str(i)]) for i in range(size)])
        for share in (1, 2, 5, size):
            places = np.unique(rng.integers(0, size, share))
            wanted = M.missing(places, size)
            fetched = {(k, p): levels[k][p] for k, ps in enumerate(wanted) for p in ps.tolist()}
            found, root = M.paths(places.tolist(), [levels[0][p] for p in places], size, fetched)
            assert root == levels[-1][0]
            for place, path in zip(places.tolist(), found):
                assert path == tuple(("".join(a), "".join(b)) for a, b in way(levels, place))
                assert M.fold(levels[0][place], path) == root
            for gone in fetched:      # without any one of them some proof is incomplete
                with pytest.raises(KeyError):
                    M.paths(places.tolist(), [levels[0][p] for p in places], size, {k: v for k, v in fetched.items() if k != gone})


def test_heights():
    assert [M.height(n) for n in (0, 1, 2, 3, 4, 9, 10, M.BLOCK, M.BLOCK + 1)] == [0, 0, 1, 1, 2, 2, 3, M.LEVELS, M.LEVELS + 1]
