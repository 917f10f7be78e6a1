import random
import re
from collections import defaultdict

import pytest

from loanlife.llm import jaccard_join as J
from loanlife.llm.queries import op2_jaccard_join

from .conftest import EDGE_DOCS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return sorted(((d, len(s), min((x for x in groups[find(i)] if x is not None), default=None))
                   for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def near_copies(seed, families=12, members=14):
    """Families of texts with few to many edits, so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((3, 6, 9, 15, 30, 60, 150, 400)))]
        if rng.random() < 0.4:
            base += passage
        for _ in range(members):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3, len(base) // 30 + 1))):
                at = rng.randrange(len(words) + 1)
                words[at:at + rng.choice((0, 1))] = [rng.choice(vocabulary)]
            rows.append((len(rows) * 7 % 1009, " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_brute_force_near_the_threshold(spark, as_tables, seed):
    rows = near_copies(seed) + [(r[0] + 5000 if r[0] else None, r[1]) for r in EDGE_DOCS if r[1] is None or len(r[1]) < 999]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = op2_jaccard_join(spark, as_tables(documents=docs)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_edge_cases_and_extra_columns(spark, edge_docs):
    docs = edge_docs.withColumnRenamed("lang", "row").withColumnRenamed("source", "component_id")
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.grouped(docs).collect()), key=str) \
        == brute([(r[0], r[1]) for r in EDGE_DOCS])
    kept = J.kept_rows(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 4, 5, 6, 7, None, 9, 10, 11, 12}


def test_similar_sets_share_a_signature():
    rng = random.Random(5)
    import numpy as np
    for _ in range(3000):
        size = rng.choice((4, 5, 7, 10, 20, 40, 85, 153, 300))
        x = {rng.getrandbits(64) for _ in range(size)}
        a, b = set(x), set(x)
        while True:
            side = rng.choice((a, b))
            before = set(side)
            if rng.random() < 0.5 and len(side) > 1:
                side.discard(rng.choice(sorted(side)))
            else:
                side.add(rng.getrandbits(64))
            if 100 * len(a & b) < 75 * len(a | b):
                side.clear()
                side.update(before)
                break
        if a == b:
            continue
        sa, sb = (set(J.signatures(np.array(sorted(s), dtype=np.uint64)).tolist()) for s in (a, b))
        assert sa & sb, (size, len(a), len(b))


def test_components_of_a_path_a_star_and_a_cycle(spark):
    edges = ([(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)]
             + [(200, 201), (201, 202), (202, 200)])
    got = {r["node"]: r["root"] for r in J.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200, 202: 200}


def test_empty_table(spark, no_docs, as_tables):
    assert op2_jaccard_join(spark, as_tables(documents=no_docs)).collect() == []


def test_sketches_never_rule_out_more_than_the_differences():
    import numpy as np
    rng = np.random.default_rng(2)
    for _ in range(300):
        common = rng.integers(0, 2 ** 63, int(rng.integers(0, 900)), dtype=np.uint64)
        x, y = (np.unique(np.concatenate([common, rng.integers(0, 2 ** 63, int(rng.integers(1, 900)), dtype=np.uint64)]))
                for _ in range(2))
        apart = len(np.setxor1d(x, y))
        assert J.odd_bits(J.wide_sketch(x), J.wide_sketch(y)) <= apart
        assert sum((a ^ b).bit_count() for a, b in zip(
            *(np.array(J.sketch(s)).view(np.uint64).tolist() for s in (x, y)), strict=True)) <= apart
