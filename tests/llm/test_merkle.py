import hashlib

import pytest

from loanlife.llm import merkle as M
from loanlife.llm.queries import op6_merkle

from .conftest import EDGE_DOCS


def brute(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        k = len(text) // 4
        new = text[:len(text) - k] + following[:k]
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), M.Tree(text).text(), M.Tree(new).text(),
                    M.likeness(M.Tree(text), M.Tree(new)), M.likeness(M.Tree(text), M.Tree(following))))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, as_tables, small_docs):
    rows = small_docs + [(d + 1000 if d else d, t) for d, t, *_ in EDGE_DOCS]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, op6_merkle(spark, as_tables(documents=docs)).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("parts", [1, 2, 7, 50])
def test_any_number_of_parts(spark, edge_docs, parts):
    got = sorted(map(tuple, M.follow(edge_docs, parts=parts).collect()), key=str)
    assert got == brute([(d, t) for d, t, *_ in EDGE_DOCS])


def test_equal_roots_mean_equal_texts_and_edits_are_located():
    lines = [f"paragraph number {i} " + "with some words " * (i % 5) for i in range(60)]
    a, b = M.Tree("\n".join(lines)), M.Tree("\n".join(lines[:20] + ["changed"] + lines[21:]))
    assert M.Tree("\n".join(lines)).root == a.root != b.root
    flat = [(i, j) for i, s in enumerate(a.sections) for j in range(len(s))]
    assert [flat.index(d) for d in M.differences(a, b)] == [20] and M.differences(a, a) == []
    assert 0.9 < M.likeness(a, b) < 1 and M.likeness(a, a) == 1.0 and M.likeness(M.Tree(""), M.Tree("")) == 1.0
    assert M.likeness(M.Tree(""), a) == 0.0
    distinct = {"", "\n", "\n\n", "a", "a\n", "\na", "a b", "x" * 33, "x" * 32 + "\n" + "x"}
    assert len({M.Tree(t).text() for t in distinct}) == len(distinct)


def test_an_edit_in_a_long_line_changes_the_blocks_it_touches():
    line = " ".join(f"{w}{i * i % 97}" for i in range(600) for w in ("Wörter", "of", "one \U0001f600 line"))
    for at in (0, 1, 50, 3000, len(line)):
        assert M.likeness(M.Tree(line), M.Tree(line[:at] + "!" + line[at:])) > 0.97
        assert M.likeness(M.Tree("first\n" + line), M.Tree("other\n" + line[:at] + line[at + 1:])) > 0.97
    for text in (line, "x" * 5000, "ab" * 2500, "x" * 33):
        blocks = M.cut(text, 0, M.borders(text))
        assert "".join(blocks) == text and all(M.SHORTEST <= len(b) <= M.LONGEST for b in blocks[:-1])
        assert M.cut(text, 7, M.borders("before\n" + text)) == blocks


def test_clashing_column_lone_document_and_empty_table(spark, no_docs, as_tables):
    df = spark.createDataFrame([(1, "one two", "f")], "doc_id bigint, text string, Fingerprint string")
    assert M.fingerprints(df).columns[-1] == "_fingerprint"
    row = M.follow(df).first()
    assert row["near_next"] == 1.0 and row["fingerprint"] == M.Tree("one two").text()
    assert op6_merkle(spark, as_tables(documents=no_docs)).collect() == []
