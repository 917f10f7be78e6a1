import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loanlife.llm import pii_crf as P
from loanlife.llm.queries import op3_pii

from .conftest import EDGE_DOCS

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def naive(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and P.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789..@@a-+ ( )%é", max_size=60))
def test_base_equals_the_patterns(text):
    assert P.base_spans(text) == naive(text)


def test_base_is_linear_in_hostile_texts():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 200_000, "+1" + " " * 200_000, "a@" * 100_000):
        P.base_spans(text)


@pytest.fixture(scope="module")
def field(spark, edge_docs):
    return P.fit(P.labelled_table(spark, edge_docs))


def test_field_labels_unseen_sentences(field):
    rng = random.Random(99)
    drawn = [P._drawn(rng) for _ in range(600)]
    told = field.decode([words for words, _ in drawn])
    right = sum([P.LABELS[i] for i in got] == labels for got, (_, labels) in zip(told, drawn, strict=True))
    assert right >= 0.88 * len(drawn)


def test_viterbi_equals_enumeration(field):
    import itertools

    import numpy as np
    words = ["call", "(020)", "555-0199"]
    scores = field.weights[np.array(P.describe(words))].sum(axis=1)
    best = max(itertools.product(range(len(P.LABELS)), repeat=3), key=lambda y: sum(
        scores[i][y[i]] + field.moves[y[i - 1] if i else 0][y[i]] for i in range(3)))
    assert field.decode([words])[0] == list(best)


def test_added_spans_keep_the_base_and_pass_checks(spark, field):
    texts = ["write to jane at mailhost dot com soon", "mail a.b@c.example or 10[.]0[.]0[.]7 now", "+1 (555) 010-4477 10.2.3.4",
             "plain words only", "order 4321 of 2024-01-31 cost 1,299.00", None, ""]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "id int, text string, base string, Spans string")
    out = P.find(df, field)
    assert out.columns == ["id", "text", "base", "Spans", "_base", "_spans"]
    rows = {r["id"]: r for r in out.collect()}
    for i, text in enumerate(texts):
        base = [(s["start"], P.KINDS.index(s["kind"]), s["end"]) for s in rows[i]["_base"]]
        every = [(s["start"], P.KINDS.index(s["kind"]), s["end"]) for s in rows[i]["_spans"]]
        assert base == naive(text or "") and set(base) <= set(every) and every == sorted(every)
        assert all(P.accepted(k, text[s:e]) for s, k, e in set(every) - set(base))
    assert rows[3]["_spans"] == rows[4]["_spans"] == rows[5]["_spans"] == rows[6]["_spans"] == []


def test_query_on_edge_cases_and_empty_table(spark, edge_docs, no_docs, as_tables):
    got = {(r["doc_id"], r["base_sha256"]) for r in op3_pii(spark, as_tables(documents=edge_docs)).collect()}
    want = {(d, hashlib.sha256(P.spans_text(naive(t or "")).encode()).hexdigest()) for d, t, *_ in EDGE_DOCS}
    assert got == want
    assert op3_pii(spark, as_tables(documents=no_docs)).collect() == []
