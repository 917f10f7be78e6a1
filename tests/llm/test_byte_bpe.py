import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from loanlife.llm import byte_bpe as B
from loanlife.llm.queries import RANKS, op4_byte_bpe

from .conftest import EDGE_DOCS

with open(RANKS, "rb") as f:
    CODEC = B.Codec(B.parse_ranks(f.read()))
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


def check(texts):
    ids, offsets, bounds = CODEC.encode(texts)
    out, out_bounds = CODEC.decode(ids, offsets, bounds)
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == REFERENCE.encode_ordinary(text)
        assert out[out_bounds[i]:out_bounds[i + 1]].tobytes() == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="'strevmld AaéÉ19²!…\n\t 　\x1c日😀́", max_size=40), max_size=5))
def test_texts_of_hard_characters(texts):
    check(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_any_texts(texts):
    check([t.encode("utf-8", "ignore").decode() for t in texts])


def test_long_and_empty_texts():
    check(["", "a" * 30000, "ab" * 9000 + " x", " " * 5000, "", "'" * 999 + "s"])


def test_scan_equals_stepping():
    import numpy as np
    kinds = np.random.default_rng(1).integers(0, 9, 5000).astype(np.uint8)
    state, want = B.CLOSED, []
    for kind in kinds.tolist():
        want.append(state)
        state = B.step(state, kind)[0]
    assert B.states_before(kinds).tolist() == want


def test_query_equals_the_library(spark, edge_docs, as_tables, small_docs):
    rows = [(d, t or "") for d, t, *_ in EDGE_DOCS]
    docs = edge_docs.select("doc_id", "text").unionByName(spark.createDataFrame(small_docs, "doc_id bigint, text string"))
    got = sorted(map(tuple, op4_byte_bpe(spark, as_tables(documents=docs)).collect()), key=str)
    want = []
    for doc_id, text in rows + small_docs:
        ids = REFERENCE.encode_ordinary(text)
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_clashing_columns_and_empty_table(spark, no_docs):
    df = spark.createDataFrame([("a b", 1, "o")], "text string, IDS int, offsets string")
    out = B.encode(df, RANKS)
    assert out.columns == ["text", "IDS", "offsets", "_ids", "_offsets"]
    row = B.decode(out, RANKS, "_ids", "_offsets").first()
    assert bytes(row["decoded"]) == b"a b" and row["_offsets"] == [0, 1]
    assert B.decode(B.encode(no_docs, RANKS), RANKS).collect() == []


@pytest.mark.parametrize("sizes,limit,want", [([1, 1, 1], 2, [(0, 2), (2, 3)]), ([9, 1], 2, [(0, 1), (1, 2)]), ([], 5, [])])
def test_chunks(sizes, limit, want):
    import numpy as np
    assert list(B.chunks(np.array(sizes), limit)) == want


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(min_size=1, max_size=40), st.text(alphabet="theonandiréß", min_size=1, max_size=30).map(str.encode)))
def test_both_ways_of_merging_agree(piece):
    if piece not in CODEC.ranks:
        assert CODEC.joins.merge(piece) == B.merge(piece, CODEC.ranks)


def test_a_codec_that_only_decodes_holds_no_joins():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257}
    codec = B.Codec(ranks)
    out, bounds = codec.decode(np.array([256, 99]), np.array([0, 2]), np.array([0, 2]))
    assert out.tobytes() == b"abc" and bounds.tolist() == [0, 3] and "joins" not in vars(codec)
    assert codec.encode(["abx"])[0].tolist() == [256, 120] and "joins" in vars(codec)
