import random

import numpy as np

from loanlife.llm import jaccard_join as J


def test_a_text_is_scrambled_once_and_its_set_is_sorted_and_distinct(monkeypatch):
    calls, scramble = [], J.scramble
    monkeypatch.setattr(J, "scramble", lambda x: calls.append(len(x)) or scramble(x))
    words = [random.Random(3).choice("abcdefg") for _ in range(4000)]
    got = J.shingle_set(" ".join(words))
    assert calls == [3996]
    assert len(got) == len({tuple(words[i:i + 5]) for i in range(3996)}) and (got[1:] > got[:-1]).all()


def test_order_and_number_of_words_count():
    texts = ["a b c d e", "b a c d e", "a b c e d", "e d c b a", "a a a a b", "b a a a a", "a a a a", "a a a", "a a", "a", "b"]
    hashes = [J.shingle_set(t) for t in texts]
    assert all(len(h) == 1 for h in hashes) and len(np.unique(np.concatenate(hashes))) == len(texts)
    assert len(J.shingle_set(" \t\n")) == 0 and (J.shingle_set("A b\tC\nd  e") == hashes[0]).all()
