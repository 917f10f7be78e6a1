import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from loanlife.llm import chat_collapse as C
from loanlife.llm.queries import op9_chat_collapse

DDL = "conv_id bigint, turn bigint, role string, text string"


def brute(spark, rows):
    texts = spark.createDataFrame(sorted({(r or "", x or "") for _, _, r, x in rows}), "role string, text string")
    tie = {(r["role"], r["text"]): r["h"] for r in texts.withColumn("h", F.xxhash64(F.lit(1), "role", "text")).collect()}
    turns = defaultdict(set)
    for conv, turn, role, text in rows:
        turns[conv].add((turn is not None, turn or 0, role or "", tie[role or "", text or ""], text or ""))
    said = {c: tuple((r, x) for _, _, r, _, x in sorted(t)) for c, t in turns.items()}
    prefixes = {t[:i] for t in said.values() for i in range(1, len(t))}
    copies = Counter(said.values())
    out = []
    for whole, n in copies.items():
        if whole in prefixes:
            continue
        ids = [c for c, t in said.items() if t == whole]
        out.append((min((c for c in ids if c is not None), default=None), len(whole), n,
                    "".join(f"<|{r}|>\n{x}<|end|>\n" for r, x in whole)))
    return sorted(out, key=str)


def collapsed(df):
    parts = defaultdict(list)
    for r in C.collapse(df).collect():
        assert r["n_turns"] <= C.SEGMENT
        parts[(r["conv_id"], r["depth"], r["copies"])].append((r["part"], r["piece"], r["rendered"], r["n_turns"]))
    out = []
    for (conv, depth, copies), pieces in parts.items():
        assert sum(n for *_, n in pieces) == depth
        out.append((conv, depth, copies, "".join(x for _, _, x, _ in sorted(pieces))))
    return sorted(out, key=str)


def test_random_snapshots_equal_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for base in range(30):
        turns = [(t, rng.choice(("user", "assistant", None)), rng.choice(("hi", "yes", "no", "", None))) for t in range(rng.randint(1, 7))]
        for k in range(rng.randint(1, 4)):
            cut = rng.randint(1, len(turns))
            rows += [(base * 10 + k, t, r, x) for t, r, x in turns[:cut]]
    rows += rows[:9] + [(None, 0, "user", "alone"), (999, None, "user", "no turn"), (999, 0, "user", "then"), (998, 0, "a", "tie"),
                        (998, 0, "b", "tie"), (996, 0, "a", "x"), (995, 0, "a", "x"), (995, 0, "a", "y"),
                        (994, 0, "a", "y"), (997, 0, "user", "long " * 30000)]
    assert collapsed(spark.createDataFrame(rows, DDL)) == brute(spark, rows)


def test_long_conversations_cross_segments(spark):
    long = [(1, t, "user", f"turn {t}") for t in range(3 * C.SEGMENT + 5)]
    rows = long + [(2, *r[1:]) for r in long[:2 * C.SEGMENT]] + [(3, *r[1:]) for r in long] + [(4, *r[1:]) for r in long[:-1]] + [
        (4, 3 * C.SEGMENT + 4, "user", "another end")]
    rows += [(5, 0, "user", f"{i:05d}") for i in range(2 * C.SEGMENT + 9)]     # one turn number throughout
    assert collapsed(spark.createDataFrame(rows, DDL)) == brute(spark, rows)


def test_equal_conversations_numbered_differently(spark):
    said = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d"), ("user", "e")]
    rows = [(conv, first + step * i, r, x) for conv, first, step, n in
            ((1, 0, 1, 5), (2, 300, 1, 5), (3, 254, 1, 5), (4, 250, 100, 4), (5, -2, 1, 3)) for i, (r, x) in enumerate(said[:n])]
    df = spark.createDataFrame(rows, DDL)
    assert collapsed(df) == brute(spark, rows) and [r["copies"] for r in C.maximal(df).collect()] == [3]


def test_pieces_do_not_depend_on_the_numbering(spark):
    long = C.SEGMENT + 40
    rows = [(1, 254 + t, "user", f"a {t}") for t in range(5)] + [(2, 1000 * t - 7, "user", f"b {t}") for t in range(long)]
    rows += [(3, None, "user", f"c {t}") for t in range(long)]
    df = spark.createDataFrame(rows, DDL)
    assert collapsed(df) == brute(spark, rows)
    assert sorted((r["conv_id"], r["piece"], r["n_turns"]) for r in C.collapse(df).collect()) == [
        (1, 0, 5), (2, 0, C.SEGMENT), (2, 1, 40), (3, 0, C.SEGMENT), (3, 1, 40)]


def test_empty_table_and_extra_columns(spark, as_tables):
    empty = spark.createDataFrame([], DDL + ", part string")
    assert op9_chat_collapse(spark, as_tables(conversations=empty)).collect() == []
    one = spark.createDataFrame([(1, 0, "user", "x", "p", 3)], DDL + ", part string, Depth int")
    assert [r["rendered"] for r in C.collapse(one).collect()] == ["<|user|>\nx<|end|>\n"]
