"""Personal data: fixed patterns, and a linear-chain conditional random field that adds spans.

The base finds e-mail addresses, IP addresses, card and phone numbers by pattern
and check (``base_spans``).  The field labels words by the shapes of themselves
and their neighbours; it is trained on a small labelled table (``labelled_table``:
written formats drawn by rule, and windows of a bounded sample of the corpus
labelled by the base) and decoded by Viterbi in numpy batches.  It adds
spans in formats that the base misses: numbers with other separators or without
a country code, spelled-out addresses.  Base spans always stay; an added span
must pass its kind's check and overlap no other span.

The field labels windows: words with a digit, an @ or a spelled-out sign, and
``REACH`` words to either side.  Words outside any window are outside any span.

Defined results
* null text counts as empty and has no spans; whole texts are scanned;
* offsets are code points, the end exclusive; order is by start, then kind as in
  ``KINDS``, then end; spans of different kinds in the base may overlap;
* rows stay one to one, repeated rows included; extra columns pass through, an
  output column whose name is taken gets a leading underscore; empty tables give empty results.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlife.llm.common import free_name, low_hash

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O",) + tuple(f"{p}-{k}" for k in KINDS for p in "BI")
LABEL_NO = {label: i for i, label in enumerate(LABELS)}

FEATURES = 1 << 13       # hashed features
REACH = 3                # words of context on either side of a word with a sign
SAMPLE_TEXTS = 300       # texts of the corpus that give training windows
SAMPLE_CHARS = 3000      # from the start of each; bounds training only
SENTENCES = 1600         # drawn sentences of the labelled table
EPOCHS = 100
BATCH_WORDS = 1 << 17    # words decoded at once, padding included

_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_dotted = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_digit = re.compile(r"[0-9]")
_not_digit = re.compile(r"[^0-9]+")
_words = re.compile(r"\S+")
_sign = re.compile(r"[0-9@]|[\[({]at[\])}]|\bdot\b", re.IGNORECASE)

Span = tuple[int, int, int]      # start, kind, end


def small_number(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that pass its check, found in time linear in the text."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _local:
            start -= 1
        if start < at and (m := _domain.match(text, at + 1)):
            out.append((start, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if not _digit.search(text):
        return out
    for m in _dotted.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, start = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(map(small_number, four)):
                out.append((start, 1, end))
            start = end + 1
    for m in _card.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _phone.finditer(text):
            if 9 <= len(_not_digit.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# ---------------------------------------------------------------- features

def shape(word: str) -> str:
    """Letters as A or a, digits as 9, runs of letters shortened; other signs stay."""
    out, last = [], ""
    for c in word[:40]:
        s = "9" if "0" <= c <= "9" else ("A" if c.isupper() else "a") if c.isalpha() else c
        if s != last or s == "9":
            out.append(s)
        last = s
    return "".join(out)


def describe(words: list[str]) -> list[list[int]]:
    """Hashed features of each word in its window."""
    shapes = ["<<", "<"] + [shape(w) for w in words] + [">", ">>"]
    runs = [re.sub("9+", "9", s) for s in shapes]
    digits = [-1, -1] + [sum("0" <= c <= "9" for c in w) for w in words] + [-1, -1]
    out = []
    for i, w in enumerate(words, 2):
        short = w.lower() if len(w) <= 6 and not digits[i] else ""
        names = ("s" + shapes[i], "r" + runs[i], "p" + shapes[i - 1], "n" + shapes[i + 1],
                 "pr" + runs[i - 2] + " " + runs[i - 1], "nr" + runs[i + 1] + " " + runs[i + 2],
                 "pc" + runs[i - 1] + " " + runs[i], "cn" + runs[i] + " " + runs[i + 1],
                 f"d{min(digits[i], 20)}", f"dd{digits[i - 1]} {digits[i]} {digits[i + 1]}", "w" + short,
                 "e" + w[:1] + w[-1:] if not w[:1].isalnum() or not w[-1:].isalnum() else "e")
        out.append([zlib.crc32(n.encode()) % FEATURES for n in names])
    return out


# ------------------------------------------------------------- the field

class Field:
    """Linear-chain conditional random field; weights (features, labels) and moves (labels, labels)."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def decode(self, windows: list[list[str]]) -> list[list[int]]:
        """Best label sequence of each window by Viterbi, all windows of a batch in step."""
        out: list[list[int]] = [[] for _ in windows]
        order = sorted(range(len(windows)), key=lambda i: len(windows[i]))
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and len(windows[order[stop]]) * (stop + 1 - at) <= BATCH_WORDS:
                stop += 1
            batch = [windows[i] for i in order[at:stop]]
            for i, labels in zip(order[at:stop], self._viterbi(batch), strict=True):
                out[i] = labels
            at = stop
        return out

    def _viterbi(self, batch: list[list[str]]) -> list[list[int]]:
        lengths = np.array([len(w) for w in batch])
        steps, n, k = int(lengths.max()), len(batch), len(LABELS)
        scores = np.zeros((steps, n, k), dtype=np.float32)
        for b, words in enumerate(batch):
            scores[:len(words), b] = self.weights[np.array(describe(words))].sum(axis=1)
        back = np.zeros((steps, n, k), dtype=np.int8)
        best = scores[0] + self.moves[0]               # a window begins as after an outside word
        rows = np.arange(n)
        for t in range(1, steps):
            ways = best[:, :, None] + self.moves[None]
            back[t] = ways.argmax(axis=1)
            step = ways.max(axis=1) + scores[t]
            best = np.where((t < lengths)[:, None], step, best)
        labels = np.zeros((steps, n), dtype=np.int8)
        now = best.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            inside = t < lengths
            labels[t] = np.where(inside, now, 0)
            now = np.where(inside & (t > 0), back[t, rows, now], now)
        return [labels[:length, b].tolist() for b, length in enumerate(lengths)]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(sentences: list[tuple[list[str], list[int]]], epochs: int = EPOCHS, penalty: float = 1e-4) -> Field:
    """Maximum likelihood with L2 penalty by full-batch adaptive gradient steps; sentences of equal length in step."""
    k = len(LABELS)
    weights, moves = np.zeros((FEATURES, k)), np.zeros((k, k))
    groups = {}
    for words, labels in sentences:
        groups.setdefault(len(words), []).append((describe(words), labels))
    groups = {n: (np.array([f for f, _ in g]), np.array([y for _, y in g])) for n, g in groups.items() if n}
    seen_w, seen_m = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
    total = sum(len(y) for _, y in groups.values())
    for _ in range(epochs):
        grad_w, grad_m = penalty * weights, penalty * moves
        for n, (features, gold) in groups.items():
            count = len(gold)
            score = weights[features].sum(axis=2)                       # sentence, word, label
            forward = np.zeros((n, count, k))
            backward = np.zeros((n, count, k))
            forward[0] = score[:, 0] + moves[0]
            for t in range(1, n):
                forward[t] = _log_sum(forward[t - 1][:, :, None] + moves[None], 1) + score[:, t]
            for t in range(n - 2, -1, -1):
                backward[t] = _log_sum(moves[None] + (score[:, t + 1] + backward[t + 1])[:, None, :], 2)
            norm = _log_sum(forward[-1], 1)
            share = np.exp(forward + backward - norm[None, :, None])
            share[np.arange(n)[:, None], np.arange(count)[None], gold.T] -= 1
            for slot in range(features.shape[2]):
                np.add.at(grad_w, features[:, :, slot].T, share / total)
            first = np.exp(forward[0] + backward[0] - norm[:, None])
            first[np.arange(count), gold[:, 0]] -= 1
            grad_m[0] += first.sum(axis=0) / total
            for t in range(1, n):
                pair = np.exp(forward[t - 1][:, :, None] + moves[None]
                              + (score[:, t] + backward[t] - norm[:, None])[:, None, :])
                grad_m += pair.sum(axis=0) / total
                np.add.at(grad_m, (gold[:, t - 1], gold[:, t]), -1 / total)
        seen_w += grad_w ** 2
        seen_m += grad_m ** 2
        weights -= 0.3 * grad_w / np.sqrt(seen_w)
        moves -= 0.3 * grad_m / np.sqrt(seen_m)
    for label, i in LABEL_NO.items():                                   # an inside label follows its own kind only
        if label[0] == "I":
            own = {LABEL_NO["B" + label[1:]], i}
            moves[[j for j in range(k) if j not in own], i] = -1e4
    return Field(weights.astype(np.float32), moves.astype(np.float32))


# -------------------------------------------------------- labelled table

def _drawn(rng: random.Random) -> tuple[list[str], list[str]]:
    """A sentence with written personal data or numbers that are none."""
    def n(a, b=None):
        return "".join(rng.choice("0123456789") for _ in range(rng.randint(a, b or a)))

    def name(a=2, b=9):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéüñß") for _ in range(rng.randint(a, b)))

    def word():
        w = name(1, 12)
        w = rng.choice((w, w, w, w.capitalize(), w.upper(), "at", "dot"))
        return w + rng.choice(("", "", "", "", ",", ".", "!!", " |"))

    def byte():
        return str(rng.randint(0, 255))

    def card():
        body = n(15)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def fours(sep):
        c = card()
        return sep.join(c[i:i + 4] for i in range(0, 16, 4))
    host = rng.choice((name(3, 9), f"{name(3)}{n(1)}.{name(4)}", f"{name(3)}-{name(3)}"))
    top = rng.choice(("com", "org", "net", "de", "fr", "example"))
    user = rng.choice((name(), f"{name()}.{n(1, 3)}", f"{name()}.{name()}", f"{name()}_{n(2)}"))
    a, d = rng.choice((("at", "dot"), ("[at]", "[dot]"), ("(at)", "(dot)"), ("AT", "DOT"), ("{at}", "{dot}")))
    kind, text = rng.choice((
        ("email", f"{user}@{host}.{top}"), ("email", f"{user} {a} {host} {d} {top}"), ("email", f"{user}{a}{host}.{top}"
         if a[0] in "[({" else f"{user} [at] {host}.{top}"), ("email", f"{user} @ {host}.{top}"),
        ("ip", ".".join(byte() for _ in range(4))), ("ip", "[.]".join(byte() for _ in range(4))),
        ("ip", "(.)".join(byte() for _ in range(4))),
        ("card", card()), ("card", fours(" ")), ("card", fours("-")), ("card", fours(".")), ("card", fours("/")),
        ("phone", f"+{n(1)} ({n(3)}) {n(3)}-{n(4)}"), ("phone", f"+{n(2)} {n(3)} {n(3)} {n(4)}"),
        ("phone", f"({n(3)}) {n(3)}-{n(4)}"), ("phone", f"{n(3)}-{n(3)}-{n(4)}"), ("phone", f"{n(3)}.{n(3)}.{n(4)}"),
        ("phone", f"0{n(2)} {n(4)} {n(4)}"), ("phone", f"00{n(2)} {n(3)} {n(3)} {n(4)}"),
        *[("", x) for x in (n(1, 11), f"{n(4)}-{n(2)}-{n(2)}", f"{n(2)}.{n(2)}.{n(4)}", f"{n(2)}:{n(2)}", f"{n(1, 3)},{n(3)}.{n(2)}",
                            f"{n(1)}.{n(1)}", f"v{n(1)}.{n(1)}.{n(2)}", f'"{rng.getrandbits(160):040x}"', f"{n(3)}-{n(1)}-{n(5)}-{n(3)}",
                            f"{n(13)}", f"{name()}{n(2)}", f"{n(2)}%", f"@{name()}", f"{n(4)}-{n(4)}", f"{n(17, 24)}",
                            f"{n(16)}", f"{n(5)} {n(5)}", f"{n(2)} {n(3)}")]))
    words, labels = [], []
    for _ in range(rng.randint(1, 4)):
        words += word().split()
    labels += ["O"] * len(words)
    inside = text.split()
    if rng.random() < 0.3:
        inside[-1] += rng.choice((".", ",", "!!", "%%%", ";"))
    words += inside
    labels += [("I-" if i else "B-") + kind if kind else "O" for i in range(len(inside))]
    for _ in range(rng.randint(1, 4)):
        words += word().split()
    return words, labels + ["O"] * (len(words) - len(labels))


def windows_of(text: str) -> Iterator[tuple[list[re.Match], int]]:
    """Runs of words around those with a sign, with the text position they begin at."""
    signs = [m.start() for m in _sign.finditer(text)]
    if not signs:
        return
    words = list(_words.finditer(text))
    starts = np.fromiter((m.start() for m in words), dtype=np.int64, count=len(words))
    marked = np.unique(np.searchsorted(starts, signs, side="right") - 1)
    cuts = np.flatnonzero(np.diff(marked) > 2 * REACH) + 1
    for run in np.split(marked, cuts):
        yield words[max(0, run[0] - REACH):run[-1] + REACH + 1], int(run[0])


def base_labels(window: list[re.Match], spans: list[Span]) -> list[str]:
    labels = ["O"] * len(window)
    for start, kind, end in spans:
        begun = False
        for i, m in enumerate(window):
            if m.start() < end and m.end() > start:
                labels[i] = ("I-" if begun else "B-") + KINDS[kind]
                begun = True
    return labels


def labelled_table(spark: SparkSession, corpus: DataFrame, text_col: str = "text", seed: int = 7) -> DataFrame:
    """(sentence, words, labels): ``SENTENCES`` drawn ones and the windows of ``SAMPLE_TEXTS`` texts at most."""
    rng = random.Random(seed)
    rows = [(f"drawn-{i}", *_drawn(rng)) for i in range(SENTENCES)]
    texts = (corpus.where(F.col(text_col).isNotNull()).select(F.substring(text_col, 1, SAMPLE_CHARS).alias("text"))
             .withColumn("pick", F.xxhash64("text")))
    # Only about three times the sample, copies once, leaves the tasks, at any size of the corpus and whatever its copies.
    different = texts.agg(F.approx_count_distinct("pick")).first()[0]
    share = 3 * SAMPLE_TEXTS / max(different, 1)
    sample = (texts.where(low_hash(F.col("pick"), share)).dropDuplicates(["pick"])
              .orderBy("pick").limit(SAMPLE_TEXTS).collect())
    for i, row in enumerate(sample):
        spans = base_spans(row["text"])
        for j, (window, _) in enumerate(windows_of(row["text"])):
            if len(window) <= 60:
                rows.append((f"corpus-{i}-{j}", [m[0] for m in window], base_labels(window, spans)))
    return spark.createDataFrame(rows, "sentence string, words array<string>, labels array<string>")


def fit(table: DataFrame) -> Field:
    """Train on the labelled table, which is small by construction and read by the driver."""
    rows = table.orderBy("sentence").collect()
    return train([(list(r["words"]), [LABEL_NO[x] for x in r["labels"]]) for r in rows])


# ------------------------------------------------------------ the operator

def accepted(kind: int, text: str) -> bool:
    """The checks that an added span must pass."""
    digits = _not_digit.sub("", text)
    if KINDS[kind] == "phone":
        return 9 <= len(digits) <= 15 and not any(c.isalpha() for c in text)
    if KINDS[kind] == "card":
        return 12 <= len(digits) <= 19 and luhn(digits) and not any(c.isalpha() for c in text)
    if KINDS[kind] == "ip":
        parts = _not_digit.split(text)
        return len(parts) == 4 and all(p and small_number(p) for p in parts)
    low = text.lower()
    return bool(re.search(r"[^\s@]\s*(@|[\[({]at[\])}]|\sat\s)\s*\S+?(\.|\s*[\[({]dot[\])}]\s*|\sdot\s)\w+$", low))


def added_spans(text: str, window: list[re.Match], labels: list[int], taken: list[Span]) -> list[Span]:
    out, i = [], 0
    while i < len(labels):
        if not labels[i]:
            i += 1
            continue
        kind = (labels[i] - 1) // 2
        j = i + 1
        while j < len(labels) and labels[j] == LABEL_NO["I-" + KINDS[kind]]:
            j += 1
        start, end = window[i].start(), window[j - 1].end()
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        if (start < end and accepted(kind, text[start:end])
                and not any(s < end and e > start for s, _, e in taken)):
            out.append((start, kind, end))
        i = j
    return out


def find(df: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``df`` with ``base`` and ``spans``: arrays of (start, end, kind) in code points, in order."""
    shared = df.sparkSession.sparkContext.broadcast((field.weights, field.moves))     # fixed size
    at = df.columns.index(text_col)
    names = [free_name(df.columns, n) for n in ("base", "spans")]
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                     T.StructField("kind", T.StringType())]))
    schema = T.StructType(df.schema.fields + [T.StructField(n, span) for n in names])
    arrow_span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def listed(spans: list[Span]) -> list[dict]:
        return [{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in sorted(spans)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            base = [base_spans(t) for t in texts]
            found = [(i, w) for i, t in enumerate(texts) for w, _ in windows_of(t)]
            every = [list(b) for b in base]
            for (i, window), labels in zip(found, own.decode([[m[0] for m in w] for _, w in found]), strict=True):
                if any(labels):
                    first, last = window[0].start(), window[-1].end()
                    near = [s for s in base[i] if s[0] < last and s[2] > first]
                    every[i] += added_spans(texts[i], window, labels, near)
            new = [pa.array([listed(s) for s in x], arrow_span) for x in (base, every)]
            yield pa.RecordBatch.from_arrays(batch.columns + new, names=batch.schema.names + names)

    return df.mapInArrow(run, schema)
