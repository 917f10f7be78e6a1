"""Byte-level BPE encoding and decoding without a regular expression.

Pre-tokenisation is a finite automaton over code-point classes.  Every class is
a transition function on the automaton's states; function composition is
associative and the functions reachable by composition are few, so that they
are numbered once and a prefix scan over those numbers gives the state before
every character: a scan within equally long segments (all segments in step),
then a doubling scan over the segments.  A boundary is a fact of (state before,
class).  The slices between boundaries go through pair merging, whose results
are cached per Python worker; each id keeps its byte offset, which decoding uses
to lay the pieces out.

Defined results
* null and empty text give no ids; decoding them gives empty bytes;
* whole texts are encoded, of any length; merging costs n log n in a piece's length;
* rows stay one to one, repeated rows included; extra columns pass through, and
  where one has the name of an output column, the output's name gets a leading underscore;
* an empty table gives an empty table of the same schema.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loanlife.llm.common import free_name

# Classes of code points in context.  LAST_SPACE and LAST_BLANK end a run of
# white space that more text follows; a space there joins the next piece.
# SHORT and LONG are apostrophes before one or two letters of a contraction.
LETTER, NUMBER, OTHER, SHORT, LONG, BLANK, LAST_BLANK, LAST_SPACE, BETWEEN_TEXTS = range(9)

# States: what the characters so far leave open.
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_BLANKS, AFTER_SPACE, ONE_LETTER_LEFT, TWO_LETTERS_LEFT = range(8)

# White space and contraction endings of the split pattern.
WHITE_SPACE = ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
               (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
ONE_LETTER_ENDINGS = ("s", "t", "m", "d")
TWO_LETTER_ENDINGS = ("re", "ve", "ll")

CHUNK_CHARS = 1 << 18     # characters scanned at once: some 50 bytes of scratch for each
CACHE_ENTRIES = 100_000   # pieces of a generation; a worker remembers two, the older one goes
CACHE_PIECE = 64          # longer pieces are not remembered


def step(state: int, kind: int) -> tuple[int, bool]:
    """The automaton: next state, and whether a piece begins at this character."""
    if kind == BETWEEN_TEXTS:
        return CLOSED, True
    if kind == LETTER:
        if state == TWO_LETTERS_LEFT:
            return ONE_LETTER_LEFT, False
        if state == ONE_LETTER_LEFT:
            return CLOSED, False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_SPACE)
    if kind == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_SPACE)
    if kind in (OTHER, SHORT, LONG):
        if state in (IN_OTHER, AFTER_SPACE):
            return IN_OTHER, False
        return {OTHER: IN_OTHER, SHORT: ONE_LETTER_LEFT, LONG: TWO_LETTERS_LEFT}[kind], True
    if kind == BLANK:
        return IN_BLANKS, state != IN_BLANKS
    return (AFTER_SPACE if kind == LAST_SPACE else CLOSED), True


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(class -> function number, composition table, function x state -> state, state x class -> begins)."""
    kinds, states = range(9), range(8)
    identity = tuple(states)
    functions = {identity: 0}
    letters = [tuple(step(s, k)[0] for s in states) for k in kinds]
    todo = [identity]
    while todo:
        f = todo.pop()
        for g in letters:
            h = tuple(g[s] for s in f)
            if h not in functions:
                functions[h] = len(functions)
                todo.append(h)
    table = np.array(list(functions), dtype=np.uint8)
    compose = np.array([[functions[tuple(g[s] for s in f)] for g in functions] for f in functions], dtype=np.uint8)
    of_kind = np.array([functions[f] for f in letters], dtype=np.uint8)
    begins = np.array([[step(s, k)[1] for k in kinds] for s in states])
    return of_kind, compose, table, begins


@lru_cache(maxsize=1)
def code_point_kinds() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major == "L":
            kinds[c] = LETTER
        elif major == "N":
            kinds[c] = NUMBER
    for first, last in WHITE_SPACE:
        kinds[first:last + 1] = BLANK
    return kinds


def classify(points: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Class of every code point in its context; ``between`` are the separators' places."""
    kinds = code_point_kinds()[points]
    kinds[between] = BETWEEN_TEXTS
    following = np.append(kinds[1:], BETWEEN_TEXTS)
    last = (kinds == BLANK) & (following != BLANK) & (following != BETWEEN_TEXTS)
    quotes = np.flatnonzero(points == ord("'"))
    kinds[last] = np.where(points[last] == ord(" "), LAST_SPACE, LAST_BLANK)
    if len(quotes):
        padded = np.append(points, [0, 0]).astype(np.uint32)
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, [ord(c) for c in ONE_LETTER_ENDINGS])
        long = np.zeros(len(quotes), dtype=bool)
        for a, b in TWO_LETTER_ENDINGS:
            long |= (one == ord(a)) & (two == ord(b))
        kinds[quotes[short]] = SHORT
        kinds[quotes[long]] = LONG
    return kinds


def states_before(kinds: np.ndarray) -> np.ndarray:
    """The automaton's state before every character, by associative scans."""
    of_kind, compose, table, _ = automaton()
    n, count = len(kinds), len(table)
    flat = compose.ravel()
    width = max(1, int(np.sqrt(n) / 4))
    rows = -(-n // width)
    steps = np.zeros(rows * width, dtype=np.uint8)
    steps[:n] = of_kind[kinds]
    scan = np.ascontiguousarray(steps.reshape(rows, width).T).astype(np.intp)
    for i in range(1, width):
        scan[i] = flat[scan[i - 1] * count + scan[i]]
    whole, reach = scan[-1].copy(), 1
    while reach < rows:
        whole[reach:] = flat[whole[:-reach] * count + whole[reach:]]
        reach *= 2
    entry = np.zeros(rows, dtype=np.uint8)
    entry[1:] = table[whole[:-1], CLOSED]
    after = table.ravel()[scan * 8 + entry]
    before = np.empty_like(after)
    before[0], before[1:] = entry, after[:-1]
    return before.T.ravel()[:n]


def split(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The pieces of all texts in order, and how many each text has."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    joined = "\n".join(texts)
    if not joined:
        return [], np.zeros(len(texts), dtype=np.int64)
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum(lengths + 1) - 1
    between = ends[:-1]
    kinds = classify(points, between)
    begins = automaton()[3][states_before(kinds), kinds]
    starts = np.flatnonzero(begins)
    text_of = np.searchsorted(ends, starts, side="left")
    real = kinds[starts] != BETWEEN_TEXTS
    stops = np.append(starts[1:], len(points))
    counts = np.bincount(text_of[real], minlength=len(texts))
    return [joined[a:b] for a, b in zip(starts[real].tolist(), stops[real].tolist(), strict=True)], counts


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one piece: neighbours of the lowest rank merge first, the leftmost of equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return (whole,)
    n = len(piece)
    stop, left = list(range(1, n + 1)), list(range(-1, n - 1))   # part i is piece[i:stop[i]]
    alive = [True] * n
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i]:
            continue
        j = stop[i]
        if j >= n or stop[j] != end:
            continue                                  # one side has merged meanwhile
        alive[j], stop[i] = False, end
        if end < n:
            left[end] = i
            rank = ranks.get(piece[i:stop[end]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, stop[end]))
        if left[i] >= 0:
            rank = ranks.get(piece[left[i]:end])
            if rank is not None:
                heapq.heappush(heap, (rank, left[i], end))
    return tuple(ranks[piece[i:stop[i]]] for i in range(n) if alive[i])


class Joins:
    """What neighbouring ids merge into; merges short pieces by scanning for the lowest rank."""

    NONE, SHIFT = 1 << 60, 20

    def __init__(self, ranks: dict[bytes, int]):
        self.single = [ranks.get(bytes([b]), self.NONE) for b in range(256)]
        self.result = {}
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
                if a is not None and b is not None:
                    self.result[a << self.SHIFT | b] = rank

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """As ``merge``; the work grows with the square of the piece's length."""
        find, none, shift = self.result.get, self.NONE, self.SHIFT
        ids = [self.single[b] for b in piece]
        ranks = [find(a << shift | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            i = ranks.index(low)
            ids[i] = low
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = find(ids[i - 1] << shift | low, none)
            if i < len(ranks):
                ranks[i] = find(low << shift | ids[i + 1], none)
        return tuple(ids)


class Codec:
    """Ranks with a bounded cache of merged pieces; one per Python worker and vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.cache, self.older = ranks, {}, {}
        size = max(ranks.values()) + 1
        pieces = [b""] * size
        for piece, rank in ranks.items():
            pieces[rank] = piece
        self.lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=size)
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    @cached_property
    def joins(self) -> Joins:
        """Made by the first piece that is merged: workers that only decode never hold it."""
        return Joins(self.ranks)

    def ids_of(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            content = piece.encode("utf-8")
            whole = self.ranks.get(content)
            if whole is not None:
                ids = (whole,)
            else:
                ids = self.joins.merge(content) if len(content) <= CACHE_PIECE else merge(content, self.ranks)
        if len(piece) <= CACHE_PIECE:
            if len(self.cache) >= CACHE_ENTRIES:
                self.older = dict(self.cache)
                self.cache.clear()           # the same object: a running encode looks pieces up in it
            self.cache[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, byte offset of each id in its text, bounds of the texts in both)."""
        pieces, counts = split(texts)
        known, merged = self.cache.get, self.ids_of
        ids_by_piece = [known(p) or merged(p) for p in pieces]
        per_piece = np.fromiter(map(len, ids_by_piece), dtype=np.int64, count=len(ids_by_piece))
        ids = np.fromiter(chain.from_iterable(ids_by_piece), dtype=np.int32, count=int(per_piece.sum()))
        piece_bounds = np.concatenate([[0], np.cumsum(per_piece)])
        bounds = piece_bounds[np.concatenate([[0], np.cumsum(counts)])]
        sizes = self.lengths[ids]
        places = np.cumsum(sizes) - sizes
        first = places[np.minimum(bounds[:-1], max(len(ids) - 1, 0))] if len(ids) else np.zeros(len(texts), np.int64)
        return ids, (places - np.repeat(first, np.diff(bounds))).astype(np.int32), bounds

    def decode(self, ids: np.ndarray, offsets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, bounds of the texts in them); pieces are laid out by their offsets."""
        sizes = self.lengths[ids]
        per_text = np.zeros(len(bounds) - 1, dtype=np.int64)
        full = np.flatnonzero(np.diff(bounds))
        last = bounds[1:][full] - 1
        per_text[full] = offsets[last] + sizes[last]
        out_bounds = np.concatenate([[0], np.cumsum(per_text)])
        out = np.zeros(out_bounds[-1], dtype=np.uint8)
        if len(ids):
            place = offsets + np.repeat(out_bounds[:-1], np.diff(bounds))
            within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            out[np.repeat(place, sizes) + within] = self.bytes[np.repeat(self.begin[ids], sizes) + within]
        return out, out_bounds


_codecs: dict[int, Codec] = {}


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, content.splitlines()) if piece}


def _shared_codec(df: DataFrame, ranks_path: str):
    """The vocabulary (bounded by its file) goes to every executor once."""
    with open(ranks_path, "rb") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())

    def codec() -> Codec:
        key = hash(content.value)
        if key not in _codecs:
            _codecs.clear()
            _codecs[key] = Codec(parse_ranks(content.value))
        return _codecs[key]
    return codec


def chunks(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes sum up to about ``limit``; a larger row is a run of its own."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def encode(df: DataFrame, ranks_path: str, text_col: str = "text") -> DataFrame:
    """``df`` with ``ids`` array<int> and ``offsets`` array<int> (byte offset of each id in its text)."""
    codec = _shared_codec(df, ranks_path)
    at = df.columns.index(text_col)
    names = [free_name(df.columns, "ids"), free_name(df.columns, "offsets")]
    schema = T.StructType(df.schema.fields + [T.StructField(n, T.ArrayType(T.IntegerType())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.utf8_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            for a, b in chunks(sizes, CHUNK_CHARS):
                part = batch.slice(a, b - a)
                ids, offsets, bounds = own.encode([t or "" for t in part.column(at).to_pylist()])
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, pa.int32()))
                         for x in (ids, offsets)]
                yield pa.RecordBatch.from_arrays(part.columns + lists, names=part.schema.names + names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", offsets_col: str = "offsets") -> DataFrame:
    """``df`` with ``decoded`` binary: the bytes of the ids, laid out by their offsets."""
    codec = _shared_codec(df, ranks_path)
    at, offset_at = df.columns.index(ids_col), df.columns.index(offsets_col)
    name = free_name(df.columns, "decoded")
    schema = T.StructType(df.schema.fields + [T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.list_value_length(batch.column(at)), 0)
            for a, b in chunks(sizes.to_numpy(zero_copy_only=False), CHUNK_CHARS // 2):
                part = batch.slice(a, b - a)
                ids, offsets = (part.column(i).flatten().to_numpy(zero_copy_only=False) for i in (at, offset_at))
                counts = pa.compute.fill_null(pa.compute.list_value_length(part.column(at)), 0)
                bounds = np.concatenate([[0], np.cumsum(counts.to_numpy(zero_copy_only=False))]).astype(np.int64)
                out, out_bounds = own.decode(ids, offsets, bounds)
                binary = pa.Array.from_buffers(pa.binary(), len(part), [
                    None, pa.py_buffer(out_bounds.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())])
                yield pa.RecordBatch.from_arrays(part.columns + [binary], names=part.schema.names + [name])

    return df.mapInArrow(run, schema)
