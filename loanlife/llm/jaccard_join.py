"""N-gram Jaccard join by PartEnum signatures, and the groups that its links form.

A text's set holds the hashes of its distinct 5-word shingles.  Sets whose Jaccard
similarity is at least J differ in few elements: at most (1 - J) / (1 + J) of
the sum of both sizes.  Sizes are cut into bands; an instance of the scheme
joins a band with the sizes above it that can still be similar.  In an instance
the hashed feature domain is split into as many partitions as make sure that a
set has more non-empty ones than it can have differences to any partner.  Each
difference spoils one partition at most, so two similar sets agree wholly in one
that is not empty.  A signature is the set's content in one partition.

Only as many signatures as possible differences plus one are needed, if all sets
take them in one fixed order: the fullest partitions come first, as these are
the most selective.  A set that has too few non-empty partitions adds the
empty ones; two such sets then agree in a whole, perhaps empty, partition.

Steps, none of which lists all pairs of a group:
1. equal sets become one node; nodes that share a signature form candidate groups;
2. in each group every member is compared with one hub, the member of most groups;
   the links found give first components;
3. groups that still span several components are joined with themselves, on
   condition that the components differ, the sizes allow a link, and the parity
   sketches (a lower bound of the differences, by exclusive-or) do not rule it out;
4. pairs left over are sieved by parity sketches as wide as their sets need, and
   links are always verified on the whole sets; components are those of all links.

Every pair of similar sets shares a group, and is either in one component after
step 2 or compared in step 3, so the components are exact.  Sets are identified by
two 64-bit hashes; should two different sets ever share the first, the job
fails and says so.

Defined results
* words are runs without the six ASCII blanks, A-Z lower-cased; a text of fewer
  than five words is one shingle; a text without words, or null, is empty, is in no
  group, and has its own id as component;
* ``component_id`` is the smallest id reachable by links, null only if none of them has an id;
* rows stay one to one, repeated rows included; an empty table gives an empty result;
  of the input only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from math import exp

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlife.session import scratch_path

SHINGLE = 5
THRESHOLD = 75           # hundredths: linked when 100 * intersection >= THRESHOLD * union
SKETCH_WORDS = 16        # 64-bit words of a parity sketch
OUT_ROWS = 1 << 18       # signatures handed on at once
BAND_STEPS = 2           # a band spans sizes by the factor (100 / THRESHOLD) ** BAND_STEPS

MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def scramble(x: np.ndarray) -> np.ndarray:
    """Mixes 64-bit numbers (multiply and shift, wrapping around)."""
    x = x + MULTIPLIERS[0]
    x ^= x >> np.uint64(30)
    x *= MULTIPLIERS[1]
    x ^= x >> np.uint64(27)
    x *= MULTIPLIERS[2]
    x ^= x >> np.uint64(31)
    return x


PLACES = scramble(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)     # a factor for each place in a shingle


def shingle_set(text: str) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle, a text without words none."""
    words = text.encode("utf-8").lower().split()      # bytes: A-Z only, and the six ASCII blanks only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(words))
    out = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out += h[i:len(words) - size + 1 + i] * PLACES[i]
    out = scramble(out)
    out.sort()
    new = np.ones(len(out), dtype=bool)
    np.not_equal(out[1:], out[:-1], out=new[1:])
    return out[new]


@lru_cache(maxsize=4096)
def band(size: int) -> int:
    edge, i = 1, 0
    while next_edge(edge) <= size:
        edge, i = next_edge(edge), i + 1
    return i


@lru_cache(maxsize=4096)
def next_edge(edge: int) -> int:
    for _ in range(BAND_STEPS):
        edge = edge * 100 // THRESHOLD + 1
    return edge


@lru_cache(maxsize=256)
def edges(i: int) -> tuple[int, int]:
    """Sizes of band ``i``: from, below."""
    edge = 1
    for _ in range(i):
        edge = next_edge(edge)
    return edge, next_edge(edge)


def largest(size: int) -> int:
    """Size of the largest set that can be similar."""
    return size * 100 // THRESHOLD


def differences(a: int, b: int) -> int:
    """Most elements that similar sets of these sizes can have on one side only."""
    return (a + b) * (100 - THRESHOLD) // (100 + THRESHOLD)


@lru_cache(maxsize=65536)
def instances(size: int) -> tuple[tuple[int, int], ...]:
    """(instance, differences to allow for) of a set: its own band, and lower ones that reach up to its size."""
    own = band(size)
    out = [(own, differences(size, largest(size)))]
    i = own - 1
    while i >= 0 and largest(edges(i)[1] - 1) >= size:
        out.append((i, differences(size, edges(i)[1] - 1)))
        i -= 1
    return tuple(out)


@lru_cache(maxsize=256)
def partitions(i: int) -> int:
    """Number of partitions of instance ``i``: enough for every size in it, with a margin of about three deviations."""
    low, high = edges(i)
    needs = [(s, differences(s, largest(s))) for s in {low, (low + high) // 2, high - 1}]
    needs += [(largest(high - 1), differences(largest(high - 1), high - 1)), (high, differences(high, high - 1))]
    n = 1
    while True:
        if all(filled - 3 * (filled * exp(-s / n)) ** 0.5 > need or n > 8 * s
               for s, need in needs for filled in (n * (1 - exp(-s / n)),)):
            return n
        n = n + 1 + n // 64


def signatures(elements: np.ndarray) -> np.ndarray:
    """Signatures of one set (sorted hashes) in all its instances."""
    size = len(elements)
    out = []
    mixed = scramble(elements)
    for i, allowed in instances(size):
        if not allowed:                                # similar sets are equal; those share their identity
            continue
        n = partitions(i)
        part = ((elements >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)     # ascending, as the elements are
        starts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
        counts = np.diff(np.append(starts, size))
        label = part[starts]
        content = np.add.reduceat(mixed, starts)
        if len(starts) > allowed:
            first = np.argsort(-counts, kind="stable")[:allowed + 1]      # labels ascend already
            label, content = label[first], content[first]
        else:
            empty = np.setdiff1d(np.arange(n, dtype=np.uint64), label)
            label = np.concatenate([label, empty])
            content = np.concatenate([content, np.zeros(len(empty), dtype=np.uint64)])
        out.append(scramble(scramble(content) ^ (label << np.uint64(8)) ^ np.uint64(i)))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def identity(elements: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set, as signed numbers."""
    mixed = scramble(elements)
    both = np.array([mixed.sum(), scramble(mixed ^ MULTIPLIERS[2]).sum()], dtype=np.uint64)
    return tuple(scramble(both ^ np.uint64(len(elements))).view(np.int64).tolist())


def sketch(elements: np.ndarray) -> list[int]:
    """For each of the sketch's bits, whether the set has an odd number of elements there."""
    odd = np.bincount((elements % np.uint64(64 * SKETCH_WORDS)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


# ------------------------------------------------------------- Spark jobs

def _checkpoint(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sets(docs: DataFrame) -> DataFrame:
    """(id, row, n, node, check, s0..) of every document; ``row`` tells texts of one id apart."""
    words = [f"s{i}" for i in range(SKETCH_WORDS)]
    types = [("n", pa.int64()), ("node", pa.int64()), ("check", pa.int64())] + [(w, pa.int64()) for w in words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(2).to_pylist():
                elements = shingle_set(text or "")
                rows.append((len(elements), *identity(elements), *sketch(elements)) if len(elements)
                            else (0, None, None) + (None,) * SKETCH_WORDS)
            new = [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)] if rows else \
                [pa.array([], t) for _, t in types]
            yield pa.RecordBatch.from_arrays(batch.columns[:2] + new, names=["id", "row"] + [n for n, _ in types])

    return docs.mapInArrow(run, "id bigint, row bigint, " + ", ".join(f"{n} bigint" for n, _ in types))


def _signatures(docs: DataFrame) -> DataFrame:
    """(sig, node) of every set; copies within a task are skipped, as far as it remembers them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sigs, nodes, held = [], [], 0

        def out() -> pa.RecordBatch:
            sig = np.concatenate(sigs).view(np.int64)
            node = np.repeat(np.array(nodes, dtype=np.int64), [len(s) for s in sigs])
            return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(node)], names=["sig", "node"])

        for batch in batches:
            for text in batch.column(2).to_pylist():
                elements = shingle_set(text or "")
                if not len(elements):
                    continue
                node, _ = identity(elements)
                if node in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(node)
                own = signatures(elements)
                if len(own):
                    sigs.append(own)
                    nodes.append(node)
                    held += len(own)
                if held >= OUT_ROWS:
                    yield out()
                    sigs, nodes, held = [], [], 0
        if sigs:
            yield out()

    return docs.mapInArrow(run, "sig bigint, node bigint")


def _groups(sigs: DataFrame) -> DataFrame:
    """(grp, node) of every candidate group with two nodes at least; groups of equal members are one."""
    in_order = Window.partitionBy("sig").orderBy("node")
    whole = Window.partitionBy("sig")
    once = sigs.withColumn("before", F.lag("node").over(in_order)).where(
        F.col("before").isNull() | (F.col("before") != F.col("node")))
    named = once.withColumn("grp", F.bit_xor(F.xxhash64("node")).over(whole)).withColumn(
        "members", F.count(F.lit(1)).over(whole)).where("members > 1")
    return named.select("grp", "node").distinct()


def _may_link(a: str, b: str) -> Column:
    """Necessary for a link: sizes, and differing bits of the sketches."""
    def col(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")
    small, large = F.least(col(a, "n"), col(b, "n")), F.greatest(col(a, "n"), col(b, "n"))
    odd = reduce(lambda x, y: x + y, [F.bit_count(col(a, f"s{i}").bitwiseXOR(col(b, f"s{i}")))
                                      for i in range(SKETCH_WORDS)])
    return ((100 * small >= THRESHOLD * large)
            & (odd * (100 + THRESHOLD) <= (col(a, "n") + col(b, "n")) * (100 - THRESHOLD)))


def wide_sketch(elements: np.ndarray) -> bytes:
    """Parities in as many bits as four times the size, rounded up to a power of two; halves fold by exclusive-or."""
    bits = max(1024, 1 << (4 * len(elements) - 1).bit_length())
    odd = np.bincount((elements % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def odd_bits(a: bytes, b: bytes) -> int:
    """Differing parities of two wide sketches, at the width of the narrower one."""
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    while len(x) != len(y):
        if len(x) > len(y):
            x, y = y, x
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _wide(texts: DataFrame) -> DataFrame:
    """(node, n, wide) of the candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([wide_sketch(s) for s in sets], pa.binary())], names=["node", "n", "wide"])

    return texts.select("node", "text").mapInArrow(run, "node bigint, n bigint, wide binary")


def _sieved(pairs: DataFrame, wide: DataFrame) -> DataFrame:
    """The pairs (a, b) that their wide sketches don't rule out."""
    both = (pairs.join(wide.select(F.col("node").alias("a"), F.struct("n", "wide").alias("x")).hint("merge"), "a")
            .join(wide.select(F.col("node").alias("b"), F.struct("n", "wide").alias("y")).hint("merge"), "b")
            .select("a", "b", "x.n", "x.wide", F.col("y.n").alias("m"), F.col("y.wide").alias("wide_b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [odd_bits(x, y) <= differences(n, m)
                    for n, x, m, y in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
            .select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            keep = []
            for a, b, *both_texts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sets = []
                for node, text in zip((a, b), both_texts, strict=True):
                    if node not in known:
                        elements = shingle_set(text)
                        held += len(elements)
                        if held > 4_000_000:
                            known.clear()
                            held = len(elements)
                        known[node] = elements
                        sets.append(elements)
                    else:
                        sets.append(known[node])
                x, y = sets
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= THRESHOLD * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge (a, b): root is the component's smallest node.

    Alternates two steps until nothing changes: every node's larger neighbours,
    then every node and its smaller ones, move to the smallest neighbour.  Minima are
    grouped with partial aggregation; a node of very many edges is split in the joins.
    """
    def moved(e: DataFrame) -> DataFrame:
        sides = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return (sides.join(least.hint("merge"), "a").where("b > a")
                .select(F.col("b").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())

    def gathered(e: DataFrame) -> DataFrame:
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        joined = e.join(least.hint("merge"), "u")
        return (joined.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
                .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())

    now = _checkpoint(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a <> b").distinct(), "edges")
    state = None
    while True:
        new = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if state == (new["n"], new["h"]):
            return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
                    .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
        state = (new["n"], new["h"])
        now = _checkpoint(gathered(moved(now)), "edges")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("row"),
                     F.col(text_col).alias("text"))


def linked(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, classes, links): sets of all rows, one class per distinct set, verified links that connect the classes."""
    docs = _keyed(df, id_col, text_col)
    sets = _checkpoint(_sets(docs), "sets")
    words = [f"s{i}" for i in range(SKETCH_WORDS)]
    clash = F.raise_error(F.lit("two different sets share a 64-bit hash; change MULTIPLIERS and run again"))
    classes = (sets.where("n > 0").groupBy("node")
               .agg(F.min("id").alias("first"), F.min(F.struct("id", "row")).alias("one"), F.min("n").alias("n"),
                    F.min("check").alias("c1"), F.max("check").alias("c2"), *[F.min(w).alias(w) for w in words])
               .withColumn("n", F.when(F.col("c1") == F.col("c2"), F.col("n")).otherwise(clash.cast("bigint"))))
    groups = _checkpoint(_groups(_signatures(docs)), "groups")

    info = _checkpoint(groups.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
                       .join(classes.hint("merge"), "node").select("node", "degree", "one", "n", *words), "nodes")
    texts = _checkpoint(
        docs.alias("d").join(info.select("node", "one").alias("i").hint("merge"),
                             F.col("d.id").eqNullSafe(F.col("i.one.id")) & (F.col("d.row") == F.col("i.one.row")))
        .dropDuplicates(["node"]).select("node", F.coalesce("text", F.lit("")).alias("text")), "texts")
    wide = _checkpoint(_wide(texts), "wide")
    sized = info.drop("one")
    members = groups.join(sized.hint("merge"), "node")

    hubs = groups.join(sized.select("node", "degree").hint("merge"), "node").groupBy("grp").agg(
        F.max(F.struct("degree", "node")).getField("node").alias("hub"))
    star = (groups.join(hubs.hint("merge"), "grp").where("node <> hub")
            .select(F.least("node", "hub").alias("x"), F.greatest("node", "hub").alias("y")).distinct())
    near = (star.join(sized.alias("a").hint("merge"), F.col("x") == F.col("a.node"))
            .join(sized.alias("b").hint("merge"), (F.col("y") == F.col("b.node")) & _may_link("a", "b"))
            .select(F.col("x").alias("a"), F.col("y").alias("b")))
    first = _checkpoint(_verified(_sieved(near, wide), texts), "links")

    roots = _checkpoint(components(first), "roots")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Grouped with partial aggregation and joined back, so that a large group is split, not windowed in one task.
    spanning = (placed(groups).groupBy("grp").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                .where("low <> high").select("grp"))
    open_groups = _checkpoint(placed(members).drop("degree").join(spanning.hint("merge"), "grp", "left_semi"), "open")
    rest = (open_groups.alias("a").join(
        open_groups.alias("b").hint("merge"),
        (F.col("a.grp") == F.col("b.grp")) & (F.col("a.node") < F.col("b.node"))
        & (F.col("a.root") != F.col("b.root")) & _may_link("a", "b"))
        .select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct())
    links = first.unionByName(_checkpoint(_verified(_sieved(rest, wide), texts), "links"))
    return sets, classes, links


def grouped(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, row (hash of the text), n_shingles, component_id."""
    sets, classes, links = linked(df, id_col, text_col)
    roots = _checkpoint(components(links), "roots")
    named = classes.select("node", "first", "n").join(roots.hint("merge"), "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_node = named.join(least.hint("merge"), "root").select("node", "component_id")
    return (sets.select("id", "row", "n", "node").join(of_node.hint("merge"), "node", "left")
            .select(F.col("id").alias(id_col), "row", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")))


def kept_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose id is their component's smallest, with its own columns."""
    stays = (grouped(df, id_col, text_col).where(F.col(id_col).eqNullSafe(F.col("component_id")))
             .select(F.col(id_col).alias("_stays"), F.col("row").alias("_row")))
    return df.join(stays.hint("merge"), F.col(id_col).eqNullSafe(F.col("_stays"))
                   & (F.xxhash64(text_col) == F.col("_row")), "left_semi")
