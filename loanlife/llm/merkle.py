"""Document fingerprints: a Merkle tree over blocks, paragraphs and sections.

A paragraph is a line; paragraphs of more than ``BLOCK`` code points are leaves
cut into blocks of about as many, at borders that the ``WINDOW`` code points before
them say (``SHORTEST`` to ``LONGEST`` apart), so that an edit changes the blocks that
it touches and seldom a few after them.  A section ends after a blank line or after a paragraph whose
hash says so (about one in eight), so that an edit moves no section border
elsewhere.  A node's hash covers its children's hashes; equal roots mean equal
texts, and walking down differing branches only locates an edit.

A fingerprint is text: the root, then the sections (``;``) with their paragraphs
(``,``) as ``hash:length`` and, for cut paragraphs, ``hash:length/block/block``.
The likeness of two fingerprints is the share of code points in paragraphs or
blocks that both have (twice the common length over the sum of both lengths).

Defined results
* null text counts as empty; an empty text is one empty paragraph; two empty
  texts have likeness 1, an empty and another one 0;
* documents follow one another by (id, text), null ids first, the last by the
  first; a lone document follows itself; repeated rows follow one another;
* an empty table gives an empty result; extra columns pass through ``fingerprints``,
  an output column whose name is taken gets a leading underscore.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlife.llm.common import free_name, shuffle_partitions

BLOCK = 32           # code points of a block on average; fingerprints take about 9/32 of the text
SHORTEST, LONGEST = 16, 96   # code points of a block, the last of a paragraph excepted
WINDOW = 4           # code points that decide on a border; one in BLOCK - SHORTEST places is one
SECTION_BYTE = 32    # a paragraph whose hash begins with a lower byte ends its section


def digest(content: bytes, kind: bytes) -> bytes:
    return hashlib.blake2b(content, digest_size=16, person=kind).digest()


def borders(text: str) -> list[int]:
    """Places of ``text`` where the code points before say that a block may end."""
    if len(text) <= BLOCK:
        return []
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint32)
    mixed = np.zeros(len(points) - WINDOW + 1, dtype=np.uint32)
    for i in range(WINDOW):
        mixed = (mixed ^ points[i:i + len(mixed)]) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
    return (np.flatnonzero(mixed % np.uint32(BLOCK - SHORTEST) == 0) + WINDOW).tolist()


def cut(line: str, start: int, places: list[int]) -> list[str]:
    """Blocks of a line that begins at ``start`` of the text with these ``borders``."""
    ends, last = [], 0
    for at in range(bisect_left(places, start + SHORTEST), bisect_left(places, start + len(line))):
        place = places[at] - start
        while place - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if place - last >= SHORTEST:
            last = place
            ends.append(last)
    while len(line) - last > LONGEST:
        last += LONGEST
        ends.append(last)
    return [line[a:b] for a, b in zip([0, *ends], [*ends, len(line)], strict=True)]


class Tree:
    """Root, and sections as lists of (paragraph hash, length, [(block hash, length)])."""

    def __init__(self, text: str):
        self._leaves, self.sections, section = None, [], []
        section_hashes = []

        def close():
            self.sections.append(section[:])
            section_hashes.append(digest(b"".join(p[0] for p in section), b"section"))
            section.clear()

        places, start = borders(text), 0
        for line in text.split("\n"):
            if len(line) <= BLOCK:
                blocks = []
                node = digest(line.encode("utf-8"), b"block")
            else:
                blocks = [(digest(c.encode("utf-8"), b"block"), len(c)) for c in cut(line, start, places)]
                node = digest(b"".join(b for b, _ in blocks), b"paragraph")
            section.append((node, len(line) + 1, blocks))
            start += len(line) + 1
            if not line or node[0] < SECTION_BYTE:
                close()
        if section:
            close()
        self.section_hashes = section_hashes
        self.root = digest(b"".join(section_hashes), b"root")
        self.length = sum(p[1] for s in self.sections for p in s)

    def text(self) -> str:
        return self.root.hex() + "|" + ";".join(
            ",".join(node.hex()[:16] + f":{n}" + "".join("/" + b.hex()[:8] for b, _ in blocks)
                     for node, n, blocks in section) for section in self.sections)

    def leaves(self) -> Counter:
        """Length-weighted leaves: code points by leaf hash."""
        if self._leaves is not None:
            return self._leaves
        count: Counter = Counter()
        for section in self.sections:
            for node, n, blocks in section:
                if blocks:
                    for b, m in blocks:
                        count[b] += m
                    count[blocks[-1][0]] += 1      # the line's end
                else:
                    count[node] += n
        self._leaves = count
        return count


def likeness(a: Tree, b: Tree) -> float:
    if a.root == b.root:
        return 1.0
    if a.length == 1 or b.length == 1:             # an empty text against another one
        return 0.0
    return min(1.0, 2 * (a.leaves() & b.leaves()).total() / (a.length + b.length))


def differences(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """(section, paragraph) numbers in ``a`` that ``b`` lacks, found by walking down differing branches."""
    if a.root == b.root:
        return []
    same_sections = Counter(b.section_hashes)
    rest = Counter(p[0] for h, s in zip(b.section_hashes, b.sections, strict=True) for p in s)
    out = []
    for i, (h, section) in enumerate(zip(a.section_hashes, a.sections, strict=True)):
        if same_sections[h]:
            same_sections[h] -= 1
            rest.subtract(p[0] for p in section)
            continue
        for j, (node, _, _) in enumerate(section):
            if rest[node] > 0:
                rest[node] -= 1
            else:
                out.append((i, j))
    return out


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def fingerprints(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``fingerprint``."""
    at, name = df.columns.index(text_col), free_name(df.columns, "fingerprint")
    schema = T.StructType(df.schema.fields + [T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([Tree(t or "").text() for t in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(batch.columns + [prints], names=batch.schema.names + [name])

    return df.mapInArrow(run, schema)


def in_order(df: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """(part, head, id, text): range parts in order, each ended by the first document of the next part.

    The borders are ``parts`` - 1 ids that occur in the table; only they reach
    the driver.  Their documents are read a second time as the heads.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    seen = docs.agg(F.min("id").alias("least"), F.max(F.col("id").isNull()).alias("null_ids"),
                    F.percentile_approx("id", shares, 100_000).alias("borders")).first()
    borders = sorted({b for b in seen["borders"] or [] if b > seen["least"]}) if parts > 1 else []

    # Number of borders up to the id, in two steps of about sqrt(parts) comparisons.
    width = max(1, int(len(borders) ** 0.5))
    rows = [borders[i:i + width] for i in range(0, len(borders), width)]

    def up_to(values):
        return F.size(F.filter(values, lambda b: b <= F.col("id")))
    part = F.lit(0)
    if borders:
        coarse = up_to(F.array(*[F.lit(r[0]).cast("bigint") for r in rows]))
        table = F.array(*[F.array(*[F.lit(b).cast("bigint") for b in r]) for r in rows])
        part = F.when(F.col("id").isNull() | (coarse == 0), 0).otherwise(
            (coarse - 1) * width + up_to(F.element_at(table, F.greatest(coarse, F.lit(1)))))
    first = F.col("id").isNull() if seen["null_ids"] else F.col("id") == F.lit(seen["least"])
    heads = (docs.where(first | F.col("id").isin(borders)).groupBy("id").agg(F.min("text").alias("text"))
             .withColumn("part", F.when(first, len(borders)).otherwise(part - 1)))
    own = docs.withColumn("part", part.cast("int")).withColumn("head", F.lit(0))
    every = own.select("part", "head", "id", "text").unionByName(
        heads.select(F.col("part").cast("int").alias("part"), F.lit(1).alias("head"), "id", "text"))
    return (every.repartitionById(len(borders) + 1, F.col("part"))
            .sortWithinPartitions("part", "head", F.col("id").asc_nulls_first(), "text"))


RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def follow(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of every document and of its edited text, and both likenesses; see ``RESULT``."""
    ordered = in_order(df, id_col, text_col, parts or shuffle_partitions(df.sparkSession))
    names = [f.split()[0] for f in RESULT.split(", ")]

    def told(row, after) -> tuple:
        (_, doc_id, text, tree), (_, _, next_text, next_tree) = row, after
        new = edited(text, next_text)
        new_tree = Tree(new)
        return (doc_id, len(text), hashlib.sha256(new.encode("utf-8")).hexdigest(), tree.text(), new_tree.text(),
                likeness(tree, new_tree), likeness(tree, next_tree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                            ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                            ("near_edited", pa.float64()), ("near_next", pa.float64())])
        pending, out, held = None, [], 0
        for batch in batches:
            for head, doc_id, text in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                row = (head, doc_id, text, Tree(text))
                if pending is not None and not pending[0]:
                    out.append(told(pending, row))
                    held += len(text)
                pending = row
                if held >= 4 << 20 or len(out) >= 2048:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, schema.field(n).type) for n, c in zip(names, zip(*out, strict=True),
                                                                           strict=True)], schema=schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, schema.field(n).type) for n, c in zip(names, zip(*out, strict=True), strict=True)],
                schema=schema)

    return ordered.mapInArrow(run, RESULT)
