"""Merkle dataset manifest with octopus multiproofs.

Every row of a table is a leaf.  The rows of one source form a tree of arity
three in ascending order of their ids, and the sources' roots form one more tree,
whose root stands for the whole table.  A manifest keeps the leaves with their
places and all inner nodes as Parquet, so that any part of the table can be proved
against the root later.

A proof holds the siblings on a leaf's way to the root.  Proofs of many leaves
overlap almost entirely, so a leaf partition (a block of 3^7 places of a source)
first works out which node coordinates its leaves need and cannot derive from each
other (``missing``, the octopus's minimal union), fetches those at once by one
join, derives the shared inner nodes itself and expands the proof of every leaf
locally (``paths``).  The blocks are subtrees, so for a whole table only
nodes above level seven are fetched: less than one in 1,400.

How it scales: texts are hashed in one pass and never shuffled.  Places come from a
range partitioning of the narrow leaves by source, id, leaf and row, so a source
with a third of all rows lies in many partitions; its nodes are made block by block,
and every round leaves one node of 2,187.  No group is larger than a block.

Defined results
* a leaf hashes its fields one after another, ``-`` for null, else the UTF-8
  length, ``:`` and the value; integers are written in decimal;
* a null source is a source of its own and comes first; null ids come first within
  a source, equal ids by leaf; repeated rows are leaves of their own;
* a run of fewer than three nodes (even one) is hashed like a full one; a tree of one leaf
  is that leaf; a proof without siblings is the hash of nothing;
* empty tables give no rows; columns that are not fields are left aside, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ARITY = 3
LEVELS = 7                  # levels of a block
BLOCK = ARITY ** LEVELS     # places of a leaf partition

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------------------ leaves

def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields' encodings."""
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def tree_name(source: Column) -> Column:
    """A name that is never null and sorts as the sources do, null first."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


# ------------------------------------------------- trees (plain functions)

def digest(nodes: Sequence[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The levels above consecutive nodes that start at a run."""
    out = []
    for _ in range(levels):
        nodes = [digest(nodes[i:i + ARITY]) for i in range(0, len(nodes), ARITY)]
        out.append(nodes)
    return out


def missing(places: np.ndarray, size: int) -> list[np.ndarray]:
    """For each level the places of the nodes that proofs of the leaves at ``places`` need and
    that cannot be derived from those leaves and the other nodes fetched."""
    out, have = [], np.unique(places)
    while size > 1:
        runs = np.unique(have // ARITY)
        needed = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        out.append(np.setdiff1d(needed[needed < size], have, assume_unique=True))
        have, size = runs, -(-size // ARITY)
    return out


Path = tuple[tuple[str, str], ...]      # per level the siblings to the left and to the right, joined


def paths(places: Sequence[int], leaves: Sequence[str], size: int, fetched: dict[tuple[int, int], str]) -> tuple[list[Path], str]:
    """Every leaf's path, and the root, from the leaves and the nodes that ``missing`` names."""
    own, tiers, level = dict(zip(places, leaves)), [], 0
    while size > 1:
        runs = {place // ARITY: None for place in own}
        tier = {at: own[at] if at in own else fetched[level, at]
                for run in runs for at in range(run * ARITY, min(run * ARITY + ARITY, size))}
        tiers.append((own, tier))
        own = {run: digest([tier[at] for at in range(run * ARITY, run * ARITY + ARITY) if at in tier]) for run in runs}
        size, level = -(-size // ARITY), level + 1
    above: dict[int, Path] = {0: ()}
    root = own.get(0, "")
    for own, tier in reversed(tiers):
        here = {}
        for place in own:
            first = place - place % ARITY
            left = "".join(tier[at] for at in range(first, place))
            right = "".join(tier[at] for at in range(place + 1, first + ARITY) if at in tier)
            here[place] = ((left, right), *above[place // ARITY])
        above = here
    return [above[place] for place in places], root


def fold(leaf: str, path: Path) -> str:
    for left, right in path:
        leaf = sha256(f"{left}{leaf}{right}".encode()).hexdigest()
    return leaf


def siblings_digest(path: Path) -> str:
    return sha256("".join(left + right for left, right in path).encode()).hexdigest()


# ------------------------------------------------------ tasks (one block)

def _block_nodes(key: tuple, rows: pa.Table) -> pa.Table:
    """Inner nodes over one block: level (above the block's own), place, digest."""
    rows = rows.sort_by("place")
    tree, block, size = key[0].as_py(), key[1].as_py(), rows["size"][0].as_py()
    tiers = climb(rows["node"].to_pylist(), min(LEVELS, height(size)))
    level = [k for k, tier in enumerate(tiers, 1) for _ in tier]
    place = [block * ARITY ** (LEVELS - k) + i for k, tier in enumerate(tiers, 1) for i in range(len(tier))]
    nodes = [node for tier in tiers for node in tier]
    is_root = [size <= BLOCK and k == len(tiers) for k in level]
    return pa.table({"tree": pa.array([tree] * len(nodes), pa.string()), "level": pa.array(level, pa.int32()),
                     "place": pa.array(place, pa.int64()), "size": pa.array([size] * len(nodes), pa.int64()),
                     "is_root": pa.array(is_root, pa.bool_()), "node": pa.array(nodes, pa.string())})


def _block_missing(key: tuple, rows: pa.Table) -> pa.Table:
    wanted = missing(rows["place"].to_numpy(), rows["size"][0].as_py())
    level = np.repeat(np.arange(len(wanted), dtype=np.int32), [len(w) for w in wanted])
    place = np.concatenate([np.empty(0, np.int64), *wanted]).astype(np.int64)
    return pa.table({"tree": pa.array([key[0].as_py()] * len(place), pa.string()),
                     "block": pa.array([key[1].as_py()] * len(place), pa.int64()),
                     "level": pa.array(level, pa.int32()), "place": pa.array(place, pa.int64())})


_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _expanded(rows: pa.Table, fetched: pa.Table) -> tuple[pa.Table, list[Path], str]:
    rows = rows.sort_by("place")
    nodes = {(n["level"], n["place"]): n["node"] for n in fetched["nodes"][0].as_py() or []}
    found, root = paths(rows["place"].to_pylist(), rows["node"].to_pylist(), rows["size"][0].as_py(), nodes)
    return rows, found, root


def _block_paths(rows: pa.Table, fetched: pa.Table) -> pa.Table:
    if not rows.num_rows:
        return pa.table({"tree": pa.array([], pa.string()), "root": pa.array([], pa.string()), "path": pa.array([], _PATH)})
    rows, found, root = _expanded(rows, fetched)
    told = [[{"left": left, "right": right} for left, right in path] for path in found]
    return pa.table({"tree": rows["item"], "root": pa.array([root] * len(told), pa.string()), "path": pa.array(told, _PATH)})


def _block_audit(rows: pa.Table, fetched: pa.Table) -> pa.Table:
    if not rows.num_rows:
        nothing = pa.array([], pa.string())
        return pa.table({"item": rows["item"], "leaf": nothing, "subroot": nothing, "root": nothing,
                         "proof_sha256": nothing, "folded_root": nothing})
    rows, found, subroot = _expanded(rows, fetched)
    above = tuple((step["left"], step["right"]) for step in fetched["path"][0].as_py())
    whole = [path + above for path in found]
    return pa.table({
        "item": rows["item"], "leaf": rows["node"], "subroot": pa.array([subroot] * len(whole), pa.string()),
        "root": pa.array([fetched["root"][0].as_py()] * len(whole), pa.string()),
        "proof_sha256": pa.array([siblings_digest(path) for path in whole], pa.string()),
        "folded_root": pa.array([fold(claim, path) for claim, path in zip(rows["claim"].to_pylist(), whole)], pa.string())})


# ------------------------------------------------------------ the manifest

class Forest:
    """Trees over the ``node`` column of ``items``, one per value of ``tree`` (never null), each in the
    order of ``item``, ``node`` and ``row``; ``claim`` goes along.  Kept below ``path`` (a shared folder)."""

    def __init__(self, items: DataFrame, path: str):
        self.spark, self.path = items.sparkSession, path
        order = ["tree", F.col("item").asc_nulls_first(), "node", "row"]
        (items.repartitionByRange(*order).sortWithinPartitions(*order)
         .select("tree", "item", "node", "claim", F.monotonically_increasing_id().alias("run"))
         .write.parquet(f"{path}/leaves"))
        kept = self.spark.read.parquet(f"{path}/leaves").withColumn("part", F.shiftright("run", 33))
        parts = kept.groupBy("tree", "part").agg(F.min("run").alias("first"), F.count(F.lit(1)).alias("rows"))
        whole, before = Window.partitionBy("tree"), Window.partitionBy("tree").orderBy("part")
        starts = parts.select(
            "tree", "part", F.sum("rows").over(whole).alias("size"),
            (F.coalesce(F.sum("rows").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
             - F.col("first")).alias("shift"))
        place = F.col("run") + F.col("shift")
        self.leaves = kept.join(starts, ["tree", "part"]).select(
            "tree", F.expr(f"(run + shift) div {BLOCK}").alias("block"), place.alias("place"), "size", "item", "node", "claim")
        largest = starts.agg(F.max("size")).first()[0] or 0
        self.rounds = -(-height(largest) // LEVELS)
        base = self.leaves.select("tree", "block", "place", "size", "node")
        for r in range(self.rounds):
            made = (base.groupBy("tree", "block")
                    .applyInArrow(_block_nodes, "tree string, level int, place bigint, size bigint, is_root boolean, node string"))
            (made.withColumn("level", F.col("level") + r * LEVELS).withColumn("upper", F.col("level") >= LEVELS)
             .write.partitionBy("upper").parquet(f"{path}/nodes/round={r}"))
            base = (self._round(r).where((F.col("level") == (r + 1) * LEVELS) & (F.col("size") > BLOCK))
                    .select("tree", F.expr(f"place div {BLOCK}").alias("block"), "place",
                            F.expr(f"(size + {BLOCK - 1}) div {BLOCK}").alias("size"), "node"))

    def _round(self, r: int) -> DataFrame:
        return self.spark.read.schema("tree string, level int, place bigint, size bigint, is_root boolean, node string, "
                                      "upper boolean").parquet(f"{self.path}/nodes/round={r}")

    def nodes(self, upper: bool) -> DataFrame:
        """Kept nodes: those from the blocks' own roots up, or all, the leaves included."""
        told = ["tree", "level", "place", "node"]
        out = self.leaves.select("tree", F.lit(0).alias("level"), "place", "node")
        if upper:
            out = out.where("false")
        for r in range(self.rounds):
            made = self._round(r)
            out = out.unionByName((made.where("upper") if upper else made).select(*told))
        return out

    def roots(self) -> DataFrame:
        """tree, root."""
        out = self.leaves.where("size = 1").select("tree", F.col("node").alias("root"))
        for r in range(self.rounds):
            out = out.unionByName(self._round(r).where("is_root").select("tree", F.col("node").alias("root")))
        return out

    def fetch(self, leaves: DataFrame, upper: bool) -> DataFrame:
        """of_tree, of_block, nodes: what the blocks of ``leaves`` need and cannot derive, one row a block."""
        wanted = (leaves.select("tree", "block", "place", "size").groupBy("tree", "block")
                  .applyInArrow(_block_missing, "tree string, block bigint, level int, place bigint"))
        got = (wanted.join(self.nodes(upper), ["tree", "level", "place"])
               .groupBy("tree", "block").agg(F.collect_list(F.struct("level", "place", "node")).alias("nodes")))
        return (leaves.select("tree", "block").distinct().join(got, ["tree", "block"], "left")
                .select(F.col("tree").alias("of_tree"), F.col("block").alias("of_block"), "nodes"))


class Manifest:
    """Trees per source and the tree of their roots, kept below ``path`` (a shared folder)."""

    def __init__(self, docs: DataFrame, path: str, fields: Sequence[str] = FIELDS, key: str = "doc_id",
                 source: str = "source", claim: Column | None = None):
        """``claim``: the leaf that ``audit`` tests in place of a row's own."""
        own = leaf([F.col(f) for f in fields])
        (docs.select(tree_name(F.col(source)).alias("tree"), F.col(key).alias("item"), own.alias("node"),
                     (own if claim is None else claim).alias("claim"), F.monotonically_increasing_id().alias("row"))
         .write.parquet(f"{path}/hashed"))
        self.key, self.key_type = key, docs.schema[key].dataType.simpleString()
        self.rows = Forest(docs.sparkSession.read.parquet(f"{path}/hashed"), f"{path}/rows")
        roots = self.rows.roots()
        self.sources = Forest(roots.select(F.lit("").alias("tree"), F.col("tree").alias("item"), F.col("root").alias("node"),
                                           F.col("root").alias("claim"), F.lit(0).cast("bigint").alias("row")), f"{path}/sources")

    def source_paths(self) -> DataFrame:
        """tree, root, path: each source's way from its root to that of the table."""
        leaves = self.sources.leaves
        return (leaves.groupBy("tree", "block").cogroup(self.sources.fetch(leaves, upper=True).groupBy("of_tree", "of_block"))
                .applyInArrow(_block_paths, "tree string, root string, path array<struct<left string, right string>>"))

    def audit(self, keys: DataFrame | None = None) -> DataFrame:
        """key, leaf, subroot, root, proof_sha256, folded_root, verified of every row, or of those
        whose key is in ``keys``.  ``folded_root`` is folded from the claim and the row's own siblings."""
        leaves = self.rows.leaves
        if keys is not None:
            leaves = leaves.join(keys.select(F.col(self.key).alias("item")), "item", "left_semi").select(*leaves.columns)
        # Whole blocks derive everything up to their own roots.
        fetched = self.rows.fetch(leaves, upper=keys is None).join(
            self.source_paths().withColumnRenamed("tree", "of_tree"), "of_tree")
        done = (leaves.groupBy("tree", "block").cogroup(fetched.groupBy("of_tree", "of_block"))
                .applyInArrow(_block_audit, f"item {self.key_type}, leaf string, subroot string, root string, "
                                            "proof_sha256 string, folded_root string"))
        return (done.withColumn("verified", F.col("folded_root") == F.col("root"))
                .withColumnRenamed("item", self.key))
