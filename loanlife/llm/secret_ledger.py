"""Secret scans over a ledger of blobs.

Every historical version of a path is addressed by its content: the SHA-256 of its text is its
blob.  The ledger, a Parquet folder, notes which rules in which versions have been run over
a blob and what they found.  A scan of new versions

1. reduces them to one row per blob (partial aggregation of digests, no text moves),
2. strikes out the pairs of blob and rule version that the ledger has,
3. fetches one text for each blob that is left, runs the rules not yet seen on it, and
4. writes a batch of ledger rows; ``findings`` joins them back to every path and version.

So a text that a thousand commits carry is scanned once, a new version of one rule runs that rule
alone over old blobs, and a scan repeated with nothing new reads digests only.  Batches are
named: one that was lost half-way is run again under its name and replaces what it left.
Every ledger row is true on its own, so that a batch cut short does no harm.

Everything is built from Spark's own functions.  Offsets come from splitting the text at the
matches: the lengths of pieces and matches, added up in two levels, so that a text
of very many matches takes time in proportion.  A blob that holds a third of all rows costs one
row a task before the shuffle; joined back, its rows are dealt over salts.

Defined results
* null text counts as empty and has no spans; whole texts are scanned;
* offsets are code points, the end exclusive; order is by start, then kind as in ``RULES``, then end;
  matches of one kind never overlap, those of different kinds may; a match that fails its kind's
  check is dropped and its characters are not tried again;
* rows stay one to one, repeated rows and null keys included; columns that are neither key nor text are left
  aside; an output column whose name a key has gets a leading underscore; empty tables give no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlife.llm.common import free_name, shuffle_partitions

ASSIGNED = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and a check that a match's text must pass.  A changed rule gets a new version."""

    kind: str
    version: int
    pattern: str
    check: Callable[[Column], Column] | None = None

    @property
    def tag(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns with a least length find what the open ones would keep: a run that is too short has no long run within it.
RULES = (
    Rule("assign", 1, ASSIGNED, lambda m: F.length(F.regexp_extract(m, ASSIGNED, 1)) >= 6),
    Rule("access", 1, "AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, "(?<![0-9a-f])[0-9a-f]{24,}"),
    Rule("pem", 1, r"-----BEGIN\x20[A-Z0-9\x20]*PRIVATE\x20KEY-----"),
    Rule("bearer", 1, r"(?i:bearer)\x20[A-Za-z0-9._~+/-]{20,}=*"),
)
BASE = ("assign", "access", "hex")

CHUNK = 256      # matches whose lengths are added up together

SPANS = "array<struct<start:bigint,end:bigint,rule:string>>"
LEDGER = f"blob string, rules array<string>, spans {SPANS}, batch string"


# ------------------------------------------------------------------- spans

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(steps: Column, start: Column) -> Column:
    """start + the first step, + the second, ..."""
    first = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(steps, first, lambda a, x: F.struct(
        (a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"] + x)).alias("out")), lambda a: a["out"])


def running_sums(steps: Column) -> Column:
    """Inclusive running sums of an array of longs, in chunks: appending to one long array would copy it every time."""
    zero = F.lit(0).cast("bigint")

    def total(xs: Column) -> Column:
        return F.aggregate(xs, zero, lambda a, x: a + x)

    def from_chunks(chunks: Column) -> Column:
        ends = _running(F.transform(chunks, total), zero)
        return F.flatten(F.zip_with(chunks, ends, lambda xs, end: _running(xs, end - total(xs))))

    def chunked(xs: Column) -> Column:
        cuts = F.sequence(F.lit(1), F.size(xs), F.lit(CHUNK))
        return F.transform(cuts, lambda i: F.slice(xs, i, F.lit(CHUNK)))
    return let(steps, lambda xs: F.when(F.size(xs) <= CHUNK, _running(xs, zero)).otherwise(let(chunked(xs), from_chunks)))


def spans(text: Column, rule: Rule) -> Column:
    """Leftmost matches, one after another, that pass the rule's check."""
    pattern = F.lit(rule.pattern)

    def placed(matches: Column) -> Column:
        before = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(matches))
        steps = F.zip_with(matches, before, lambda m, gap: (F.length(gap) + F.length(m)).cast("bigint"))
        told = F.zip_with(matches, running_sums(steps), lambda m, end: F.struct(
            (end - F.length(m)).alias("start"), end.alias("end"), F.lit(rule.tag).alias("rule"),
            (F.lit(True) if rule.check is None else rule.check(m)).alias("good")))
        good = F.filter(told, lambda s: s["good"])
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rule"].alias("rule")))
    nothing = F.array().cast(SPANS)
    return let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda ms: F.when(F.size(ms) == 0, nothing).otherwise(placed(ms)))


# ------------------------------------------------------------------ ledger

class BlobLedger:
    """A ledger at ``path`` (a shared folder); created when absent, reopened otherwise."""

    def __init__(self, spark: SparkSession, path: str, rules: Sequence[Rule] = RULES):
        assert len({r.kind for r in rules}) == len(rules) and all(re.fullmatch("[a-z0-9_]+", r.kind) for r in rules)
        self.spark, self.path, self.rules = spark, path, tuple(rules)
        spark.createDataFrame([], LEDGER).write.mode("append").partitionBy("batch").parquet(path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path)

    @staticmethod
    def _versions(versions: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
        told = F.coalesce(F.col(text), F.lit(""))
        key = F.struct(*[F.col(k) for k in keys])
        return versions.select(key.alias("key"), F.xxhash64(key).alias("pick"), told.alias("text"), F.sha2(told, 256).alias("blob"))

    def unseen(self, versions: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text",
               batch: str | None = None) -> DataFrame:
        """blob, pick, todo: blobs of ``versions`` with rules that no other batch has run on them."""
        known = self.rows()
        if batch is not None:
            known = known.where(F.col("batch") != batch)
        known = (known.select("blob", F.explode("rules").alias("rule")).groupBy("blob")
                 .agg(F.collect_set("rule").alias("known")))
        blobs = self._versions(versions, keys, text).groupBy("blob").agg(F.min("pick").alias("pick"))
        tags = F.array(*[F.lit(r.tag) for r in self.rules])
        todo = F.array_except(tags, F.coalesce("known", F.array().cast("array<string>")))
        return blobs.join(known, "blob", "left").select("blob", "pick", todo.alias("todo")).where(F.size("todo") > 0)

    def scan(self, versions: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text", batch: str | None = None) -> str:
        """Run the rules over what the ledger has not seen of ``versions``; returns the batch's name."""
        name = batch or uuid.uuid4().hex
        unseen = self.unseen(versions, keys, text, name)
        # One text a blob: the rows are dealt by blob and pick, so that copies spread.
        texts = (self._versions(versions, keys, text).select("blob", "pick", "text").join(unseen, ["blob", "pick"])
                 .dropDuplicates(["blob", "pick"]))
        nothing = F.array().cast(SPANS)
        found = [F.when(F.array_contains("todo", r.tag), spans(F.col("text"), r)).otherwise(nothing) for r in self.rules]
        (texts.select("blob", F.col("todo").alias("rules"), F.concat(*found).alias("spans"), F.lit(name).alias("batch"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.path))
        return name

    def findings(self, versions: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
        """Keys, blob and spans (start, end, kind, in order) of every version, by the present rules."""
        tags, kinds = [r.tag for r in self.rules], F.array(*[F.lit(r.kind) for r in self.rules])
        current = F.filter("spans", lambda s: s["rule"].isin(*tags))
        hits = (self.rows().select("blob", current.alias("spans")).where(F.size("spans") > 0)
                .groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans")))
        rows = (self._versions(versions, keys, text).drop("text")
                .withColumn("salt", F.pmod("pick", F.lit(shuffle_partitions(self.spark)))).drop("pick"))
        salted = rows.select("blob", "salt").distinct().join(hits, "blob")
        kind = F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), F.array_position(kinds, F.substring_index(s["rule"], "@", 1)).alias("no"), s["end"].alias("end")))
        told = F.transform(F.array_sort(kind), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.element_at(kinds, s["no"].cast("int")).alias("kind")))
        blob_name, spans_name = free_name(list(keys), "blob"), free_name(list(keys), "spans")
        return rows.join(salted, ["blob", "salt"], "left").select(
            "key.*", F.col("blob").alias(blob_name),
            F.coalesce(told, F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")).alias(spans_name))
