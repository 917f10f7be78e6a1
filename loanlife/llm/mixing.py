"""Interleave sources at target weights by Pfair scheduling.

A source with weight a out of a period of T slots (T is the sum of all weights)
owes its block j between the release time floor(j T / a) and the deadline
ceil((j + 1) T / a).  Serving released blocks earliest deadline first fills
every slot and keeps each source within less than one block of its share at
every moment.  The schedule repeats after T slots, so that one period is laid
out once and every block's slot follows from its number in its source:
period number times T plus the slot of that block in the period.

The number of a row in its source is counted in hash buckets: rows are ranked
within (source, bucket), bucket totals give the offsets.  A source that holds a
third of all rows is spread over all buckets and never sorted in one task.

``mix`` takes any number of sources.  Up to ``MOST_SOURCES`` of them each get a
weight.  Of more, those with about the same number of rows (within a factor of
``CLASS_RATIO``) form a class; the classes are scheduled as above, and the sources
of a class take its blocks in turn, which needs no layout: block k of a source
that is the r-th of m is block k m + r of the class.

Errors against the target shares, T being the period: a source with a weight of
its own gets its share x to within x / SLOTS_A_SOURCE + 2 / T; a class likewise, and
a source in a class an equal part of it, at most ``CLASS_RATIO`` ** (1 / temperature)
from its target.  A source in a class is within two blocks of that at every moment.

Defined results
* every row of a weighted source gets a slot exactly once; when a source runs
  out, its later slots stay empty and the others keep theirs;
* a source without a weight gets null slots; null and '' are one source;
* rows in a source are ordered by a seeded hash of the id, then by the id; null
  and repeated ids are ranked like others, equal rows in any order between them;
* an empty table gives an empty result; extra columns pass through, an output
  column whose name is taken gets a leading underscore.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlife.llm.common import free_name

MAX_PERIOD = 100_000   # slots of one period; bounds the schedule that every task gets
SLOTS_A_SOURCE = 100   # slots of a period for each source or class, so that one slot at least for each takes 1 % of them
MOST_SOURCES = MAX_PERIOD // SLOTS_A_SOURCE   # scheduled one by one
CLASS_RATIO = 1.025    # rows of the largest to the smallest source of a class; under 1,000 classes up to 10 billion rows


def windows(weight: int, period: int) -> list[tuple[int, int]]:
    """(release, deadline) of each of the ``weight`` blocks a source owes in a period."""
    return [(j * period // weight, -(-(j + 1) * period // weight)) for j in range(weight)]


def schedule(weights: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """One period: (source, number of the block in the period, slot, release, deadline)."""
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    period = sum(weights.values())
    if period > MAX_PERIOD:
        raise ValueError(f"weights sum up to {period}; scale them down to {MAX_PERIOD} at most")
    jobs = sorted((release, deadline, source, j) for source, w in weights.items() if w
                  for j, (release, deadline) in enumerate(windows(w, period)))
    ready, out, at = [], [], 0
    for slot in range(period):
        while at < len(jobs) and jobs[at][0] <= slot:
            release, deadline, source, j = jobs[at]
            heapq.heappush(ready, (deadline, source, j, release))
            at += 1
        deadline, source, j, release = heapq.heappop(ready)
        out.append((source, j, slot, release, deadline))
    return out


def quantise(shares: dict[str, float], period: int) -> dict[str, int]:
    """Integer weights that sum up to ``period``, by largest remainder, one at least."""
    total = sum(shares.values())
    if not shares or total <= 0:
        return {}
    if len(shares) > period:
        raise ValueError(f"{len(shares)} sources need a period of as many slots; it has {period}")
    spare = period - len(shares)
    exact = {s: spare * x / total for s, x in shares.items()}
    weights = {s: 1 + int(x) for s, x in exact.items()}
    rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[:period - sum(weights.values())]
    return {s: w + (s in rest) for s, w in weights.items()}


def source_key(source_col: str):
    return F.coalesce(F.col(source_col).cast("string"), F.lit(""))


def grown(shares: dict[str, float], period: int) -> dict[str, int]:
    """Weights by ``quantise``; the period grows with the number of shares, up to ``MAX_PERIOD``."""
    if SLOTS_A_SOURCE * len(shares) <= period:
        return quantise(shares, period)
    weights = quantise(shares, max(period, min(SLOTS_A_SOURCE * len(shares), MAX_PERIOD)))
    common = math.gcd(*weights.values())
    return {s: w // common for s, w in weights.items()}


def tempered_weights(df: DataFrame, source_col: str = "source", period: int = 1000,
                     temperature: float = 1.0) -> dict[str, int]:
    """Weights proportional to (rows of a source) ** (1 / temperature).

    They sum up to ``period``, or to ``SLOTS_A_SOURCE`` for each source if that is more (over
    their common divisor).  For over ``MOST_SOURCES`` sources see ``mix``.
    """
    counts = df.groupBy(source_key(source_col).alias("s")).count().limit(MOST_SOURCES + 1).collect()
    if len(counts) > MOST_SOURCES:
        raise ValueError(f"over {MOST_SOURCES} sources cannot each have a weight; mix() schedules them in classes")
    return grown({r["s"]: r["count"] ** (1 / temperature) for r in counts}, period)


def classes(df: DataFrame, source_col: str = "source", period: int = 1000, temperature: float = 1.0,
            buckets: int = 1024) -> tuple[dict[str, int], DataFrame]:
    """Weights of the classes, and (s, mix_class, mix_turn, mix_members) of every source, for any number of them."""
    sized = (df.groupBy(source_key(source_col).alias("s")).count()
             .withColumn("mix_class", F.floor(F.log("count") / math.log(CLASS_RATIO)).cast("string"))
             .withColumn("h", F.xxhash64("s")).withColumn("b", F.pmod(F.shiftright("h", 20), F.lit(buckets))))
    shares = sized.groupBy("mix_class").agg(F.sum(F.pow("count", F.lit(1 / temperature))).alias("share")).collect()
    before = Window.partitionBy("mix_class").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("mix_class")
    offsets = sized.groupBy("mix_class", "b").agg(F.count(F.lit(1)).alias("n")).select(
        "mix_class", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o"), F.sum("n").over(every).alias("mix_members"))
    turns = (sized.join(offsets.hint("merge"), ["mix_class", "b"])
             .withColumn("mix_turn", F.col("o") + F.row_number().over(Window.partitionBy("mix_class", "b").orderBy("h", "s")) - 1))
    return (grown({r["mix_class"]: r["share"] for r in shares}, period),
            turns.select("s", "mix_class", "mix_turn", "mix_members"))


def mix(df: DataFrame, source_col: str = "source", id_col: str = "doc_id", period: int = 1000, temperature: float = 1.0,
        block_rows: int = 1, buckets: int = 1024, seed: int = 0) -> DataFrame:
    """``interleave`` at weights proportional to (rows of a source) ** (1 / temperature), for any number of sources."""
    few = df.select(source_key(source_col).alias("s")).distinct().limit(MOST_SOURCES + 1).count() <= MOST_SOURCES
    weights, turns = ((tempered_weights(df, source_col, period, temperature), None) if few else
                      classes(df, source_col, period, temperature, buckets))
    return interleave(df, weights, source_col, id_col, block_rows, buckets, seed, turns)


def interleave(df: DataFrame, weights: dict[str, int], source_col: str = "source", id_col: str = "doc_id",
               block_rows: int = 1, buckets: int = 1024, seed: int = 0, turns: DataFrame | None = None) -> DataFrame:
    """``df`` with ``slot``, ``place`` (in the block), ``release`` and ``deadline``; sort by slot, place.

    ``buckets`` bounds the rows ranked together: about the rows of a source / ``buckets``.
    With ``turns`` (see ``classes``) the weights are those of the classes.
    """
    spark = df.sparkSession
    new = {n: free_name(df.columns, n) for n in
           ("slot", "place", "release", "deadline", "mix_source", "mix_order", "mix_bucket", "mix_number", "mix_block",
            "mix_class", "mix_turn", "mix_members")}
    key, order, bucket, number, block, unit, turn, members = (new[n] for n in (
        "mix_source", "mix_order", "mix_bucket", "mix_number", "mix_block", "mix_class", "mix_turn", "mix_members"))
    rows = (df.withColumn(key, source_key(source_col))
            .withColumn(order, F.xxhash64(F.lit(seed), F.col(id_col)))
            .withColumn(bucket, F.pmod(F.shiftright(F.col(order), 20), F.lit(buckets))))
    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(F.col(key).alias("s"), F.col(bucket).alias("b")).count()
               .select("s", "b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("o")))
    # A source's class and turn come with its offsets, so that the rows of a hot source stay dealt by bucket.
    if turns is None:
        offsets = offsets.select("*", F.col("s").alias(unit), F.lit(0).alias(turn), F.lit(1).alias(members))
    else:
        offsets = offsets.join(turns.hint("merge"), "s").withColumnsRenamed(
            {"mix_class": unit, "mix_turn": turn, "mix_members": members})
    ranked = Window.partitionBy(key, bucket).orderBy(order, id_col)
    numbered = (rows.join(offsets.hint("merge"), (F.col(key) == F.col("s")) & (F.col(bucket) == F.col("b")))
                .withColumn(number, F.col("o") + F.row_number().over(ranked) - 1)
                .withColumn(block, F.floor(F.col(number) / block_rows) * F.col(members) + F.col(turn)))
    period = sum(weights.values())
    plan = spark.createDataFrame(
        [(s, weights[s], j, slot, r, d) for s, j, slot, r, d in schedule(weights)],
        "ps string, w bigint, j bigint, pslot bigint, prelease bigint, pdeadline bigint")
    by_source = spark.createDataFrame(sorted(weights.items()), "ws string, weight bigint").where("weight > 0")
    # Both tables have at most MAX_PERIOD rows.
    timed = (numbered.join(F.broadcast(by_source), F.col(unit) == F.col("ws"), "left")
             .join(F.broadcast(plan), (F.col(unit) == F.col("ps"))
                   & (F.pmod(F.col(block), F.col("weight")) == F.col("j")), "left"))
    past = F.floor(F.col(block) / F.col("weight")) * period
    return (timed.select(*[timed[c] for c in df.columns],
                         (past + F.col("pslot")).alias(new["slot"]),
                         F.when(F.col("pslot").isNotNull(), F.pmod(F.col(number), F.lit(block_rows)))
                         .cast("bigint").alias(new["place"]),
                         (past + F.col("prelease")).alias(new["release"]),
                         (past + F.col("pdeadline")).alias(new["deadline"])))
