"""Collapse logged conversation snapshots and render the maximal ones.

Services often log a conversation again after every turn.  A conversation whose
turns are a prefix of a longer one adds nothing: every turn gets a rolling hash
of the conversation so far, and a conversation whose last hash occurs as an
inner prefix of any other is removed by anti-join.  Of equal conversations the
smallest id stays.

The rolling hash of a turn is the exclusive-or of 128-bit turn hashes that hold
the turn's position, so that it can be summed in segments of ``SEGMENT`` turn
numbers: no conversation, however long, is sorted or collected as one group.

Defined results
* turns are ordered by (turn, role), null turns first, and turns alike in both by a hash
  of the text; rows repeated in all four columns count once; null role and text count as empty;
* rows without a conversation id form one conversation with a null id, which
  stays only if no equal one has an id;
* positions are counted over the whole conversation: equal ones match however they are numbered;
* turns without a number, or with one number, are one segment, which one task orders;
* an empty table gives an empty result; only the four named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SEGMENT = 256


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     F.floor(F.coalesce(F.col(turn_col).cast("bigint"), F.lit(-1)) / SEGMENT).alias("part")).withColumns(
        {"h1": F.xxhash64(F.lit(1), "role", "text"), "h2": F.xxhash64(F.lit(2), "text", "role")})


def _in_order():
    return Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "h1", "h2")


def _same(left: str, right: str, *columns: str) -> Column:
    match = F.lit(True)
    for c in columns:
        match = match & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return match


def prefixes(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, depth (turns so far), p1, p2 (rolling hash), last."""
    turns = _turns(df, conv_col, turn_col, role_col, text_col)
    hashed = turns.select("conv_id", "part", "turn", "role", "h1", "h2").distinct()
    placed = hashed.withColumn("place", F.row_number().over(_in_order()))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("conv_id").orderBy("part")
    counts = hashed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"c": F.coalesce(F.sum("n").over(before), F.lit(0)), "final": F.lead("part").over(later).isNull()})
    # The hashes hold the place in the whole conversation, however its turns are numbered.
    mixed = (placed.alias("i").join(counts.alias("p").hint("merge"), _same("i", "p", "conv_id", "part"))
             .select("i.*", (F.col("c") + F.col("place")).alias("depth"),
                     (F.col("final") & (F.col("place") == F.col("n"))).alias("last"))
             .select("conv_id", "part", "depth", "last", F.xxhash64(F.lit(3), "depth", "h1", "h2").alias("g1"),
                     F.xxhash64(F.lit(4), "depth", "h2", "h1").alias("g2")))
    running = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    inner = mixed.select("conv_id", "part", "depth", "last", F.bit_xor("g1").over(running).alias("r1"),
                         F.bit_xor("g2").over(running).alias("r2"))
    parts = mixed.groupBy("conv_id", "part").agg(F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"))
    carried = parts.select("conv_id", "part",
                           *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(c) for x, c in
                             (("x1", "c1"), ("x2", "c2"))])
    return (inner.alias("i").join(carried.alias("p").hint("merge"), _same("i", "p", "conv_id", "part"))
            .select("i.conv_id", "depth", F.col("r1").bitwiseXOR(F.col("c1")).alias("p1"),
                    F.col("r2").bitwiseXOR(F.col("c2")).alias("p2"), "last"))


def maximal(df: DataFrame, **columns: str) -> DataFrame:
    """conv_id of each conversation that no longer one continues, with its depth and number of copies."""
    every = prefixes(df, **columns)
    whole = (every.where("last").groupBy("depth", "p1", "p2")
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")))
    continued = every.where(~F.col("last")).select("depth", "p1", "p2").distinct()
    return whole.join(continued.hint("merge"), ["depth", "p1", "p2"], "left_anti").select("conv_id", "depth", "copies")


def render(df: DataFrame, kept: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The kept conversations as text, in pieces of ``SEGMENT`` turns (the last one fewer).

    One row per piece: conv_id, part (segment of turn numbers in which it begins), piece (from 0 in the
    conversation, by the turns' places, however they are numbered), depth, copies, n_turns, rendered.
    """
    turns = _turns(df, conv_col, turn_col, role_col, text_col)
    rows = turns.alias("t").join(kept.alias("k").hint("merge"), _same("t", "k", "conv_id")).select("t.*", "depth", "copies")
    said = F.struct("turn", "role", "h1", "h2")
    once = rows.withColumn("before", F.lag(said).over(_in_order())).where(~said.eqNullSafe(F.col("before")))
    placed = once.withColumn("place", F.row_number().over(_in_order()))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Counted from the hashes, not from the texts: one narrow pass more, and the texts move once less.
    hashed = turns.select("conv_id", "part", "turn", "role", "h1", "h2").distinct()
    counts = (hashed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("c", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    pieces = (placed.alias("i").join(counts.alias("p").hint("merge"), _same("i", "p", "conv_id", "part"))
              .select("i.*", F.floor((F.col("c") + F.col("place") - 1) / SEGMENT).alias("piece"))
              .groupBy("conv_id", "piece", "depth", "copies")
              .agg(F.min("part").alias("part"),
                   F.array_sort(F.collect_list(F.struct("part", "place", "role", "text"))).alias("turns")))
    line = F.transform("turns", lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("<|end|>\n")))
    return pieces.select("conv_id", "part", "piece", "depth", "copies", F.size("turns").cast("bigint").alias("n_turns"),
                         F.array_join(line, "").alias("rendered"))


def collapse(df: DataFrame, **columns: str) -> DataFrame:
    return render(df, maximal(df, **columns), **columns)
