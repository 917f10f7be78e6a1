"""The lifecycle building blocks in generic form: any key, any order, any predicate.

Skew rules followed here:

* first / last row per key is an aggregate (``min_by`` / ``max_by`` on a struct),
  so a key holding a third of all rows is reduced inside every map task before
  the shuffle;
* "first row including ties" is an aggregate of the minimum joined back on
  (key, minimum); the join is an equi-join that AQE's skew-join handling splits
  when one (key, minimum) is hot;
* deduplication is a partial aggregate before its exchange.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlife.session import scratch_path


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


# --- cleaning -------------------------------------------------------------------

def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicate rows removed (or duplicates on ``subset``)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def drop_adjacent(df: DataFrame, order: Sequence[str], compare: Sequence[str] | None = None,
                  small_keys: Sequence[str] | None = None) -> DataFrame:
    """Rows that differ in some ``compare`` column (all, if not given) from the row before them in the order of
    ``order``: of each run of neighbours that are alike the first stays, copies further apart stay too.

    ``order`` must leave no tie between rows that differ (nulls come first).  The whole table is one
    order: rows are range-partitioned and written as sorted runs (``sorted_runs``, when this is called), each task
    compacts its run, and the first row of a run is judged by the last one of the run before it, so
    that no key and no spell of copies has to fit in one task.
    With ``small_keys``, leading columns of ``order`` that ``compare`` holds too and whose groups the caller knows to
    be small, one window per key does the same in a single shuffle.
    """
    compare, alike = list(compare or df.columns), "_alike"
    by = [F.col(c).asc_nulls_first() for c in order]
    row = F.struct(*compare)
    if small_keys:
        assert list(order[:len(small_keys)]) == list(small_keys) and set(small_keys) <= set(compare)
        before = F.lag(row).over(Window.partitionBy(*small_keys).orderBy(*by))
        return df.select("*", before.eqNullSafe(row).alias(alike)).where(~F.col(alike)).drop(alike)
    # The last column tells copies apart, so that a spell of them can be cut into several runs.
    runs = sorted_runs(df.withColumn("_copy", F.monotonically_increasing_id()), [*order, "_copy"])
    within = Window.partitionBy("_run").orderBy("_place")
    judged = runs.select("*", F.row_number().over(within).alias("_n"), F.lag(row).over(within).eqNullSafe(row).alias(alike))
    lasts = runs.groupBy("_run").agg(F.max_by(row, "_place").alias("_row"))      # one row per run
    borders = lasts.select(F.lead("_run").over(Window.orderBy("_run")).alias("_run"), F.col("_row").alias("_border"))
    first = F.col("_n") == 1
    seen = F.when(first, F.col("_border").eqNullSafe(row)).otherwise(F.col(alike))
    return (judged.join(borders.where(F.col("_run").isNotNull()), "_run", "left")
            .where(~seen).select(*df.columns))


def drop_null_key(df: DataFrame, keys) -> DataFrame:
    return df.na.drop(how="any", subset=_cols(keys))


# --- first / last row -----------------------------------------------------------

def first_row(df: DataFrame, key, order, cond: Column | None = None,
              last: bool = False) -> DataFrame:
    """One row per key: the lowest (or highest) row by ``order`` among rows meeting
    ``cond``; keys without such a row are absent.  ``order`` must be a total order
    within the key (add a unique column as the last tie-breaker)."""
    keys, order = _cols(key), _cols(order)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*order)
    if cond is not None:
        ordering = F.when(cond, ordering)
    pick = F.max_by if last else F.min_by
    agg = df.groupBy(*keys).agg(pick(F.struct(*rest), ordering).alias("_r"))
    return agg.where(F.col("_r").isNotNull()).select(*keys, "_r.*")


def first_rows_with_ties(df: DataFrame, key, order_col: Column | str,
                         name: str = "_first") -> DataFrame:
    """Every row whose ``order_col`` equals its key's minimum (ties kept)."""
    keys = _cols(key)
    o = F.col(order_col) if isinstance(order_col, str) else order_col
    tagged = df.withColumn(name, o)
    mins = tagged.groupBy(*keys).agg(F.min(name).alias(name))
    return tagged.join(mins, keys + [name], "inner").select(*df.columns)


def row_number_first(df: DataFrame, key, order: Sequence[Column], n: int = 1) -> DataFrame:
    """``row_number() <= n`` form of first rows.  Catalyst plans a partial
    WindowGroupLimit before the exchange, so each map task forwards at most n
    rows per key."""
    w = Window.partitionBy(*_cols(key)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


# --- conditional first values per bucket ----------------------------------------

def first_by_bucket(df: DataFrame, key, order, bucket_col: str, buckets: Iterable[str],
                    value: str, prefix: str = "first_") -> DataFrame:
    """One row per key, one column per bucket: ``value`` of the key's first row in
    that bucket (NULL if the key never enters it).  One aggregate, no self-joins."""
    ordering = F.struct(*_cols(order))
    aggs = [F.min_by(F.col(value), F.when(F.col(bucket_col) == b, ordering)).alias(f"{prefix}{b}")
            for b in buckets]
    return df.groupBy(*_cols(key)).agg(*aggs)


# --- lags ----------------------------------------------------------------------

def lags_one_window(df: DataFrame, key, order: Sequence[Column],
                    lags: dict[str, tuple[str, int]], rn: str = "rn") -> DataFrame:
    """``rn`` (row order within the key) and lag columns name → (column, offset) over
    one window per key.  A key's rows meet in one task: only for callers that
    know every key to be small."""
    w = Window.partitionBy(*_cols(key)).orderBy(*order)
    return df.select("*", F.row_number().over(w).alias(rn),
                     *[F.lag(c, k).over(w).alias(n) for n, (c, k) in lags.items()])


# Group of a key whose rows all lie in this one group, for ``lags_split`` of dealt rows.
WHOLE = -(2 ** 63) + 1


def lags_split(df: DataFrame, key: str, group: Column, order: Sequence[Column],
               lags: dict[str, tuple[str, int]], rn: str = "rn", keep: str | None = None, dealt: str | None = None) -> DataFrame:
    """Same rows as ``lags_one_window`` without a window over a whole key.

    ``group`` (an integer or date expression) must not decrease along ``order``:
    the year of a monthly panel, the month of an event stream; NULL comes first.
    Within each (key, group) a window gives the in-group order and lags; a
    summary of the groups (row count, last row, second-to-last row) is windowed
    per key, which adds the row offset and the lags that reach into earlier
    groups.  Only the summary, one row per key and group, is shuffled again.
    Offsets 1 and 2.  Rows without a key are one group.  ``keep`` names a column
    for the group; the result stays partitioned and sorted by (key, group).
    ``dealt`` names a column that holds the group (long) of rows that lie dealt by key and group already, which saves the
    shuffle; the group ``WHOLE`` has all rows of its key, so that no summary is made of it.
    """
    assert all(k in (1, 2) for _, k in lags.values())
    if dealt:
        return _lags_of_dealt(df.withColumnRenamed(dealt, "_g"), [c for c in df.columns if c != dealt], key, order, lags, rn, keep,
                              F.col("_g") != WHOLE)
    keyed = df.withColumn("_g", group)
    as_long = F.unix_date(F.col("_g")) if dict(keyed.dtypes)["_g"] == "date" else F.col("_g").cast("long")
    first = F.lit(-(2 ** 63)).cast("long")
    keyed = keyed.withColumn("_g", F.when(F.col(key).isNotNull(), F.coalesce(as_long, first)).otherwise(first))
    # Dealt by both columns: an input that is already clustered by the key would keep a whole key in one task.
    return _lags_of_dealt(keyed.repartition(key, "_g"), df.columns, key, order, lags, rn, keep)


def _lags_of_dealt(keyed: DataFrame, columns: list[str], key: str, order: Sequence[Column], lags: dict[str, tuple[str, int]],
                   rn: str, keep: str | None, summed: Column | None = None) -> DataFrame:
    """``lags_split`` of rows dealt by ``key`` and ``_g``; ``summed``: groups with others beside them."""
    wg = Window.partitionBy(key, "_g").orderBy(*order)
    x = keyed.select(
        "*", F.row_number().over(wg).alias("_rg"),
        F.lead(F.lit(1), 1).over(wg).alias("_n1"), F.lead(F.lit(1), 2).over(wg).alias("_n2"),
        *[F.lag(c, k).over(wg).alias(f"_g{n}") for n, (c, k) in lags.items()])
    one_back = list(dict.fromkeys(c for c, _ in lags.values()))
    two_back = list(dict.fromkeys(c for c, k in lags.values() if k == 2)) or one_back[:1]
    summary = (x if summed is None else x.where(summed)).groupBy(key, "_g").agg(
        F.count(F.lit(1)).alias("_cnt"),
        F.max_by(F.struct(*one_back), F.when(F.col("_n1").isNull(), F.col("_rg"))).alias("_last"),
        F.max_by(F.struct(*two_back), F.when(F.col("_n1").isNotNull() & F.col("_n2").isNull(),
                                             F.col("_rg"))).alias("_second"))
    ws = Window.partitionBy(key).orderBy("_g")
    bounds = summary.select(
        key, "_g",
        F.lag("_last", 1).over(ws).alias("_p_last"),
        F.lag("_second", 1).over(ws).alias("_p_second"),
        F.lag("_cnt", 1).over(ws).alias("_p_cnt"),
        F.lag("_last", 2).over(ws).alias("_pp_last"),
        F.coalesce(F.sum("_cnt").over(ws.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"))
    # Plain keys on both sides keep the partitioning; rows without a key have no earlier group to look up.
    # The size of rows made by a generator is underestimated: a broadcast of what comes from them is never asked for.
    j = x.alias("x").join(bounds.hint("merge").alias("b"), (F.col(f"x.{key}") == F.col(f"b.{key}"))
                          & (F.col("x._g") == F.col("b._g")), "left")
    rg = F.col("_rg")
    out = []
    for n, (c, k) in lags.items():
        inner = F.col(f"_g{n}")
        if k == 1:
            out.append(F.when(rg > 1, inner).otherwise(F.col("_p_last")[c]).alias(n))
        else:
            before = F.when(F.col("_p_cnt") >= 2, F.col("_p_second")[c]).otherwise(F.col("_pp_last")[c])
            out.append(F.when(rg > 2, inner).when(rg == 2, F.col("_p_last")[c]).otherwise(before).alias(n))
    group_col = [F.col("x._g").alias(keep)] if keep else []
    return j.select(*[F.col(f"x.{c}") for c in columns], *group_col,
                    (F.coalesce("_offset", F.lit(0)) + rg).cast("int").alias(rn), *out)


def sorted_runs(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The table in sorted runs, one for each task: range-partitioned by ``order`` (nulls first), sorted, and
    written to the shared scratch folder when this is called.  ``_place`` rises along the whole order, ``_run``
    is the task that wrote the row.  A spell of equal ``order`` values is one run.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    path = scratch_path(df.sparkSession, "runs")
    (df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id())
     .write.parquet(path))
    return df.sparkSession.read.parquet(path).withColumn("_run", F.shiftright("_place", 33))


def lags_runs(df: DataFrame, key: str, order: Sequence[str], lags: dict[str, tuple[str, int]], rn: str = "rn") -> DataFrame:
    """Same rows as ``lags_one_window`` whatever a key or a part of it holds: one key, or one month of one key,
    with most of the table is spread over all tasks.

    Rows are range-partitioned by key and ``order`` (columns, a total order within the key), so that
    each task has one sorted run of the whole; the runs are written, with every row's run and place,
    to the shared scratch folder when this is called.  Within a run a window gives the lags; what lies before a
    run comes from the border rows of the runs before it (``lags_split`` with the run as the group).
    """
    at = "_run_place"
    runs = sorted_runs(df, [key, *order]).withColumn(at, F.col("_place")).drop("_run", "_place")
    # The high bits are the run, the low ones the place in it.
    return lags_split(runs, key, F.shiftright(at, 33), [F.col(at)], lags, rn).drop(at)


def with_lags(df: DataFrame, key: str, order: Sequence[Column], lags: dict[str, tuple[str, int]],
              group: Column) -> DataFrame:
    """Add lag columns name → (column, offset); see ``lags_split`` for ``group``."""
    return lags_split(df, key, group, order, lags, rn="_rn").drop("_rn")


# --- joins ---------------------------------------------------------------------

# Bits of a key filter: for each expected key, and at most (in words of 64), which bounds what is broadcast.
KEY_BITS, MOST_WORDS = 16, 1 << 20


def likely_flagged(df: DataFrame, key, cond: Column, expected: int = 1 << 20) -> DataFrame:
    """Rows whose key may have a row meeting ``cond``: all that have one, and few others.

    A Bloom filter with one hash: every flagged key sets one of ``KEY_BITS`` bits for each key expected.  The
    filter is an aggregate (``bit_or`` per word, combined on the map side) of ``MOST_WORDS`` words at most, whatever the
    data, so that it may be broadcast; rows are tested where they are, without a shuffle.  With
    more flagged keys than expected it lets more rows through, never fewer.
    """
    words = min(MOST_WORDS, 1 << max(0, (expected * KEY_BITS // 64 - 1).bit_length()))
    at = F.pmod(F.xxhash64(*_cols(key)), F.lit(words * 64).cast("bigint"))
    word, bit = F.shiftright(at, 6), at.bitwiseAND(F.lit(63)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    filled = df.where(cond).groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_mask"))
    is_set = F.call_function("shiftrightunsigned", F.col("_mask"), F.col("_bit")).bitwiseAND(F.lit(1)) == 1
    # A semi join: below an inner one the optimizer would put the exact semi join that follows first.
    return df.withColumns({"_at": word, "_bit": bit}).join(
        F.broadcast(filled), (F.col("_at") == F.col("_word")) & is_set, "left_semi").select(*df.columns)


def keys_flagged(df: DataFrame, key, cond: Column, expected: int = 1 << 20) -> DataFrame:
    """All rows of keys that have at least one row meeting ``cond``.

    An exact semi join behind ``likely_flagged``: rows of other keys mostly never reach the shuffle.
    """
    keys = _cols(key)
    flagged = df.where(cond).select(*keys).distinct()
    return likely_flagged(df, key, cond, expected).join(flagged, keys, "left_semi")


def enrich(left: DataFrame, key, right: DataFrame, right_key, aggs: Sequence[Column]) -> DataFrame:
    """``left`` with per-key aggregates of ``right``: a chain of left joins to
    separately aggregated tables, written as one groupBy of (conditional)
    aggregates and a single left join."""
    lk, rk = _cols(key), _cols(right_key)
    agg = right.groupBy(*rk).agg(*aggs)
    if lk != rk:
        agg = agg.select(*[F.col(r).alias(l) for l, r in zip(lk, rk)],
                         *[c for c in agg.columns if c not in rk])
    return left.join(agg, lk, "left")


# --- set operations ------------------------------------------------------------

def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).dropDuplicates()


def union_of_filters(df: DataFrame, conds: Sequence[Column], distinct: bool = False) -> DataFrame:
    """``df.where(c1) UNION ALL df.where(c2) ...`` in one pass over ``df``.

    A union of filtered views of one relation would compute that relation once
    per branch; here every row is emitted once per branch it satisfies (an
    ``explode`` of the matching branch tags), which is the same bag.  With
    ``distinct`` the copies are then removed (UNION).
    """
    tags = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(i)) for i, c in enumerate(conds)])
    out = df.select("*", F.explode(F.array_compact(tags)).alias("_branch")).drop("_branch")
    return out.dropDuplicates() if distinct else out
