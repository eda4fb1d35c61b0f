"""Window-based picks and per-row context (W-01..W-20, A-10, A-13, A-14, A-18).

Every pick takes a total order (business keys, then the remaining columns)
so results do not depend on task scheduling.  Filters on ``row_number`` /
``rank`` are written as ``<= n`` so Spark inserts a partial
``WindowGroupLimit`` before the shuffle: a hot key is cut to n rows in every
map task instead of arriving whole at one reducer.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.operators.ordered import CHUNK, Order, add_chunks, ordered_scan


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def total_order(df: DataFrame, order: Sequence[Column], exclude: Sequence[str] = ()) -> list[Column]:
    """``order`` followed by every other column ascending (deterministic tie-break)."""
    return list(order) + [F.col(c).asc_nulls_last() for c in df.columns if c not in exclude]


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  n: int = 1) -> DataFrame:
    """W-01 / W-02 / W-15: the first ``n`` rows per key by ``order`` (full-row tie-break)."""
    w = Window.partitionBy(*keys).orderBy(*total_order(df, order, keys))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def rank_keep_ties(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """W-03: ``rank() = 1`` keeps every row tied for first."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rk", F.rank().over(w)).where(F.col("__rk") <= 1).drop("__rk")


def with_key_aggregates(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Per-key aggregates on every row (``agg() OVER (PARTITION BY keys)``) without a window.

    A hash aggregate (partial, map-side) joined back on the key, NULL-safe;
    a hot key is reduced before its shuffle, and the join back is a
    many-to-one join AQE can split or broadcast.
    """
    a = df.groupBy(*[F.col(k).alias(f"__g_{k}") for k in keys]).agg(*aggs)
    cond = reduce(lambda x, y: x & y, [df[k].eqNullSafe(a[f"__g_{k}"]) for k in keys])
    return df.join(a, cond, "left").drop(*[f"__g_{k}" for k in keys])


def gaps_and_islands(df: DataFrame, keys: Sequence[str], start: str, end: str,
                     max_gap_days: int) -> DataFrame:
    """W-12: merge intervals whose gap to the running end is at most ``max_gap_days``.

    A new island starts when the start is more than the gap after the
    latest end seen so far (running max, so nested intervals merge too).
    Both running passes are ordered scans (a hot key is split over tasks);
    the second reuses the first one's chunks.
    """
    order = [start, end]
    x = ordered_scan(df, keys, order, {"__pe": ("max_before", end)}, keep_chunk=True)
    flag = F.when(F.col("__pe").isNull() | (F.datediff(F.col(start), F.col("__pe")) > max_gap_days), 1) \
        .otherwise(0)
    # identical intervals tie; the pass-1 flag orders them so both passes agree
    x = ordered_scan(x.withColumn("__new", flag), keys, [*order, ("__new", False)],
                     {"island": ("sum", "__new")}, chunk_col=CHUNK)
    return x.groupBy(*keys, "island").agg(
        F.min(start).alias("island_start"), F.max(end).alias("island_end"),
        F.count(F.lit(1)).alias("n_items"))


def state_transitions(df: DataFrame, keys: Sequence[str], order: Sequence[Order], state: str,
                      from_state: str, to_state: str) -> DataFrame:
    """W-17: number of direct ``from_state -> to_state`` changes per key (LAG over a chunked scan)."""
    x = ordered_scan(df, keys, order, {"__prev": ("lag", state)})
    hit = ((F.col("__prev") == from_state) & (F.col(state) == to_state)).cast("int")
    return x.withColumn("__t", hit).groupBy(*keys).agg(F.sum("__t").cast("bigint").alias("n_transitions"))


def nearest_in_time(left: DataFrame, right: DataFrame, key: str, left_date: str, right_date: str,
                    left_id: str, right_id: str) -> DataFrame:
    """W-19: per left row the right row of the same key nearest in days.

    Ties: smaller day difference, then the earlier right date, then the
    smaller right id.  Instead of joining every left row to every right row
    of its key (all pairs within a key), both sides are stacked and two
    chunked ordered scans carry the last right row on or before each left
    day and the first right row on or after it; the better of the two is
    kept.  Work is a sort, split across tasks even for a hot key.

    Returns the left columns plus ``<right_id>``, ``<right_date>`` (as the
    right row's date) and ``day_diff``; left rows with no right row of their
    key are dropped (inner semantics).
    """
    lcols = left.columns
    L = left.select(F.col(key).alias("__k"), F.to_date(F.col(left_date)).alias("__d"),
                    F.lit(1).alias("__side"), F.lit(None).cast(right.schema[right_id].dataType).alias("__rid"),
                    F.struct(*[F.col(c) for c in lcols]).alias("__l"))
    R = right.select(F.col(key).alias("__k"), F.to_date(F.col(right_date)).alias("__d"),
                     F.lit(0).alias("__side"), F.col(right_id).alias("__rid"),
                     F.lit(None).cast(L.schema["__l"].dataType).alias("__l"))
    u = L.unionByName(R)
    u = u.withColumn("__cand", F.when(F.col("__side") == 0,
                                      F.struct(F.col("__d").alias("d"), F.col("__rid").alias("id"))))
    # both scans order by day first: one chunking on (key, day) serves both
    u = add_chunks(u, ["__k"], ["__d"])
    # previous: right rows of the same day sort before the left row; among
    # equal days the smallest id is the last one seen
    u = ordered_scan(u, ["__k"], ["__d", "__side", ("__rid", False)],
                     {"__prev": ("last_nonnull", "__cand")}, chunk_col=CHUNK)
    # next: right rows of the same day sort after the left row, smallest id first
    u = ordered_scan(u, ["__k"], ["__d", ("__side", False), ("__rid", True, False)],
                     {"__next": ("next_nonnull", "__cand")}, chunk_col=CHUNK).where(F.col("__side") == 1)
    dp = F.datediff(F.col("__d"), F.col("__prev.d"))
    dn = F.datediff(F.col("__next.d"), F.col("__d"))
    take_prev = F.col("__next").isNull() | (F.col("__prev").isNotNull() & (dp <= dn))
    best = F.when(take_prev, F.col("__prev")).otherwise(F.col("__next"))
    out = u.where(F.col("__prev").isNotNull() | F.col("__next").isNotNull()).select(
        *[F.col("__l").getField(c).alias(c) for c in lcols],
        best.getField("id").alias(right_id), best.getField("d").alias(right_date),
        F.when(take_prev, dp).otherwise(dn).alias("day_diff"))
    return out


def global_extreme(df: DataFrame, col: str, name: str, fn=F.max) -> DataFrame:
    """W-20: an aggregate over the whole result on every row.

    ``MAX(x) OVER ()`` would move every row into one task; a scalar
    subquery (partial aggregates, one value) keeps the work spread out.
    """
    return df.withColumn(name, df.agg(fn(col)).scalar())


def ratio_class(df: DataFrame, keys: Sequence[str], subset: Column, when_all: str,
                otherwise: str, name: str = "class") -> DataFrame:
    """A-13: ``when_all`` if every row of the key satisfies ``subset`` (one aggregate)."""
    return df.groupBy(*keys).agg(
        F.when(F.count(F.when(subset, 1)) == F.count(F.lit(1)), F.lit(when_all))
        .otherwise(F.lit(otherwise)).alias(name))


def zero_fill_groups(expected: DataFrame, counts: DataFrame, keys: Sequence[str],
                     count_cols: Sequence[str]) -> DataFrame:
    """A-14: expected groups without rows get a count of 0."""
    j = expected.join(counts, list(keys), "left")
    return j.select(*[F.col(c) for c in expected.columns],
                    *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in count_cols])


def indicator_count(flags: Sequence[Column]) -> Column:
    """A-18: number of true indicators in a row."""
    return reduce(lambda a, b: a + b, [F.coalesce(f.cast("int"), F.lit(0)) for f in flags])


def priority_rank(col: str, patterns: Sequence[str], default: int) -> Column:
    """W-14: 1-based rank of the first LIKE pattern the lower-cased value matches."""
    x = F.lower(F.col(col))
    expr = None
    for i, p in enumerate(patterns, start=1):
        expr = F.when(x.like(p), F.lit(i)) if expr is None else expr.when(x.like(p), F.lit(i))
    return expr.otherwise(F.lit(default))


def resolve_single_latest(df: DataFrame, key: str, flag: str, order: Sequence[Order],
                          out: str | None = None) -> DataFrame:
    """W-16: for keys with more than one flagged row keep the flag on the best one only.

    ``count(flag)`` per key is an aggregate joined back; the best flagged
    row is the first of a chunked ordered scan (flagged rows first, then
    ``order``), so a hot key never sits in one task.
    """
    out = out or flag
    flagged = F.col(flag) == F.lit(True)
    x = df.withColumn("__fo", F.when(flagged, 0).otherwise(1))
    x = ordered_scan(x, [key], ["__fo", *order], {"__rn": ("row_number",)})
    x = with_key_aggregates(x, [key], [F.count(F.when(F.col(flag) == F.lit(True), 1)).alias("__nflag")])
    res = F.when(F.col("__nflag") <= 1, F.col(flag)).otherwise(flagged & (F.col("__rn") == 1))
    return x.withColumn(out, res).drop("__fo", "__rn", "__nflag")
