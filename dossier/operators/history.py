"""History: SCD2, live/history merge, snapshot diff, record filters (H-01..H-06, P-08)."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.operators.pick import dedupe_latest
from dossier.operators.relational import union_by_name

OPEN_END = "9999-12-31"


def row_hash(cols: Sequence[str]) -> Column:
    """SHA-256 of the row as JSON with NULL fields kept.

    ``concat_ws`` skips NULLs, so ('a', NULL, 'b') and ('a', 'b', NULL)
    would collide; JSON with explicit nulls keeps positions apart.
    """
    j = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
    return F.sha2(j, 256)


def scd2_init(snapshot: DataFrame, cols: Sequence[str], load_date: dt.date) -> DataFrame:
    """First snapshot: every distinct row open from ``load_date``."""
    return (snapshot.select(*cols).withColumn("row_hash", row_hash(cols))
            .dropDuplicates(["row_hash"])
            .withColumn("start_date", F.lit(load_date.isoformat()).cast("date"))
            .withColumn("end_date", F.lit(OPEN_END).cast("date"))
            .withColumn("is_active", F.lit("Y")))


def scd2_merge(target: DataFrame, snapshot: DataFrame, cols: Sequence[str],
               load_date: dt.date) -> DataFrame:
    """H-01: merge one snapshot into an SCD2 table keyed by the row hash.

    * active row whose hash is in the snapshot: unchanged;
    * active row whose hash is absent: closed (end = load date, 'N');
    * snapshot hash not active: inserted open from the load date.
    One full outer join of the active rows and the snapshot on the hash.
    """
    d = F.lit(load_date.isoformat()).cast("date")
    active = target.where(F.col("is_active") == "Y")
    history = target.where(F.col("is_active") != "Y")
    src = (snapshot.select(*cols).withColumn("row_hash", row_hash(cols)).dropDuplicates(["row_hash"])
           .select(*[F.col(c).alias(f"__s_{c}") for c in cols], F.col("row_hash").alias("__s_hash")))
    j = active.join(src, F.col("row_hash") == F.col("__s_hash"), "full")
    in_t, in_s = F.col("row_hash").isNotNull(), F.col("__s_hash").isNotNull()
    out = j.select(
        *[F.coalesce(F.col(c), F.col(f"__s_{c}")).alias(c) for c in cols],
        F.coalesce("row_hash", "__s_hash").alias("row_hash"),
        F.when(in_t, F.col("start_date")).otherwise(d).alias("start_date"),
        F.when(in_t & ~in_s, d).when(in_t, F.col("end_date")).otherwise(F.lit(OPEN_END).cast("date"))
        .alias("end_date"),
        F.when(in_t & ~in_s, F.lit("N")).otherwise(F.lit("Y")).alias("is_active"))
    # a changed row: business columns come from whichever side exists; for
    # rows present on both sides they are identical (same hash)
    return history.unionByName(out)


def scd2_replay(snapshots: DataFrame, cols: Sequence[str], date_col: str) -> DataFrame:
    """H-02: SCD2 table equal to folding H-01 over every dated snapshot, in one pass.

    A row version is open for each run of consecutive snapshots containing
    its hash; it starts at the run's first snapshot date and is closed at
    the date of the first snapshot after the run (open if the run reaches
    the newest snapshot).  Runs are found with the classic
    ``index - row_number`` trick; no loop over dates, no self join per step.
    """
    h = (snapshots.select(*cols, F.col(date_col).alias("__d"))
         .withColumn("row_hash", row_hash(cols)).dropDuplicates(["row_hash", "__d"]))
    dates = snapshots.select(F.col(date_col).alias("__d")).distinct()
    # one row per snapshot date: the number of loads, not of rows
    idx = dates.withColumn("__i", F.dense_rank().over(Window.orderBy("__d")))
    h = h.join(idx, "__d")
    run = F.col("__i") - F.row_number().over(Window.partitionBy("row_hash").orderBy("__i"))
    g = (h.withColumn("__run", run).groupBy("row_hash", "__run")
         .agg(*[F.first(c).alias(c) for c in cols], F.min("__d").alias("start_date"),
              F.max("__i").alias("__last")))
    nxt = idx.select((F.col("__i") - 1).alias("__last"), F.col("__d").alias("__next"))
    g = g.join(nxt, "__last", "left")
    return g.select(*cols, "row_hash", "start_date",
                    F.coalesce("__next", F.lit(OPEN_END).cast("date")).alias("end_date"),
                    F.when(F.col("__next").isNull(), "Y").otherwise("N").alias("is_active"))


def merge_live_history(live: DataFrame | None, history: DataFrame | None, keys: Sequence[str],
                       order: Sequence[Column] = ()) -> DataFrame:
    """H-03: live rows win over history rows of the same key; either side may be missing."""
    frames = []
    if live is not None:
        frames.append(live.withColumn("__src", F.lit(0)))
    if history is not None:
        frames.append(history.withColumn("__src", F.lit(1)))
    if not frames:
        raise ValueError("neither live nor history table present")
    u = union_by_name(*frames)
    return dedupe_latest(u, keys, [F.col("__src"), *order]).drop("__src")


def history_window(df: DataFrame, date_col: str, requested: dt.date, cutoff: dt.date,
                   hist_start: dt.date, ongoing_start: dt.date) -> DataFrame:
    """H-04: rows created in [hist_start, requested] (up to the cutoff), or after the cutoff
    the historical range plus the live range [ongoing_start, requested - 1], as one filter."""
    c = F.to_date(F.col(date_col))

    def between(a: dt.date, b: dt.date) -> Column:
        return (c >= F.lit(a.isoformat()).cast("date")) & (c <= F.lit(b.isoformat()).cast("date"))
    if requested <= cutoff:
        return df.where(between(hist_start, requested))
    t1 = requested - dt.timedelta(days=1)
    live_end = t1 if t1 >= ongoing_start else ongoing_start
    return df.where(between(hist_start, cutoff) | between(ongoing_start, live_end))


def active_records(df: DataFrame, status_col: str, excluded: Sequence[str],
                   hub_col: str | None = None, source_col: str | None = None,
                   allowed_sources: Sequence[str] = (), default_status: str = "AC") -> DataFrame:
    """H-05: hub flag = 1, NULL status defaulted, allowed sources, excluded statuses dropped."""
    out = df
    if hub_col:
        out = out.where(F.col(hub_col) == 1)
    out = out.withColumn(status_col, F.coalesce(F.col(status_col), F.lit(default_status)))
    cond = ~F.col(status_col).isin(*excluded)
    if source_col and allowed_sources:
        cond = cond & F.col(source_col).isin(*allowed_sources)
    return out.where(cond)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str],
                  cols: Sequence[str]) -> DataFrame:
    """H-06: rows new / deleted / changed between two snapshots (unchanged rows dropped).

    Null-safe comparison per column: a NULL <-> value change counts.
    Returns keys, ``change_type`` and the new values (old values for deletes),
    plus ``in_upsert`` (new or changed).
    """
    o = old.select(*keys, *[F.col(c).alias(f"__o_{c}") for c in cols], F.lit(True).alias("__in_o"))
    n = new.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in cols], F.lit(True).alias("__in_n"))
    j = o.join(n, list(keys), "full")
    changed = reduce(lambda a, b: a | b, [~F.col(f"__o_{c}").eqNullSafe(F.col(f"__n_{c}")) for c in cols])
    kind = (F.when(F.col("__in_o").isNull(), "new").when(F.col("__in_n").isNull(), "deleted")
            .when(changed, "changed"))
    out = j.withColumn("change_type", kind).where(F.col("change_type").isNotNull())
    return out.select(*keys, "change_type",
                      *[F.when(F.col("__in_n").isNull(), F.col(f"__o_{c}")).otherwise(F.col(f"__n_{c}"))
                        .alias(c) for c in cols],
                      F.col("change_type").isin("new", "changed").alias("in_upsert"))
