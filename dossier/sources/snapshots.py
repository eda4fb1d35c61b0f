"""Dated snapshots: choose, read and guard (S-02..S-10, S-17..S-21).

Layout: ``<root>/<object>/<version>/load_date=yyyy-MM-dd/part-*.parquet``.
``load_date`` is a real partition column, so a filter on it prunes whole
directories before any file is opened (``PartitionFilters`` in the plan).
Folder listings go through Hadoop's FileSystem API on the driver: they
touch metadata only, never rows.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.operators.pick import dedupe_latest

PART_COL = "load_date"
_PART_RE = re.compile(rf"^{PART_COL}=(\d{{4}}-\d{{2}}-\d{{2}})$")


@dataclass(frozen=True)
class SnapshotRef:
    object: str
    version: str
    load_date: dt.date


class SnapshotError(RuntimeError):
    pass


# ------------------------------------------------------------------ listing

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that this program wrote, if it exists."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_load_dates(spark: SparkSession, path: str) -> list[dt.date]:
    """Partition dates present under a version folder, ascending."""
    out = []
    for name in list_dirs(spark, path):
        m = _PART_RE.match(name)
        if m:
            out.append(dt.date.fromisoformat(m.group(1)))
    return sorted(out)


def resolve_version(versions: Iterable[str], obj: str, pinned: str | None = None,
                    mapping: dict[str, str] | None = None) -> str:
    """S-04: pinned version, else the source's mapping, else the max numeric folder.

    A source that has a mapping (see ``version_map``) must name the object: an object that is
    absent from it raises, it does not fall through to the highest folder.
    """
    vs = [v for v in versions if v.isdigit()]
    if pinned is not None:
        if pinned not in vs:
            raise SnapshotError(f"version {pinned} of {obj} not found")
        return pinned
    if mapping is not None:
        if obj not in mapping:
            raise SnapshotError(f"{obj} not found in the version mapping of its source")
        if mapping[obj] not in vs:
            raise SnapshotError(f"mapped version {mapping[obj]} of {obj} not found")
        return mapping[obj]
    if not vs:
        raise SnapshotError(f"no numeric version folder for {obj}")
    return max(vs, key=int)


def version_map(by_source: dict[str, dict[str, Sequence[str]]], source: str) -> dict[str, str] | None:
    """S-04: object -> version of one source, from source -> version -> objects; None if the source has none.

    An object listed under several versions has the first of them.
    """
    if source not in by_source:
        return None
    out: dict[str, str] = {}
    for version, objects in by_source[source].items():
        for obj in objects:
            out.setdefault(obj, version)
    return out


def _version_path(spark, root, obj, version, mapping=None) -> str:
    base = f"{root.rstrip('/')}/{obj}"
    v = resolve_version(list_dirs(spark, base), obj, version, mapping)
    return f"{base}/{v}"


def read_partitions(spark: SparkSession, vpath: str, dates: Sequence[dt.date]) -> DataFrame:
    """Read the version folder with ``load_date`` as a partition column, pruned to ``dates``."""
    df = spark.read.option("basePath", vpath).parquet(vpath)
    lits = [F.lit(d.isoformat()).cast("date") for d in dates]
    return df.where(F.col(PART_COL).isin(*lits)) if lits else df.where(F.lit(False))


# ---------------------------------------------------------------- selection

def scan_latest_snapshot(spark: SparkSession, root: str, obj: str, version: str | None = None,
                         mapping: dict[str, str] | None = None, as_of: dt.date | None = None,
                         max_age_days: int | None = None) -> DataFrame:
    """S-02 (+S-08): highest numeric version, then its newest load date."""
    vpath = _version_path(spark, root, obj, version, mapping)
    dates = list_load_dates(spark, vpath)
    if not dates:
        raise SnapshotError(f"no snapshot under {vpath}")
    latest = dates[-1]
    if as_of is not None and max_age_days is not None:
        freshness_check(latest, as_of, max_age_days, obj)
    return read_partitions(spark, vpath, [latest])


def scan_exact_snapshot(spark: SparkSession, root: str, obj: str, load_date: dt.date,
                        version: str | None = None, allow_previous_day: bool = False) -> DataFrame:
    """S-03: the partition of exactly ``load_date``; optionally T-1; else raise."""
    vpath = _version_path(spark, root, obj, version)
    dates = set(list_load_dates(spark, vpath))
    if load_date in dates:
        return read_partitions(spark, vpath, [load_date])
    prev = load_date - dt.timedelta(days=1)
    if allow_previous_day and prev in dates:
        return read_partitions(spark, vpath, [prev])
    raise SnapshotError(f"no partition {load_date} for {obj}")


def scan_asof_snapshot(spark: SparkSession, root: str, obj: str, as_of: dt.date,
                       max_age_days: int | None = None, version: str | None = None) -> DataFrame:
    """S-05: latest partition on or before ``as_of``, with a staleness limit."""
    vpath = _version_path(spark, root, obj, version)
    valid = [d for d in list_load_dates(spark, vpath) if d <= as_of]
    if not valid:
        raise SnapshotError(f"no partition of {obj} on or before {as_of}")
    if max_age_days is not None:
        freshness_check(valid[-1], as_of, max_age_days, obj)
    return read_partitions(spark, vpath, [valid[-1]])


def scan_snapshot_range(spark: SparkSession, root: str, obj: str, start: dt.date, as_of: dt.date,
                        keys: Sequence[str], max_age_days: int | None = None,
                        version: str | None = None) -> DataFrame:
    """S-06: partitions in [start, as_of - 1], newest row per key (W-01 on load_date)."""
    vpath = _version_path(spark, root, obj, version)
    end = as_of - dt.timedelta(days=1)
    dates = [d for d in list_load_dates(spark, vpath) if start <= d <= end]
    if not dates:
        raise SnapshotError(f"no partition of {obj} in [{start}, {end}]")
    if max_age_days is not None:
        freshness_check(dates[-1], as_of, max_age_days, obj)
    df = read_partitions(spark, vpath, dates)
    return dedupe_latest(df, keys, [F.col(PART_COL).desc()])


def scan_all_snapshots(spark: SparkSession, root: str, obj: str, keys: Sequence[str],
                       version: str | None = None) -> DataFrame:
    """S-07: lookup tables — every partition, newest row per key."""
    vpath = _version_path(spark, root, obj, version)
    df = spark.read.option("basePath", vpath).parquet(vpath)
    return dedupe_latest(df, keys, [F.col(PART_COL).desc()])


def freshness_check(newest: dt.date, as_of: dt.date, max_age_days: int, what: str = "") -> int:
    """S-08 on a known date: raise when the newest snapshot is older than the limit."""
    age = (as_of - newest).days
    if age > max_age_days:
        raise SnapshotError(f"{what}: newest data is {age} days old (limit {max_age_days})")
    return age


def freshness_guard(df: DataFrame, date_col: str, as_of: dt.date, max_age_days: int) -> DataFrame:
    """S-08 on data: one-row frame (newest date, age in days); raises in-plan when too old.

    The check is an expression (``raise_error``) evaluated by the aggregate,
    so it costs no extra job and fails the job that consumes it.
    """
    newest = F.max(F.to_date(F.col(date_col)))
    age = F.datediff(F.lit(as_of.isoformat()).cast("date"), newest)
    agg = df.agg(newest.alias("newest_date"), age.alias("age_days"))
    guard = F.when(F.col("age_days") > max_age_days,
                   F.raise_error(F.concat(F.lit("stale data: "), F.col("age_days").cast("string"),
                                          F.lit(" days old")))).otherwise(F.lit(True))
    return agg.where(guard)


def empty_like(df: DataFrame) -> DataFrame:
    """S-09: same schema, zero rows (folds to an empty relation, no scan)."""
    return df.where(F.lit(False))


def partition_from_path(col_name: str = PART_COL, pattern: str = r"load_date=(\d{4}-\d{2}-\d{2})") -> Column:
    """S-10: the load date taken from each row's file path (``_metadata.file_path``)."""
    return F.to_date(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)).alias(col_name)


# --------------------------------------------------------- incremental loads

def high_water_mark_load(target: DataFrame, source: DataFrame, keys: Sequence[str],
                         date_col: str = PART_COL) -> DataFrame:
    """S-17: take only source snapshots newer than the target's max date, upsert them in order.

    Folding "upsert each newer snapshot in date order" is the same as: per
    key keep the row from the newest date among target rows and newer
    source rows.  One union and one ranked pick, no driver loop; the high
    water mark is a scalar subquery in the filter.
    """
    hwm = target.agg(F.max(date_col)).scalar()
    newer = source.where(F.col(date_col) > F.coalesce(hwm, F.lit("0001-01-01").cast("date")))
    both = target.unionByName(newer)
    return dedupe_latest(both, keys, [F.col(date_col).desc()])


def missing_dates(df: DataFrame, date_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """S-19 (and S-18 per key): calendar days between min and max minus days present."""
    d = df.select(*keys, F.to_date(F.col(date_col)).alias("__d"))
    span = d.groupBy(*keys).agg(F.min("__d").alias("__lo"), F.max("__d").alias("__hi"))
    cal = span.select(*keys, F.explode(F.sequence("__lo", "__hi", F.expr("INTERVAL 1 DAY")))
                      .alias("missing_date"))
    present = d.select(*keys, F.col("__d").alias("missing_date")).distinct()
    return cal.join(present, [*keys, "missing_date"], "left_anti")


def missing_snapshots(df: DataFrame, date_col: str, keys: Sequence[str]) -> DataFrame:
    """S-18: per object the sorted list of expected-but-absent days."""
    m = missing_dates(df, date_col, keys)
    objs = df.select(*keys).distinct()
    lists = m.groupBy(*keys).agg(F.array_sort(F.collect_list("missing_date")).alias("missing_dates"))
    out = objs.join(lists, list(keys), "left")
    return out.select(*keys, F.coalesce("missing_dates", F.array().cast("array<date>")).alias("missing_dates"))


def backfill(build: Callable[[dt.date], DataFrame], dates: Sequence[dt.date],
             as_of_col: str = "as_of") -> tuple[DataFrame | None, dict[dt.date, str]]:
    """S-20: run ``build(as_of)`` for each date; union the results tagged with the date.

    Plans are built lazily and unioned, so Spark runs them as one job.
    Failures while building a date's plan are collected, not fatal.
    """
    frames, failures = [], {}
    for d in dates:
        try:
            frames.append(build(d).withColumn(as_of_col, F.lit(d.isoformat()).cast("date")))
        except Exception as e:  # collected and reported like the reference's run log
            failures[d] = f"{type(e).__name__}: {e}"
    if not frames:
        return None, failures
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out, failures


def counts_as_of(df: DataFrame, keys: Sequence[str], valid_from: str, dates: Sequence[dt.date],
                 valid_to: str | None = None, out: str = "n", as_of_col: str = "as_of") -> DataFrame:
    """S-20 for counts: rows valid on each of ``dates``, per key, from one scan for any number of dates.

    A row is valid from ``valid_from`` on and before ``valid_to`` (NULL: for ever).  It is +1 at its
    first day and -1 at its last; these are summed per key and day before they meet the date list, so
    what is ordered has at most one row per key and listed date.  A running sum holds until the
    key's next change.  Rows without ``valid_from``, and rows that end before they begin, count
    nowhere; keys without a valid row on a date have no row for it.
    """
    listed = sorted(set(dates))
    start = F.to_date(valid_from)
    events = df.where(start.isNotNull())
    if valid_to is not None:
        end = F.to_date(valid_to)
        events = events.where(end.isNull() | (start < end)).select(
            *keys, F.explode(F.array(F.struct(start.alias("day"), F.lit(1).alias("step")),
                                     F.struct(end.alias("day"), F.lit(-1).alias("step")))).alias("__e")) \
            .where("__e.day IS NOT NULL").select(*keys, F.col("__e.day").alias("__day"), F.col("__e.step").alias("__step"))
    else:
        events = events.select(*keys, start.alias("__day"), F.lit(1).alias("__step"))
    daily = events.groupBy(*keys, "__day").agg(F.sum("__step").alias("__n"))
    days = F.array(*[F.lit(d.isoformat()).cast("date") for d in listed]).cast("array<date>")
    # the first listed date on or after the day
    place = F.size(F.filter(days, lambda d: d < F.col("__day")))
    at = (daily.withColumn("__at", place).where(F.col("__at") < len(listed))
          .groupBy(*keys, "__at").agg(F.sum("__n").alias("__n")))
    w = Window.partitionBy(*keys).orderBy("__at")
    held = at.select(*keys, "__at", F.sum("__n").over(w).alias(out),
                     F.coalesce(F.lead("__at").over(w), F.lit(len(listed))).alias("__until"))
    return (held.where(F.col(out) > 0)
            .withColumn("__i", F.explode(F.sequence(F.col("__at"), F.col("__until") - 1)))
            .select(*keys, out, F.element_at(days, F.col("__i") + 1).alias(as_of_col)))


def period_calendar(last_loaded: Column, as_of: dt.date) -> Column:
    """S-21: months from the one after ``last_loaded`` to the last closed month before ``as_of``."""
    first = F.add_months(F.trunc(last_loaded, "month"), 1)
    last_closed = F.add_months(F.trunc(F.lit(as_of.isoformat()).cast("date"), "month"), -1)
    seq = F.sequence(first, last_closed, F.expr("INTERVAL 1 MONTH"))
    return F.when(first <= last_closed, seq).otherwise(F.array().cast("array<date>"))
