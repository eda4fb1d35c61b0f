"""Writers and table maintenance (K-01..K-14).

There is no Delta jar and ``MERGE INTO`` is rejected on Parquet, so every
upsert-like operation is a pure function returning the new table state;
the caller writes it (dynamic partition overwrite or a fresh folder).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dossier.functions.text import clean_column_name
from dossier.operators.relational import blank_to_null
from dossier.sources.snapshots import PART_COL


def write_snapshot(df: DataFrame, root: str, obj: str, version: str, load_date: dt.date,
                   normalize_blanks: bool = True) -> tuple[str, int]:
    """K-01: write one dated partition (that date's folder is overwritten); return path, rows.

    An empty re-run leaves an empty partition, not the rows of the run before.

    The row count is taken by an ``Observation`` during the write, not by
    a second pass.  Files are written in parallel (no forced single file).
    """
    out = blank_to_null(df) if normalize_blanks else df
    obs = Observation(f"rows_{obj}_{load_date:%Y%m%d}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    path = f"{root.rstrip('/')}/{obj}/{version}"
    out.drop(PART_COL).write.mode("overwrite").parquet(f"{path}/{PART_COL}={load_date.isoformat()}")
    return path, int(obs.get["rows"])


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K-02: update matching keys, insert new ones; duplicate keys in the update set fail the job.

    The duplicate check is a scalar subquery (a partial hash aggregate per
    key, stopping at the first repeated key) evaluated once; a repeat fails
    the job through ``raise_error`` before anything is written.
    """
    checked = updates.where(_no_duplicates(updates, keys, "duplicate keys in update set"))
    kept = target.join(checked.select(*keys), list(keys), "left_anti")
    return kept.unionByName(checked, allowMissingColumns=True)


def _no_duplicates(df: DataFrame, keys: Sequence[str], message: str) -> Column:
    """TRUE, or a job failure when some key of ``df`` occurs more than once."""
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
           .select(F.lit(1).alias("x")).limit(1).agg(F.count(F.lit(1))).scalar())
    return F.when(dup > 0, F.raise_error(F.lit(message))).otherwise(F.lit(True))


def conditional_update(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                       set_cols: dict[str, str]) -> DataFrame:
    """K-03: MERGE with only WHEN MATCHED THEN UPDATE SET (no inserts, no deletes).

    ``set_cols`` maps target column -> update column.  Duplicate keys in the
    update set fail the job, as in K-02.
    """
    updates = updates.where(_no_duplicates(updates, keys, "duplicate keys in update set"))
    u = updates.select(*[F.col(k).alias(f"__u_{k}") for k in keys],
                       *[F.col(v).alias(f"__v_{t}") for t, v in set_cols.items()],
                       F.lit(True).alias("__hit"))
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__u_{k}") for k in keys])
    j = target.join(u, cond, "left")
    cols = [F.when(F.col("__hit"), F.col(f"__v_{c}")).otherwise(F.col(c)).alias(c) if c in set_cols
            else F.col(c) for c in target.columns]
    return j.select(*cols)


def append(df: DataFrame, path: str) -> None:
    """K-04."""
    df.write.mode("append").parquet(path)


def full_load(df: DataFrame, path: str) -> None:
    """K-05: drop and rewrite."""
    df.write.mode("overwrite").parquet(path)


def write_catalog_table(spark: SparkSession, df: DataFrame, database: str, table: str,
                        location: str, mode: str = "overwrite",
                        partition_by: Sequence[str] = (), comment: str | None = None) -> int:
    """K-06: Parquet table in the catalog at an explicit location; returns rows written."""
    if not spark.catalog.databaseExists(database):
        raise ValueError(f"database {database} does not exist")
    obs = Observation(f"rows_{database}_{table}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format("parquet") \
        .option("path", location)
    if mode == "overwrite":
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(f"{database}.{table}")
    if comment:
        spark.sql(f"COMMENT ON TABLE {database}.{table} IS '{comment.replace(chr(39), '')}'")
    return int(obs.get["rows"])


def is_period_start(d: dt.date, period: str = "month") -> bool:
    if period == "month":
        return d.day == 1
    if period == "quarter":
        return d.day == 1 and d.month in (1, 4, 7, 10)
    raise ValueError(period)


def append_if_period_start(history: DataFrame, snapshot: DataFrame, as_of: dt.date,
                           date_col: str = "snapshot_date", period: str = "month") -> DataFrame:
    """K-07: on the first day of a period append a dated copy unless that date exists."""
    if not is_period_start(as_of, period):
        return history
    d = F.lit(as_of.isoformat()).cast("date")
    dated = snapshot.withColumn(date_col, d)
    # existence of the date in the history: a scalar subquery that stops at the first row
    present = history.where(F.col(date_col) == d).select(F.lit(1).alias("x")).limit(1) \
        .agg(F.count(F.lit(1))).scalar()
    return history.unionByName(dated.where(present == 0))


def append_missing_periods(target: DataFrame, source: DataFrame, period_col: str) -> DataFrame:
    """K-08: append the source rows of periods the target does not have yet."""
    have = target.select(period_col).distinct()
    new = source.join(have, period_col, "left_anti")
    return target.unionByName(new)


def replace_period(target: DataFrame, new: DataFrame, period_col: str, period: Column) -> DataFrame:
    """K-09: delete the rows of one period, insert the new ones (idempotent re-run)."""
    return target.where(~F.col(period_col).eqNullSafe(period)).unionByName(
        new.where(F.col(period_col).eqNullSafe(period)))


def row_corrections(df: DataFrame, keys: Sequence[str], corrections: DataFrame,
                    action_col: str = "action", order_col: str | None = None,
                    null_col: str | None = None) -> DataFrame:
    """K-10: DELETE / UPDATE by key from a corrections frame.

    ``corrections`` holds the keys, ``action`` ('delete' or 'update') and,
    for updates, new values in columns named like the target's (NULL =
    keep).  One left join; deletes win over updates for the same key.  Of
    several updates of a value the last by ``order_col`` wins, without it
    the largest value.  ``null_col`` names an array of the columns that an
    update sets to NULL.
    """
    vals = [c for c in corrections.columns if c not in (*keys, action_col, order_col, null_col) and c in df.columns]

    def new(v: str) -> Column:
        if order_col is None:
            return F.max(v)
        return F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(order_col)))

    def cleared(v: str) -> Column:
        return F.lit(False) if null_col is None else F.max(F.coalesce(F.array_contains(null_col, v), F.lit(False)))

    c = corrections.groupBy(*keys).agg(
        F.max((F.col(action_col) == "delete").cast("int")).alias("__del"),
        *[new(v).alias(f"__new_{v}") for v in vals], *[cleared(v).alias(f"__null_{v}") for v in vals])
    j = df.join(c, list(keys), "left")
    return j.where(F.coalesce(F.col("__del"), F.lit(0)) == 0).select(
        *[F.when(~F.coalesce(F.col(f"__null_{x}"), F.lit(False)),
                 F.coalesce(F.col(f"__new_{x}"), F.col(x))).alias(x) if x in vals else F.col(x)
          for x in df.columns])


def load_log(frames: dict[str, DataFrame | None], load_date: dt.date) -> DataFrame:
    """K-11: one audit row per source: name, load date, exists flag, row count.

    One union of one-row aggregates: all counts come from a single job.
    """
    rows = []
    spark = next(f for f in frames.values() if f is not None).sparkSession
    for name, df in frames.items():
        if df is None:
            rows.append(spark.range(1).select(F.lit(name).alias("object"), F.lit(False).alias("exists"),
                                              F.lit(0).cast("bigint").alias("n_rows")))
        else:
            rows.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("object"), F.lit(True).alias("exists"), "n_rows"))
    out = reduce(DataFrame.unionByName, rows)
    return out.withColumn("load_date", F.lit(load_date.isoformat()).cast("date"))


def export_delimited(df: DataFrame, path: str, sep: str = "|") -> int:
    """K-12: quote-all delimited export plus a row-count reconciliation file.

    Files are always written in parallel.  Returns the row count (observed during the write).
    """
    obs = Observation("export_rows")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").option("sep", sep).option("quoteAll", True) \
        .option("header", True).csv(f"{path}/data")
    n_rows = int(obs.get["rows"])
    spark = df.sparkSession
    spark.range(1).select(F.lit("ROWCOUNT").alias("record"), F.lit(n_rows).alias("n_rows")) \
        .coalesce(1).write.mode("overwrite").option("sep", sep).option("header", True) \
        .csv(f"{path}/control")
    return n_rows


def clean_column_names(df: DataFrame) -> DataFrame:
    """K-13: lower case, illegal characters to '_', collapsed and trimmed underscores."""
    return df.toDF(*[clean_column_name(c) for c in df.columns])


def catalog_inventory(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """K-14: one row per (table, column, type) from the schemas (metadata only)."""
    rows = [(t, i, f.name, f.dataType.simpleString(), f.nullable)
            for t, df in frames.items() for i, f in enumerate(df.schema.fields, start=1)]
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, "
                                       "data_type string, nullable boolean")
