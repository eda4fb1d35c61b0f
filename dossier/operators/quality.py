"""Data-quality rules (Q-05..Q-13): one-pass aggregates returning small result frames.

Every rule returns a frame (never a Python value computed by collecting
rows); failing "strict" rules stop the job with an in-plan ``raise_error``.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _status(ok: Column) -> Column:
    return F.when(ok, F.lit("Pass")).otherwise(F.lit("Fail"))


def dq_unique(df: DataFrame, keys: Sequence[str], rule: str = "uniqueness", where: Column | None = None,
              n_examples: int = 10) -> DataFrame:
    """Q-05: Pass/Fail, row and key counts, number of duplicated keys and up to ``n_examples``
    example keys (the smallest, as text).  The examples come from a bounded top-n, never
    from collecting all duplicates."""
    d = df.where(where) if where is not None else df
    g = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    summary = g.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("n_rows"),
                    F.count(F.lit(1)).alias("n_keys"),
                    F.count(F.when(F.col("__n") > 1, 1)).alias("n_duplicate_keys"))
    key_txt = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    top = g.where(F.col("__n") > 1).orderBy(*keys).limit(n_examples).select(*keys)
    ex = top.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*keys))),
                                          lambda s: F.concat_ws("|", *[s.getField(k).cast("string") for k in keys])),
                              ",").alias("examples"))
    return summary.select(
        F.lit(rule).alias("rule"), _status(F.col("n_duplicate_keys") == 0).alias("status"),
        "n_rows", "n_keys", "n_duplicate_keys", ex.scalar().alias("examples"))


def _example_text(keys: DataFrame, key: str, n: int) -> DataFrame:
    """One row: the ``n`` smallest distinct non-null keys as text (a bounded top-n)."""
    top = keys.select(F.col(key).alias("__k")).where("__k IS NOT NULL").distinct().orderBy("__k").limit(n)
    return top.agg(F.array_join(F.transform(F.array_sort(F.collect_list("__k")), lambda k: k.cast("string")), ","))


def dq_not_null(df: DataFrame, columns: Sequence[str] | None = None, rule: str = "not_null",
                where: Column | None = None, example_key: str | None = None, n_examples: int = 10) -> DataFrame:
    """Q-06: NULL count per column in one pass; one result row per column.

    ``where`` restricts the rows; with ``example_key`` the smallest distinct keys of the rows at fault
    follow per column as ``examples`` (empty text where there are none; a NULL key is not named)."""
    df = df.where(where) if where is not None else df
    cols = list(columns or df.columns)
    agg = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    st = F.stack(F.lit(len(cols)), *[x for c in cols for x in (F.lit(c), F.col(c))])
    out = agg.select(st).toDF("column_name", "n_null")
    out = out.select(F.lit(rule).alias("rule"), "column_name", "n_null", _status(F.col("n_null") == 0).alias("status"))
    if example_key is None:
        return out
    at_fault = F.filter(F.array(*[F.when(F.col(c).isNull(), c) for c in cols]), lambda c: c.isNotNull())
    bad = (df.where(F.col(example_key).isNotNull())
           .select(F.explode(at_fault).alias("column_name"), F.col(example_key).alias("__k")).distinct())
    w = Window.partitionBy("column_name").orderBy("__k")
    ex = (bad.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n_examples).groupBy("column_name")
          .agg(F.array_join(F.transform(F.array_sort(F.collect_list("__k")), lambda k: k.cast("string")), ",").alias("examples")))
    return out.join(ex, "column_name", "left").withColumn("examples", F.coalesce("examples", F.lit("")))


def dq_referential(a: DataFrame, a_key: str, b: DataFrame, b_key: str, ignore_null: bool = False,
                   where: Column | None = None) -> DataFrame:
    """Q-07: keys of A (its rows that meet ``where``) missing from B with their row counts (a NULL
    key counts as missing unless ``ignore_null``)."""
    src = (a.where(where) if where is not None else a).select(F.col(a_key).alias("key"))
    if ignore_null:
        src = src.where(F.col("key").isNotNull())
    miss = src.join(b.select(F.col(b_key).alias("__bk")).where(F.col("__bk").isNotNull()),
                    F.col("key") == F.col("__bk"), "left_anti")
    return miss.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"))


def dq_referential_status(a: DataFrame, a_key: str, b: DataFrame, b_key: str, rule: str, ignore_null: bool = False,
                          where: Column | None = None, n_examples: int = 10) -> DataFrame:
    """Q-07 as one log row: Pass/Fail, missing rows and keys, the smallest missing keys."""
    miss = dq_referential(a, a_key, b, b_key, ignore_null, where)
    return miss.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_missing_rows"),
                    F.count(F.lit(1)).alias("n_missing_keys")).select(
        F.lit(rule).alias("rule"), _status(F.col("n_missing_keys") == 0).alias("status"), "n_missing_rows",
        "n_missing_keys", _example_text(miss, "key", n_examples).scalar().alias("examples"))


def dq_condition(df: DataFrame, condition: Column, rule: str, description: str = "", where: Column | None = None,
                 example_key: str | None = None, n_examples: int = 10) -> DataFrame:
    """Q-08: number of rows (that meet ``where``) violating ``condition`` (NULL counts as a violation);
    with ``example_key`` the smallest keys of violating rows as ``examples``."""
    df = df.where(where) if where is not None else df
    violated = ~F.coalesce(condition, F.lit(False))
    out = df.agg(F.count(F.when(violated, 1)).alias("n_violations"), F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(rule).alias("rule"), F.lit(description).alias("description"), "n_rows", "n_violations",
        _status(F.col("n_violations") == 0).alias("status"))
    if example_key is None:
        return out
    return out.withColumn("examples", _example_text(df.where(violated), example_key, n_examples).scalar())


def dq_log(results: Sequence[DataFrame], object_name: str, run_ts: dt.datetime) -> DataFrame:
    """Q-09: rule results as log rows (timestamp, object, rule, columns, status, message)."""
    rows = []
    for r in results:
        msg_cols = [c for c in r.columns if c not in ("rule", "status")]
        rows.append(r.select(
            F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz").alias("logged_at"),
            F.lit(object_name).alias("object"), F.col("rule"),
            F.lit(",".join(msg_cols)).alias("columns"), F.col("status"),
            F.to_json(F.struct(*msg_cols)).alias("message")))
    return reduce(DataFrame.unionByName, rows)


def dq_delimited_duplicates(c) -> Column:
    """Q-10: a delimited list holds the same value twice."""
    parts = F.split(F.col(c) if isinstance(c, str) else c, ",")
    return F.size(parts) > F.size(F.array_distinct(parts))


def dq_set_compare(expected: DataFrame, produced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q-11: expected ids missing from the extract and extract ids not expected."""
    miss = expected.select(*keys).join(produced.select(*keys), list(keys), "left_anti") \
        .withColumn("issue", F.lit("missing_in_extract"))
    extra = produced.select(*keys).join(expected.select(*keys), list(keys), "left_anti") \
        .withColumn("issue", F.lit("unexpected_in_extract"))
    return miss.unionByName(extra)


def fail_on_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q-12: the frame itself, failing the job when a key repeats (checked in the plan by a
    scalar subquery over a partial hash aggregate, no sort of the frame)."""
    from dossier.sources.sinks import _no_duplicates
    return df.where(_no_duplicates(df, keys, "duplicate keys"))


def inconsistent_values(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Q-13: keys with more than one distinct non-blank value, or only blank values."""
    v = F.nullif(F.trim(F.col(col)), F.lit(""))
    g = df.groupBy(*keys).agg(F.count_distinct(v).alias("n_values"), F.count(v).alias("__nonblank"))
    issue = F.when(F.col("n_values") > 1, "multiple values").when(F.col("__nonblank") == 0, "blank only")
    return g.withColumn("issue", issue).where(F.col("issue").isNotNull()).drop("__nonblank")


def run_rules(df: DataFrame, object_name: str, rules: Sequence[tuple], run_ts: dt.datetime) -> DataFrame:
    """Run several rules on one object and return their log rows (Q-05..Q-09 together).

    ``rules`` holds ``("unique", keys, rule)``, ``("condition", column, rule, description)`` or
    ``("not_null", columns, rule)`` entries.  Every rule is an aggregate over ``df``; the
    union is evaluated as one plan.
    """
    results = []
    for r in rules:
        kind = r[0]
        if kind == "unique":
            results.append(dq_unique(df, r[1], r[2]))
        elif kind == "condition":
            results.append(dq_condition(df, r[1], r[2], r[3] if len(r) > 3 else ""))
        elif kind == "not_null":
            nn = dq_not_null(df, r[1], r[2])
            results.append(nn.groupBy("rule").agg(
                F.when(F.max(F.col("n_null")) == 0, "Pass").otherwise("Fail").alias("status"),
                F.sum("n_null").alias("n_null")))
        else:
            raise ValueError(kind)
    return dq_log(results, object_name, run_ts)
