"""Reshape: pivot, unpivot, explode (R-01..R-12)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_values(df: DataFrame, pivot_col: str, max_values: int = 1000) -> list:
    """Distinct pivot values, sorted; refuses more than ``max_values``.

    Only the distinct values of one column travel to the driver, and their
    number is bounded before anything is collected.
    """
    vals = (df.select(pivot_col).where(F.col(pivot_col).isNotNull()).distinct()
            .limit(max_values + 1).collect())
    if len(vals) > max_values:
        raise ValueError(f"more than {max_values} pivot values in {pivot_col}")
    return sorted(r[0] for r in vals)


def pivot_dynamic(df: DataFrame, keys: Sequence[str], pivot_col: str, agg: Column,
                  values: Sequence | None = None, max_values: int = 1000) -> DataFrame:
    """R-01: one column per pivot value; values listed first (given or discovered, bounded)."""
    vals = list(values) if values is not None else pivot_values(df, pivot_col, max_values)
    return df.groupBy(*keys).pivot(pivot_col, vals).agg(agg)


def pivot_open(df: DataFrame, keys: Sequence[str], pivot_col: str, agg: Column, null_name: str = "(null)",
               out: str = "cells") -> DataFrame:
    """R-01 with any number of values: per key one map from pivot value (as text) to aggregate.

    Nothing is listed or collected while planning.  Values are aggregated per (key, value) first, so a
    map gathers one entry per distinct value of its key; the NULL value is the entry ``null_name``, or
    fails as a duplicate entry if that name is a value too.  Entries are sorted by value.
    """
    cells = (df.withColumn("__v", F.coalesce(F.col(pivot_col).cast("string"), F.lit(null_name)))
             .groupBy(*keys, F.isnull(pivot_col).alias("__null"), "__v").agg(agg.alias("__a")))
    entries = F.array_sort(F.collect_list(F.struct(F.col("__v").alias("key"), F.col("__a").alias("value"))))
    return cells.groupBy(*keys).agg(F.map_from_entries(entries).alias(out))


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "attribute",
            value: str = "value", drop_nulls: bool = False) -> DataFrame:
    """R-03 (keep NULL) / R-05 (drop NULL): wide to (ids, name, value)."""
    out = df.unpivot(list(ids), list(values), name, value)
    return out.where(F.col(value).isNotNull()) if drop_nulls else out


def unpivot_groups(df: DataFrame, ids: Sequence[str], groups: dict[str, Sequence[Column]],
                   names: Sequence[str]) -> DataFrame:
    """R-04: several column groups per row to one row per group (``stack``)."""
    n = len(groups)
    args = []
    for label, cols in groups.items():
        args.append(F.lit(label))
        args.extend(cols)
    st = F.stack(F.lit(n), *args)
    return df.select(*ids, st).toDF(*ids, *names)


def flags_to_rows(df: DataFrame, ids: Sequence[str], flags: dict[str, Column],
                  name: str = "flag") -> DataFrame:
    """R-06: one row per true flag, labelled."""
    arr = F.array_compact(F.array(*[F.when(c, F.lit(label)) for label, c in flags.items()]))
    return df.select(*ids, F.explode(arr).alias(name))


def rows_to_flags(df: DataFrame, keys: Sequence[str], col: str, labels: dict[str, str],
                  true: str = "True", false: str = "False") -> DataFrame:
    """R-07: inverse of R-06 — per key a 'True'/'False' column per label value."""
    return df.groupBy(*keys).agg(*[
        F.max(F.when(F.col(col) == v, F.lit(true)).otherwise(F.lit(false))).alias(out)
        for v, out in labels.items()])


def explode_list(df: DataFrame, ids: Sequence[str], col: str, sep: str, name: str) -> DataFrame:
    """R-08: split delimited text and explode (separator taken literally)."""
    import re
    return df.select(*ids, F.explode(F.split(F.col(col), re.escape(sep))).alias(name))


def explode_outer_multi(df: DataFrame, ids: Sequence[str], arrays: dict[str, str]) -> DataFrame:
    """R-10: product of several arrays; NULL / empty arrays keep the row (chained explode_outer)."""
    out = df
    for src, name in arrays.items():
        out = out.withColumn(name, F.explode_outer(src))
    return out.select(*ids, *arrays.values())


def explode_aligned(df: DataFrame, ids: Sequence[str], arrays: dict[str, str]) -> DataFrame:
    """R-11: parallel arrays exploded by position (``arrays_zip``, not a product)."""
    z = F.arrays_zip(*[F.col(a).alias(n) for a, n in arrays.items()])
    e = df.select(*ids, F.explode(z).alias("__z"))
    return e.select(*ids, *[F.col("__z").getField(n).alias(n) for n in arrays.values()])


def last_element(arr: Column, skip_nulls: bool = True) -> Column:
    """R-12: last (non-NULL) element of an array, NULL when there is none."""
    a = F.filter(arr, lambda x: x.isNotNull()) if skip_nulls else arr
    return F.try_element_at(a, F.lit(-1))
