"""Relational surface: projections, filters, joins, set operations, sort (P-*, J-*, U-*, O-*).

Most of these are one DataFrame call; they exist so that pipelines name the
intent, and so that the few places where the obvious call is wrong at scale
(OR-joins, subset distinct, broadcast of an unchecked side, empty windows)
have one correct implementation.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from dossier.functions.text import blank_to_null as _blank, one_line_string

# ---------------------------------------------------------------- projections

def project(df: DataFrame, columns: dict[str, Column | str], drop: Sequence[str] = ()) -> DataFrame:
    """P-01: select / alias / literal / rename / drop in one projection."""
    cols = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in columns.items()]
    out = df.select(*cols) if cols else df
    return out.drop(*drop) if drop else out


def blank_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """P-05: blank / 'null' strings to NULL in every string column (one projection)."""
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[_blank(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def drop_all_null(df: DataFrame, subset: Sequence[str], fill: dict | None = None) -> DataFrame:
    """P-06: drop rows whose subset columns are all NULL, then fill defaults."""
    out = df.na.drop(how="all", subset=list(subset))
    return out.na.fill(fill) if fill else out


def cast_all_string(df: DataFrame) -> DataFrame:
    """P-07: every column to string with line breaks collapsed to a space."""
    return df.select(*[one_line_string(c).alias(c) for c in df.columns])


def current_rows(df: DataFrame, valid_to: str = "valid_to", deleted: str | None = "del_f",
                 open_end: str = "9999-12-31") -> DataFrame:
    """P-08: keep open validity rows (and not deleted)."""
    cond = F.col(valid_to) == F.lit(open_end).cast("date")
    if deleted:
        cond = cond & (F.col(deleted) == "N")
    return df.where(cond)


def scalar_subquery_filter(df: DataFrame, col: str, other: DataFrame, other_col: str,
                           agg: str = "max") -> DataFrame:
    """P-09: ``WHERE col = (SELECT agg(other_col) FROM other)``.

    A scalar subquery: the aggregate runs once and its value is inlined into
    the filter (no join, no driver round trip).
    """
    return df.where(F.col(col) == other.agg(getattr(F, agg)(other_col)).scalar())


def coalesce_sources(*cols) -> Column:
    """P-10: first non-NULL over the same attribute from several sources, in precedence order."""
    return F.coalesce(*[F.col(c) if isinstance(c, str) else c for c in cols])


def protect_names(df: DataFrame, key: str, name: str, protected: DataFrame, protected_key: str,
                  label: str = "protected account ") -> DataFrame:
    """P-11: replace the name by '<label><key>' for keys in the protected set."""
    p = protected.select(F.col(protected_key).alias("__pk")).distinct() \
        .withColumn("__hit", F.lit(True))
    j = df.join(p, F.col(key) == F.col("__pk"), "left")
    return j.withColumn(name, F.when(F.col("__hit"), F.concat(F.lit(label), F.col(key).cast("string")))
                        .otherwise(F.col(name))).drop("__pk", "__hit")


def any_column_equals(df: DataFrame, marker, columns: Sequence[str] | None = None) -> DataFrame:
    """P-13: keep rows where any (given) column equals ``marker``."""
    cols = columns or df.columns
    return df.where(reduce(or_, [F.col(c).cast("string") == F.lit(str(marker)) for c in cols]))


def safe_convert(c, target: str, fill=None) -> Column:
    """P-14: string / int (bad or missing -> 0) / boolean / timestamp (bad -> NULL)."""
    x = F.col(c) if isinstance(c, str) else c
    if target == "string":
        out = x.cast("string")
    elif target in ("int", "bigint", "long"):
        out = F.coalesce(x.try_cast("bigint" if target != "int" else "int"), F.lit(0))
    elif target == "boolean":
        out = F.lower(F.trim(x.cast("string"))).try_cast("boolean")
    elif target in ("timestamp", "timestamp_ntz"):
        out = x.cast("string").try_cast("timestamp_ntz")
    elif target == "double":
        out = x.try_cast("double")
    else:
        raise ValueError(target)
    return F.coalesce(out, F.lit(fill)) if fill is not None else out


# ---------------------------------------------------------------------- joins

def theta_or_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[Column, Column]],
                  how: str = "inner") -> DataFrame:
    """J-theta: ``ON a1 = b1 OR a2 = b2 OR ...`` as a union of equi joins.

    An OR condition is not an equi join, so Spark would fall back to a
    nested-loop join (quadratic).  Disjunct i runs as a hash/sort-merge join
    on its own key pair with the residual "no earlier disjunct holds", so
    every matching pair comes out exactly once: a plain UNION ALL, no
    de-duplication shuffle, and duplicate input rows keep their multiplicity
    (inner join semantics).  Outer joins are refused: a union of them would
    repeat matched rows as unmatched ones.
    """
    if how != "inner":
        raise ValueError("only inner OR-joins are supported")
    parts = []
    earlier: Column | None = None
    for lc, rc in pairs:
        cond = lc == rc
        if earlier is not None:
            cond = cond & ~F.coalesce(earlier, F.lit(False))
        parts.append(left.join(right, cond, how))
        eq = F.coalesce(lc == rc, F.lit(False))
        earlier = eq if earlier is None else (earlier | eq)
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------- set ops

def union_distinct(*dfs: DataFrame) -> DataFrame:
    """U-01: UNION (by position, names of the first branch, then distinct)."""
    return reduce(DataFrame.union, dfs).distinct()


def union_all(*dfs: DataFrame) -> DataFrame:
    """U-02: UNION ALL (by position, names of the first branch)."""
    return reduce(DataFrame.union, dfs)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """U-03: align by name, add missing columns as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def except_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """U-04: MINUS (distinct rows of a not in b)."""
    return a.subtract(b)


def union_branches(branches: dict[str, DataFrame], tag: str = "source_system") -> DataFrame:
    """U-05: the same projection per branch, tagged with the branch name."""
    tagged = [df.select(F.lit(name).alias(tag), *df.columns) for name, df in branches.items()]
    return union_by_name(*tagged)


def union_versions(versions: dict[str, tuple[DataFrame, dict[str, str]]],
                   tag: str = "version") -> DataFrame:
    """U-06: several schema versions, each renamed to the current names, tagged."""
    frames = []
    for v, (df, renames) in versions.items():
        frames.append(df.withColumnsRenamed(renames).withColumn(tag, F.lit(v)))
    return union_by_name(*frames)


# ---------------------------------------------------------------------- sort

def top_n_with_ties(df: DataFrame, order: Sequence[tuple[str, bool]], n: int = 1,
                    partition: Sequence[str] = ()) -> DataFrame:
    """O-02: every row ranked within the first ``n`` by ``order`` (ties kept).

    ``order`` is a list of (column, ascending).  With a partition, a filter on
    ``rank()`` lets Spark insert a partial window-group limit before the
    shuffle.  Without one, an empty window would move every row to one task;
    instead the n-th row is found with a bounded top-n (each task keeps n
    rows) and joined back as a one-row broadcast: rows ordered at or before
    it are kept.
    """
    def ocol(c, asc):
        return F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last()
    if partition:
        w = Window.partitionBy(*partition).orderBy(*[ocol(c, a) for c, a in order])
        return df.withColumn("__r", F.rank().over(w)).where(F.col("__r") <= n).drop("__r")
    names = [c for c, _ in order]
    b = [f"__b{i}" for i in range(len(order))]
    top = (df.select(*[F.col(c).alias(x) for c, x in zip(names, b)])
           .orderBy(*[ocol(x, a) for x, (_, a) in zip(b, order)]).limit(n))
    # the n-th row: last of the (at most n) top rows
    nth = top.orderBy(*[ocol(x, not a) for x, (_, a) in zip(b, order)]).limit(1) \
        .select(F.struct(*b).alias("__nth")).scalar()
    # lexicographic "at or before the boundary" (NULLs sort last)
    cond = F.lit(True)
    for i in reversed(range(len(order))):
        c, asc = order[i]
        b = nth.getField(f"__b{i}")
        x = F.col(c)
        before = (x < b) if asc else (x > b)
        before = (before & x.isNotNull()) | (x.isNotNull() & b.isNull())
        cond = before | (x.eqNullSafe(b) & cond)
    return df.where(cond)
