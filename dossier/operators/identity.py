"""Identity resolution and golden record (H-07..H-10, A-11, A-12)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.operators.relational import union_by_name


def build_typed_id(key, prefix: str | Column, digits_only: bool = True) -> Column:
    """H-08: ``<prefix><digits of key>``; the prefix may depend on the party type."""
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    if digits_only:
        k = F.regexp_extract(k, r"(\d+)", 1)
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(p, k)


def typed_prefix(type_col: str, mapping: dict[str, str], default: str | None = None) -> Column:
    """Prefix chosen by a party-type column (first matching type wins)."""
    expr = None
    for t, p in mapping.items():
        expr = (F.when(F.col(type_col) == t, F.lit(p)) if expr is None
                else expr.when(F.col(type_col) == t, F.lit(p)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def assign_identity(df: DataFrame, crosswalk: DataFrame, local_id: str,
                    cw_local: str = "local_id", cw_party: str = "party_id",
                    drop_local: bool = True) -> DataFrame:
    """H-07: attach the platform identifier through the crosswalk (left join).

    The crosswalk is de-duplicated per local id first (smallest party id
    wins) so the join cannot multiply rows.  Join strategy is left to the
    planner/AQE: a crosswalk grows with the party count, so it is not
    broadcast blindly.
    """
    cw = (crosswalk.groupBy(F.col(cw_local).alias("__lid"))
          .agg(F.min(cw_party).alias(cw_party)))
    out = df.join(cw, F.col(local_id) == F.col("__lid"), "left").drop("__lid")
    return out.drop(local_id) if drop_local else out


def leading_source_union(master: DataFrame, others: Sequence[DataFrame], local_id: str) -> DataFrame:
    """H-09: master rows, plus rows of other systems whose local id the master lacks."""
    out = master
    for o in others:
        out = union_by_name(out, o.join(out.select(local_id), local_id, "left_anti"))
    return out


def exclude_ids(df: DataFrame, key: str, ineligible: DataFrame, ineligible_key: str) -> DataFrame:
    """H-10: drop ids derived as ineligible (NOT IN without the NULL trap: anti join)."""
    bad = ineligible.select(F.col(ineligible_key).alias("__bad")).where(F.col("__bad").isNotNull())
    return df.join(bad, F.col(key) == F.col("__bad"), "left_anti")


def golden_aggs(attributes: Sequence[str]) -> list[Column]:
    """A-11 aggregate expressions: per attribute the max of the non-NULL values."""
    return [F.max(c).alias(c) for c in attributes]


def golden_record(df: DataFrame, key: str | Sequence[str], attributes: Sequence[str] | None = None,
                  extra: Sequence[Column] = ()) -> DataFrame:
    """A-11: one row per identity; per attribute the max of the non-NULL values.

    A single hash aggregate with partial (map-side) aggregation: a hot
    identity is reduced in every map task before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    attrs = attributes or [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*golden_aggs(attrs), *extra)


def survivorship(df: DataFrame, key: str | Sequence[str], rank: str | Column,
                 attributes: Sequence[str]) -> DataFrame:
    """A-12: per attribute the value of the best-ranked source that has one.

    ``min_by(value, rank_if_value_present)`` ignores rows whose ordering is
    NULL, so one aggregate (one shuffle, partial aggregation) replaces the
    per-attribute ROW_NUMBER windows.  Ties in rank are broken by the value
    itself so the pick is deterministic.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*survivor_aggs(rank, attributes))


def survivor_aggs(rank: str | Column, attributes: Sequence[str]) -> list[Column]:
    """A-12 aggregate expressions, to combine with other aggregates in one pass."""
    r = F.col(rank) if isinstance(rank, str) else rank
    out = []
    for a in attributes:
        order = F.when(F.col(a).isNotNull(), F.struct(r.alias("r"), F.col(a).alias("v")))
        out.append(F.min_by(F.col(a), order).alias(a))
    return out
