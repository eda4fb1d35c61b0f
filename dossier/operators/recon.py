"""Reconciliation and screening (Q-01..Q-04, Q-14..Q-17)."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.text import normalize_name
from dossier.operators.relational import theta_or_join
from dossier.operators.shape import unpivot


def _empty(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def match_tier(a, b, normaliser: Callable[[Column], Column] | None = normalize_name) -> Column:
    """Q-01: 1 exact (trim, lower), 3 equal after normalisation, 2 either side empty, 0 no match."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    tier = F.when(F.lower(F.trim(a)) == F.lower(F.trim(b)), F.lit(1))
    if normaliser is not None:
        tier = tier.when(normaliser(a) == normaliser(b), F.lit(3))
    return tier.when(_empty(a) | _empty(b), F.lit(2)).otherwise(F.lit(0))


def system_comparison(a: DataFrame, b: DataFrame, key: str, attributes: Sequence[str],
                      normalisers: dict[str, Callable | None] | None = None) -> DataFrame:
    """Q-03: full outer join of two systems on the key with a match tier per attribute.

    Both frames carry ``key`` and the attributes under the same names.
    Output: key, presence flags, per attribute both values and ``<attr>_tier``.
    """
    normalisers = normalisers or {}
    aa = a.select(F.col(key).alias("__ka"), *[F.col(c).alias(f"{c}_a") for c in attributes])
    bb = b.select(F.col(key).alias("__kb"), *[F.col(c).alias(f"{c}_b") for c in attributes])
    j = aa.join(bb, F.col("__ka") == F.col("__kb"), "full")
    cols = [F.coalesce("__ka", "__kb").alias(key), F.col("__ka").isNotNull().alias("in_a"),
            F.col("__kb").isNotNull().alias("in_b")]
    for c in attributes:
        norm = normalisers.get(c, normalize_name)
        cols += [F.col(f"{c}_a"), F.col(f"{c}_b"), match_tier(f"{c}_a", f"{c}_b", norm).alias(f"{c}_tier")]
    return j.select(*cols)


def missing_in_other(a: DataFrame, b: DataFrame, keys: Sequence[str], mapping: DataFrame | None = None,
                     map_from: str = "from_value", map_to: str = "to_value", map_col: str | None = None) -> DataFrame:
    """Q-04: rows of A not in B and of B not in A; B's ``map_col`` is first translated
    through a manual value mapping (unmapped values pass through)."""
    if mapping is not None and map_col is not None:
        m = mapping.select(F.col(map_from).alias("__f"), F.col(map_to).alias("__t"))
        b = b.join(m, F.col(map_col) == F.col("__f"), "left") \
            .withColumn(map_col, F.coalesce("__t", F.col(map_col))).drop("__f", "__t")
    a_only = a.select(*keys).join(b.select(*keys), list(keys), "left_anti").withColumn("side", F.lit("missing_in_b"))
    b_only = b.select(*keys).join(a.select(*keys), list(keys), "left_anti").withColumn("side", F.lit("missing_in_a"))
    return a_only.unionByName(b_only).distinct()


def explode_watch_list(lists: DataFrame, names_col: str, sep: str = "~", out: str = "list_name") -> DataFrame:
    """R-08 for watch lists: one row per listed name."""
    import re
    return lists.withColumn(out, F.explode(F.split(F.col(names_col), re.escape(sep)))).drop(names_col)


def list_screening(parties: DataFrame, lists: DataFrame, party_key: str, party_country: str, party_iso: str,
                   list_name: str, list_iso: str, list_tab: str) -> DataFrame:
    """Q-14: parties whose country name or ISO code is on a list; hit labelled with the list.

    The OR condition runs as two equi joins (name, ISO) unioned and
    de-duplicated, never a nested loop.
    """
    p = parties.select(party_key, F.lower(F.trim(party_country)).alias("__pn"),
                       F.lower(F.trim(party_iso)).alias("__pi"))
    lst = lists.select(F.lower(F.trim(list_name)).alias("__ln"), F.lower(F.trim(list_iso)).alias("__li"),
                       F.col(list_tab).alias("list_tab"))
    hits = theta_or_join(p, lst, [(F.col("__pn"), F.col("__ln")), (F.col("__pi"), F.col("__li"))])
    return hits.select(party_key, "list_tab").distinct() \
        .withColumn("hit_label", F.concat(F.lit("Sanction hit: "), F.col("list_tab")))


def new_hits(hits: DataFrame, history: DataFrame, keys: Sequence[str], first_date: str, today) -> DataFrame:
    """Q-15: hits not seen before get flag 1 and today's date; known hits keep their first date."""
    h = history.groupBy(*keys).agg(F.min(first_date).alias("__first"))
    j = hits.join(h, list(keys), "left")
    t = F.lit(today.isoformat()).cast("date")
    return j.select(*hits.columns, F.when(F.col("__first").isNull(), 1).otherwise(0).alias("new_hit"),
                    F.coalesce("__first", t).alias("alert_date"))


def split_by_region(df: DataFrame, key: str, location_cols: Sequence[str], region_map: DataFrame,
                    loc: str, region: str) -> DataFrame:
    """Q-16: one extract row per (region, party) when any location column lies in the region.

    The three-way OR over location lists becomes one unpivot and one join
    to the (location -> region) map; the extract can then be written with
    ``partitionBy(region)`` in one pass instead of one filter per region.
    """
    long = unpivot(df.select(key, *location_cols), [key], list(location_cols), "__loc_kind", "__loc")
    j = long.join(region_map.select(F.col(loc).alias("__loc"), F.col(region).alias("region")), "__loc")
    return j.select("region", key).distinct()


def attribute_distribution(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Q-17: relative frequency of each value per attribute: (attribute, value, freq)."""
    long = unpivot(df.select(*[F.col(c).cast("string").alias(c) for c in attributes]).withColumn("__one", F.lit(1)),
                   ["__one"], list(attributes), "attribute", "value")
    c = long.groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("__n"))
    tot = long.groupBy("attribute").agg(F.count(F.lit(1)).alias("__t"))
    return c.join(tot, "attribute").select("attribute", "value", (F.col("__n") / F.col("__t")).alias("freq"))


def distribution_distance(population: DataFrame, sample: DataFrame) -> DataFrame:
    """Q-17: per attribute the sum of absolute frequency differences (values missing on one side count 0)."""
    p = population.select("attribute", "value", F.col("freq").alias("__p"))
    s = sample.select("attribute", "value", F.col("freq").alias("__s"))
    j = p.join(s, ["attribute", "value"], "full")
    return j.groupBy("attribute").agg(
        F.sum(F.abs(F.coalesce("__p", F.lit(0.0)) - F.coalesce("__s", F.lit(0.0)))).alias("distance"))
