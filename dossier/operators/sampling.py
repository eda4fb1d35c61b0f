"""Reproducible sampling and rule tagging (X-01..X-05, X-09).

Random choices are replaced by a seeded hash order (``xxhash64(key, seed)``):
the same input and seed always give the same sample, on any cluster size.
Exact per-stratum "k smallest hashes" is done without sorting a whole
stratum in one task: hash values are bucketed by their top bits, bucket
counts (a partial aggregate) locate the boundary bucket per stratum, and
only the rows of that one bucket are ranked.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 12


def hash_order(keys: Sequence[str], seed: int) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))


def take_smallest_hashes(df: DataFrame, strata: Sequence[str], sizes: DataFrame, size_col: str,
                         keys: Sequence[str], seed: int) -> DataFrame:
    """Rows with the ``size`` smallest ``xxhash64(keys, seed)`` per stratum (exact, ties by key).

    ``sizes`` has one row per stratum with the number of rows to keep.
    """
    h = hash_order(keys, seed)
    # top bits of the signed hash, shifted to [0, 2^bits): order preserving
    bucket = F.shiftright(h, 64 - BUCKET_BITS) + F.lit(1 << (BUCKET_BITS - 1))
    x = df.withColumn("__h", h).withColumn("__b", bucket)
    counts = x.groupBy(*strata, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*strata).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    cum = (counts.join(sizes.select(*strata, F.col(size_col).alias("__k")), list(strata))
           .withColumn("__cum", F.sum("__cnt").over(w))
           .withColumn("__before", F.col("__cum") - F.col("__cnt")))
    # per stratum: buckets fully inside, and the boundary bucket with how many rows it gives
    plan = cum.where(F.col("__before") < F.col("__k")).select(
        *strata, "__b", F.when(F.col("__cum") <= F.col("__k"), F.lit(None))
        .otherwise(F.col("__k") - F.col("__before")).alias("__need"))
    y = x.join(plan, [*strata, "__b"], "inner")
    full = y.where(F.col("__need").isNull())
    edge = y.where(F.col("__need").isNotNull())
    wr = Window.partitionBy(*strata, "__b").orderBy("__h", *keys)
    edge = edge.withColumn("__r", F.row_number().over(wr)).where(F.col("__r") <= F.col("__need")).drop("__r")
    return full.unionByName(edge).drop("__h", "__b", "__need")


def stratified_minimum_sample(df: DataFrame, strata: Sequence[str], keys: Sequence[str], fraction: float,
                              minimum: int, seed: int = 42, dedup_keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """X-01: per stratum ``min(n_dedup, max(ceil(fraction * n), minimum))`` rows of the
    de-duplicated population, chosen by hash order.  Returns (sample, sizes)."""
    from dossier.operators.pick import dedupe_latest
    # de-duplicated population: one row per (stratum, dedup key), the smallest key wins
    dedup = (dedupe_latest(df, [*strata, *dedup_keys], [F.col(k) for k in keys])
             if dedup_keys else df)
    n_all = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("n_population"))
    n_dd = dedup.groupBy(*strata).agg(F.count(F.lit(1)).alias("n_dedup"))
    sizes = n_all.join(n_dd, list(strata)).withColumn(
        "n_sample", F.least(F.col("n_dedup"), F.greatest(F.ceil(F.col("n_population") * fraction), F.lit(minimum)))
        .cast("bigint"))
    return take_smallest_hashes(dedup, strata, sizes, "n_sample", keys, seed), sizes


def equal_split_balance(df: DataFrame, group: str, keys: Sequence[str], target: int, seed: int = 42) -> DataFrame:
    """X-02: the same number of rows from every group (ceil(target / groups), or all of a
    smaller group), then a hash-ordered cut to exactly ``target`` rows overall."""
    n = df.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    g = n.agg(F.count(F.lit(1))).scalar()
    sizes = n.select(group, F.least(F.col("__n"), F.ceil(F.lit(target) / g)).alias("__k"))
    per_group = take_smallest_hashes(df, [group], sizes, "__k", keys, seed)
    # the cut keeps at most ``target`` rows: a bounded top-n, the sample size is the feature
    cut = per_group.withColumn("__h2", hash_order(keys, seed + 1)).orderBy("__h2", *keys).limit(target)
    return cut.drop("__h2")


def sample_by_strata(df: DataFrame, stratum: str, fractions: dict, seed: int = 42) -> DataFrame:
    """X-03: Bernoulli sample with a fraction per stratum (Spark's seeded ``sampleBy``)."""
    return df.sampleBy(stratum, fractions, seed)


def rule_tagging(df: DataFrame, keys: Sequence[str], rules: dict[str, Column], out: str = "rule") -> DataFrame:
    """X-05: one row per (key, rule matched) from many named criteria in one pass."""
    arr = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return df.select(*keys, F.explode(arr).alias(out))


def representative_sample(df: DataFrame, key: str, weight: str, mandatory: str, attributes: Sequence[str],
                          size: int, n_candidates: int = 1000, seed: int = 42) -> DataFrame:
    """X-04: among ``n_candidates`` weighted samples of exactly ``size`` rows (mandatory rows
    always in), keep the one whose attribute distribution is closest to the population (Q-17).

    Each candidate is a weighted sample without replacement: the mandatory
    rows plus the ``size - m`` other rows with the smallest ``-ln(u) / w``
    (Efraimidis-Spirakis keys, ``u`` a seeded hash draw per row and
    candidate).  Every row is tested for every candidate, in a projection
    without a join; before anything is sorted, only draws within a bound stay:
    the candidate's ``size``-th smallest draw among some of the rows (about
    ``sqrt(rows * size)``, dealt by hash), which no member exceeds.  So
    sorting and shuffling grow with the square root of the rows.  The mandatory
    rows are counted once for all candidates, and only the best candidate's
    rows are gathered.  All distances come from one aggregate.
    """
    from dossier.operators.recon import attribute_distribution
    n_tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mandatory_rows, others = df.where(F.col(mandatory)), df.where(~F.col(mandatory) & (F.col(weight) > 0))
    m = mandatory_rows.agg(F.count(F.lit(1))).scalar()
    u = (F.abs(F.xxhash64(F.col(key), F.col("candidate"), F.lit(seed))) % F.lit(1 << 52) + 1) / F.lit(float(1 << 52))
    es = -F.log(u) / F.col(weight)
    candidates = F.explode(F.sequence(F.lit(0), F.lit(n_candidates - 1))).alias("candidate")
    w = Window.partitionBy("candidate").orderBy("__es", key, *attributes)

    def drawn(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        """The ``size`` smallest draws per candidate, numbered (literal: map-side cut)."""
        x = rows.select(*columns, "candidate", es.alias("__es")).withColumn("__rn", F.row_number().over(w))
        return x.where(F.col("__rn") <= size)

    # few bytes, much work: spread over the tasks, whatever the files' number
    slim = list(dict.fromkeys([key, weight, *attributes]))
    pool = others.select(*slim).repartition(n_tasks, *slim)
    every = others.agg(F.greatest(F.lit(1), F.floor(F.sqrt(F.count(F.lit(1)) / F.lit(size))))).scalar()
    some = pool.where(F.pmod(F.xxhash64(*slim, F.lit(seed + 1)), every) == 0).select("*", candidates)
    # all candidates have a bound, or none: they draw from the same rows
    bounds = (drawn(some, slim).where(F.col("__rn") == size)
              .agg(F.sort_array(F.collect_list(F.struct("candidate", "__es"))).alias("b"))
              .select(F.transform("b", lambda x: x["__es"]))).scalar()
    bound = F.get(bounds, F.col("candidate"))
    within = pool.where(F.lit(size) > m).select("*", candidates).where(bound.isNull() | (es <= bound))
    chosen = drawn(within, slim).where(F.col("__rn") <= F.lit(size) - m)
    pop = attribute_distribution(df, attributes)
    st = F.stack(F.lit(len(attributes)), *[v for a in attributes for v in (F.lit(a), F.col(a).cast("string"))])
    counted = chosen.select("candidate", st).toDF("candidate", "attribute", "value") \
        .groupBy("candidate", "attribute", "value").agg(F.count(F.lit(1)).alias("__n"))
    fixed = mandatory_rows.select(st).toDF("attribute", "value") \
        .groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("__n")).select(candidates, "*")
    cnt = counted.unionByName(fixed).groupBy("candidate", "attribute", "value").agg(F.sum("__n").alias("__n"))
    totc = cnt.groupBy("candidate", "attribute").agg(F.sum("__n").alias("__t"))
    samp = cnt.join(totc, ["candidate", "attribute"]).select(
        "candidate", "attribute", "value", (F.col("__n") / F.col("__t")).alias("__s"))
    j = samp.join(pop.select("attribute", "value", F.col("freq").alias("__pf")), ["attribute", "value"], "left")
    covered = j.groupBy("candidate").agg(
        F.sum(F.abs(F.col("__s") - F.coalesce("__pf", F.lit(0.0)))).alias("__d1"),
        F.sum(F.coalesce("__pf", F.lit(0.0))).alias("__covered"))
    # population mass not covered by the candidate adds |p - 0| per missing value
    # rounded: sums in another order tie, and the smaller candidate wins on every run
    dist = covered.select("candidate", F.round(F.col("__d1") + (F.lit(float(len(attributes))) - F.col("__covered")), 9)
                          .alias("distance"))
    best = dist.agg(F.min_by("candidate", F.struct("distance", "candidate"))).scalar()
    rest = drawn(others.where(F.lit(size) > m).withColumn("candidate", best), df.columns).where(F.col("__rn") <= F.lit(size) - m)
    return (rest.select(*df.columns, "candidate").unionByName(mandatory_rows.withColumn("candidate", best))
            .where(F.col("candidate").isNotNull()))


def generate_test_data(seeds: DataFrame, key: str, spec: dict[str, dict], seed: int = 42) -> DataFrame:
    """X-09: typed synthetic attributes per seed row from value lists, NULL rates and expressions.

    ``spec``: column -> {"values": [...], "null_pct": p} or {"expr": "sql expression"}.
    Choices are ``xxhash64(key, column, seed)`` picks, so output is deterministic.
    """
    cols = [F.col(key)]
    for i, (name, s) in enumerate(spec.items()):
        h = F.abs(F.xxhash64(F.col(key), F.lit(name), F.lit(seed)))
        if "expr" in s:
            c = F.expr(s["expr"])
        else:
            vals = F.array(*[F.lit(v) for v in s["values"]])
            c = F.element_at(vals, (h % len(s["values"]) + 1).cast("int"))
        if s.get("null_pct"):
            c = F.when((F.abs(F.xxhash64(F.col(key), F.lit(name + "#null"), F.lit(seed))) % 100) < s["null_pct"],
                       F.lit(None)).otherwise(c)
        cols.append(c.alias(name))
    return seeds.select(*cols)
