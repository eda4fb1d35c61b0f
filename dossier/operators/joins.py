"""Joins whose obvious Spark form does not scale (J-notin, J-interval, W-19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def not_in(df: DataFrame, key: str, sub: DataFrame, sub_key: str) -> DataFrame:
    """J-notin: SQL ``key NOT IN (SELECT sub_key FROM sub)`` with its NULL rules.

    * empty subquery: every row is kept (NULL keys too);
    * a NULL in the subquery: no row is kept;
    * otherwise rows whose key is not NULL and not in the subquery.

    Spark's own null-aware anti join is only a hash join when the subquery
    side is broadcast; otherwise it is a nested loop.  Here the membership
    test is a plain anti join (shuffle or broadcast, planner's choice) and
    the NULL rules come from a one-row aggregate of the subquery.
    """
    stats = sub.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count(sub_key).alias("nn"))).scalar()
    keys = sub.select(F.col(sub_key).alias("__k")).where(F.col("__k").isNotNull())
    kept = df.join(keys, F.col(key) == F.col("__k"), "left_anti")
    n, nn = stats.getField("n"), stats.getField("nn")
    return kept.where((n == 0) | ((n == nn) & F.col(key).isNotNull()))


def _day(c) -> F.Column:
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date"))


def interval_join(points: DataFrame, intervals: DataFrame, key: str, point: str, start: str,
                  end: str, bucket_days: int = 31, bucket: str | None = None,
                  inclusive: bool = False) -> DataFrame:
    """J-interval: points joined to the intervals of the same key that contain them.

    ``start < point < end`` (or ``<=`` when ``inclusive``).  A key-only equi
    join would pair every point with every interval of its key (quadratic
    for a hot key).  Intervals are cut into time buckets (``bucket_days``
    wide) and the join is on (key, bucket): a point only meets intervals
    that overlap its own bucket.  Interval ends are clamped to the range of
    point times first (a scalar subquery), so open-ended intervals do not
    explode into far-future buckets.
    """
    if bucket == "month":
        bucket_days = 31
    span = points.agg(F.struct(F.min(point).alias("lo"), F.max(point).alias("hi"))).scalar()
    iv = intervals.withColumn("__pmin", span.getField("lo")).withColumn("__pmax", span.getField("hi"))
    b0 = F.floor(_day(F.greatest(F.col(start), F.col("__pmin"))) / bucket_days)
    b1 = F.floor(_day(F.least(F.col(end), F.col("__pmax"))) / bucket_days)
    iv = (iv.where(F.col(start) <= F.col("__pmax")).where(F.col(end) >= F.col("__pmin"))
          .withColumn("__b", F.explode(F.sequence(b0, F.greatest(b0, b1))))
          .drop("__pmin", "__pmax"))
    pts = points.withColumn("__b", F.floor(_day(F.col(point)) / bucket_days))
    if inclusive:
        cond = (F.col(point) >= F.col(start)) & (F.col(point) <= F.col(end))
    else:
        cond = (F.col(point) > F.col(start)) & (F.col(point) < F.col(end))
    pk = pts[key]
    j = pts.join(iv, (pk == iv[key]) & (pts["__b"] == iv["__b"]) & cond, "inner")
    return j.drop(iv[key]).drop(iv["__b"]).drop(pts["__b"])
