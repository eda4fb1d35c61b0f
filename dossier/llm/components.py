"""Connected components of a link table by alternating large-star and small-star rounds.

A round points every node at the least node it knows of, until each component is a star around
its least node.  Links never leave the executors; each round is written to the shared folder.

Links that have come to meet are made distinct after each half of a round: the members of a
large group point at one node many times, and these rows would all meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Of links with v < u."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every node points at one other at most, and none that is pointed at points further."""
    ends = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.lit(None).cast("long").alias("v")))
    open_nodes = (ends.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("k"),
                                        F.count("v").alias("out"))
                  .where("low <> high OR (out > 0 AND out < k)"))
    return open_nodes.agg(F.count(F.lit(1))).first()[0] == 0


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) that is not the least of its component."""
    now = written(spark, links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "links")
    while not _stars(now):
        now = written(spark, _small_star(_large_star(now)), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
