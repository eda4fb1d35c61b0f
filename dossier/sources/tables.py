"""S-01: scan the driver tables (Parquet) by name."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read every Parquet file under ``path`` (a file, a folder or a glob)."""
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def tasks(self, name: str, mb: float) -> int:
        """Shuffle tasks for work that grows with a table: one per ``mb`` MB of its files, and the session's number at least."""
        files = self.spark.read.format("binaryFile").load(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        size = files.agg(F.sum("length")).collect()[0][0] or 0
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / (mb * 1e6)))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
