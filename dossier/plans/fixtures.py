"""Derived inputs the history / snapshot queries need, written by Spark from the driver tables.

Files go to a fresh folder under the shared checkpoint folder
(``spark.checkpoint.dir``); each is written once per session and scale.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.session import scratch_path
from dossier.sources.sinks import write_snapshot
from dossier.sources.snapshots import path_exists
from dossier.sources.tables import Tables

_CACHE: dict[tuple, str] = {}

D = dt.date
# (version, load date, filter on o_orderdate) of the dated order snapshots
ORDER_SNAPSHOTS = [
    ("2", D(2023, 12, 1), None, "1996-01-01"),
    ("10", D(2024, 1, 1), None, "1997-01-01"),
    ("10", D(2024, 2, 1), "1996-01-01", "1999-01-01"),
    ("10", D(2024, 3, 1), "1998-01-01", None),
]


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def order_snapshot_frame(t: Tables, load_date: dt.date, lo: str | None, hi: str | None) -> DataFrame:
    o = t.orders
    if lo:
        o = o.where(F.col("o_orderdate") >= _ts(lo))
    if hi:
        o = o.where(F.col("o_orderdate") < _ts(hi))
    if load_date == D(2024, 2, 1):
        # orders of 1996 were closed by the second load
        o = o.withColumn("o_orderstatus", F.when(F.col("o_orderdate") < _ts("1997-01-01"), "F")
                         .otherwise(F.col("o_orderstatus")))
    return o


def order_snapshots(spark: SparkSession, sf_dir: str) -> str:
    """Root folder holding ``orders/<version>/load_date=.../`` snapshots."""
    key = (spark.sparkContext.applicationId, sf_dir, "orders")
    if key in _CACHE and path_exists(spark, _CACHE[key]):
        return _CACHE[key]
    root = scratch_path(spark, "snapshots")
    t = Tables(spark, sf_dir)
    for version, d, lo, hi in ORDER_SNAPSHOTS:
        write_snapshot(order_snapshot_frame(t, d, lo, hi), root, "orders", version, d)
    _CACHE[key] = root
    return root


def _sql_window(lo, hi):
    c = []
    if lo:
        c.append(f"o_orderdate >= TIMESTAMP '{lo}'")
    if hi:
        c.append(f"o_orderdate < TIMESTAMP '{hi}'")
    return " AND ".join(c) or "TRUE"


def order_snapshots_sql(version: str | None = "10") -> str:
    parts = []
    for v, d, lo, hi in ORDER_SNAPSHOTS:
        if version is not None and v != version:
            continue
        status = ("CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'F' ELSE o_orderstatus END"
                  if d == D(2024, 2, 1) else "o_orderstatus")
        parts.append(f"SELECT o_orderkey, o_custkey, {status} AS o_orderstatus, o_totalprice, "
                     f"o_orderdate, o_orderpriority, DATE '{d.isoformat()}' AS load_date "
                     f"FROM orders WHERE {_sql_window(lo, hi)}")
    return "snaps AS (" + "\nUNION ALL ".join(parts) + ")"


# customer versions for SCD2 / diff: (date, rule)
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def customer_versions(t: Tables) -> DataFrame:
    """Three dated customer snapshots: drop nation 0 in the second, change BUILDING balances
    from the second on, NULL segment for nation 1 in the third."""
    c = t.customer.select(*CUSTOMER_COLS)
    bump = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    v1 = c.withColumn("snapshot_date", F.lit("2024-01-01").cast("date"))
    v2 = (c.where(F.col("c_nationkey") != 0).withColumn("c_acctbal", bump)
          .withColumn("snapshot_date", F.lit("2024-02-01").cast("date")))
    v3 = (c.withColumn("c_acctbal", bump)
          .withColumn("c_mktsegment", F.when(F.col("c_nationkey") == 1, F.lit(None).cast("string"))
                      .otherwise(F.col("c_mktsegment")))
          .withColumn("snapshot_date", F.lit("2024-03-01").cast("date")))
    return v1.unionByName(v2).unionByName(v3)


CUSTOMER_VERSIONS_SQL = """
cv AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, DATE '2024-01-01' AS snapshot_date
  FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END,
         c_mktsegment, DATE '2024-02-01' FROM customer WHERE c_nationkey <> 0
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END,
         CASE WHEN c_nationkey = 1 THEN NULL ELSE c_mktsegment END, DATE '2024-03-01' FROM customer)"""
