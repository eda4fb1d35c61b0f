"""Shared bindings of the domain to the driver tables.

party = customer (system CUS, rank 1) and supplier (system SUP, rank 2);
local id ``CUS_<key>`` / ``SUP_<key>``; platform id ``P<key zero-padded>``
(customer k and supplier k are the same party); case = orders (status F =
approved); work item = lineitem / events; location = nation / region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.operators.identity import build_typed_id
from dossier.operators.relational import union_by_name
from dossier.sources.tables import Tables

AS_OF = "1998-08-02"          # fixed 'today' of the case queries
EVENTS_AS_OF = "2024-01-31"   # fixed 'today' of the event queries


def T(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def party_id(key) -> F.Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("P"), F.lpad(k.cast("string"), 10, "0"))


def parties(t: Tables) -> DataFrame:
    """Both source systems in one frame, aligned by name (U-03)."""
    cus = t.customer.select(
        build_typed_id("c_custkey", "CUS_").alias("local_id"),
        F.lit("CUS").alias("source"), F.lit(1).alias("source_rank"),
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"))
    sup = t.supplier.select(
        build_typed_id("s_suppkey", "SUP_").alias("local_id"),
        F.lit("SUP").alias("source"), F.lit(2).alias("source_rank"),
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return union_by_name(cus, sup)


def crosswalk(t: Tables) -> DataFrame:
    """Local id -> platform id, derived from both systems."""
    a = t.customer.select(build_typed_id("c_custkey", "CUS_").alias("local_id"),
                          party_id("c_custkey").alias("party_id"))
    b = t.supplier.select(build_typed_id("s_suppkey", "SUP_").alias("local_id"),
                          party_id("s_suppkey").alias("party_id"))
    return a.unionByName(b)


PARTIES_SQL = """
parties AS (
  SELECT 'CUS_' || CAST(c_custkey AS VARCHAR) AS local_id, 'CUS' AS source, 1 AS source_rank,
         c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
         c_mktsegment AS mktsegment
  FROM customer
  UNION ALL
  SELECT 'SUP_' || CAST(s_suppkey AS VARCHAR), 'SUP', 2, s_suppkey, s_name, s_nationkey, s_acctbal,
         CAST(NULL AS VARCHAR)
  FROM supplier),
crosswalk AS (
  SELECT 'CUS_' || CAST(c_custkey AS VARCHAR) AS local_id,
         'P' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS party_id FROM customer
  UNION ALL
  SELECT 'SUP_' || CAST(s_suppkey AS VARCHAR), 'P' || lpad(CAST(s_suppkey AS VARCHAR), 10, '0')
  FROM supplier)"""


def blank_sql(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN ('', 'null') THEN NULL ELSE {c} END"
