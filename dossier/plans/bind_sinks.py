"""K-* sinks and table maintenance bound to the driver tables (written to the shared scratch folder)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from dossier.plans.common import T
from dossier.plans.registry import register
from dossier.session import scratch_path
from dossier.sources import sinks as K
from dossier.sources.tables import TABLES

D = dt.date


@register("k_01_write_snapshot", """
SELECT *, DATE '2024-01-31' AS load_date FROM customer""")
def k_01_write_snapshot(spark, sf):
    root = scratch_path(spark, "k01")
    path, n = K.write_snapshot(T(spark, sf).customer, root, "customer", "1", D(2024, 1, 31))
    return spark.read.parquet(path)


UPDATES_SQL = """
u AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT c_custkey + 1000000, 'New ' || c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_nationkey = 0)"""


def _updates(c):
    upd = c.where(F.col("c_mktsegment") == "BUILDING").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    new = c.where(F.col("c_nationkey") == 0).select(
        (F.col("c_custkey") + 1000000).alias("c_custkey"), F.concat(F.lit("New "), "c_name").alias("c_name"),
        "c_nationkey", "c_acctbal", "c_mktsegment")
    return upd.unionByName(new)


@register("k_02_upsert", f"""
WITH {UPDATES_SQL}
SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM u)
UNION ALL SELECT * FROM u""")
def k_02_upsert(spark, sf):
    c = T(spark, sf).customer
    return K.upsert(c, _updates(c), ["c_custkey"])


@register("k_03_conditional_update", """
WITH s AS (SELECT event_id, user_id, event_type, ts FROM events),
closing AS (SELECT event_id, lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS close_ts
            FROM s)
SELECT s.event_id, s.user_id, s.event_type, s.ts,
  CASE WHEN c.close_ts IS NOT NULL THEN c.close_ts END AS valid_to,
  CASE WHEN c.close_ts IS NOT NULL THEN 'closed' ELSE 'open' END AS status
FROM s LEFT JOIN closing c ON s.event_id = c.event_id""")
def k_03_conditional_update(spark, sf):
    from dossier.operators.ordered import ordered_scan
    e = T(spark, sf).events.select("event_id", "user_id", "event_type", "ts")
    target = e.withColumn("valid_to", F.lit(None).cast("timestamp_ntz")).withColumn("status", F.lit("open"))
    closing = (ordered_scan(e, ["user_id", "event_type"], ["ts", "event_id"], {"close_ts": ("lead", "ts")})
               .where(F.col("close_ts").isNotNull()).withColumn("new_status", F.lit("closed")))
    return K.conditional_update(target, closing, ["event_id"], {"valid_to": "close_ts", "status": "new_status"})


@register("k_04_append", """SELECT * FROM orders""")
def k_04_append(spark, sf):
    path = scratch_path(spark, "k04")
    o = T(spark, sf).orders
    K.append(o.where(F.col("o_orderstatus") == "F"), path)
    K.append(o.where(F.col("o_orderstatus") != "F"), path)
    return spark.read.parquet(path)


@register("k_05_full_load", """SELECT * FROM orders WHERE o_orderstatus = 'F'""")
def k_05_full_load(spark, sf):
    path = scratch_path(spark, "k05")
    o = T(spark, sf).orders
    K.full_load(o, path)
    K.full_load(o.where(F.col("o_orderstatus") == "F"), path)
    return spark.read.parquet(path)


@register("k_06_write_catalog_table", """SELECT * FROM customer""")
def k_06_write_catalog_table(spark, sf):
    db = "dossier_kyc"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, 'warehouse')}'")
    table = f"customer_{uuid.uuid4().hex[:8]}"
    K.write_catalog_table(spark, T(spark, sf).customer, db, table, scratch_path(spark, table),
                          partition_by=["c_mktsegment"], comment="customer copy")
    return spark.table(f"{db}.{table}")


@register("k_07_append_if_period_start", """
SELECT o_orderkey, o_orderstatus, DATE '1998-06-01' AS snapshot_date FROM orders
WHERE CAST(o_orderdate AS DATE) < DATE '1998-06-01'
UNION ALL
SELECT o_orderkey, o_orderstatus, DATE '1998-07-01' FROM orders
WHERE CAST(o_orderdate AS DATE) < DATE '1998-07-01'""")
def k_07_append_if_period_start(spark, sf):
    o = T(spark, sf).orders

    def snap(d):
        return o.where(F.to_date("o_orderdate") < F.lit(d.isoformat()).cast("date")) \
            .select("o_orderkey", "o_orderstatus")
    hist = snap(D(1998, 6, 1)).withColumn("snapshot_date", F.lit("1998-06-01").cast("date"))
    for d in (D(1998, 7, 1), D(1998, 6, 1), D(1998, 7, 15)):  # append, already there, not a month start
        hist = K.append_if_period_start(hist, snap(d), d)
    return hist


@register("k_08_append_missing_periods", """
SELECT l_orderkey, l_linenumber, l_partkey, date_trunc('month', l_shipdate)::DATE AS ship_month
FROM lineitem""")
def k_08_append_missing_periods(spark, sf):
    li = T(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                                      F.trunc(F.to_date("l_shipdate"), "month").alias("ship_month"))
    target = li.where(F.col("ship_month") < F.lit("1998-01-01").cast("date"))
    return K.append_missing_periods(target, li, "ship_month")


@register("k_09_replace_period", """
WITH li AS (SELECT l_orderkey, l_linenumber, l_tax, date_trunc('month', l_shipdate)::DATE AS refresh_month
            FROM lineitem)
SELECT * FROM li WHERE refresh_month <> DATE '1998-12-01'
UNION ALL
SELECT l_orderkey, l_linenumber, l_tax * 2, refresh_month FROM li WHERE refresh_month = DATE '1998-12-01'""")
def k_09_replace_period(spark, sf):
    li = T(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_tax",
                                      F.trunc(F.to_date("l_shipdate"), "month").alias("refresh_month"))
    new = li.withColumn("l_tax", F.col("l_tax") * 2)
    return K.replace_period(li, new, "refresh_month", F.lit("1998-12-01").cast("date"))


@register("k_10_row_corrections", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderstatus = 'P' AND o_totalprice > 450000 THEN '1-URGENT' ELSE o_orderpriority END
    AS o_orderpriority
FROM orders WHERE NOT (o_totalprice < 1000 OR o_orderdate < TIMESTAMP '1995-01-08')""")
def k_10_row_corrections(spark, sf):
    o = T(spark, sf).orders
    deletes = o.where((F.col("o_totalprice") < 1000) | (F.col("o_orderdate") < F.lit("1995-01-08")
                                                         .cast("timestamp_ntz"))) \
        .select("o_orderkey", F.lit("delete").alias("action"), F.lit(None).cast("string").alias("o_orderpriority"))
    updates = o.where((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 450000)) \
        .select("o_orderkey", F.lit("update").alias("action"), F.lit("1-URGENT").alias("o_orderpriority"))
    return K.row_corrections(o, ["o_orderkey"], deletes.unionByName(updates))


@register("k_11_load_log", " UNION ALL ".join(
    f"SELECT '{t}' AS object, TRUE AS exists, count(*) AS n_rows, DATE '2024-01-31' AS load_date FROM {t}"
    for t in TABLES) + " UNION ALL SELECT 'missing_table', FALSE, 0, DATE '2024-01-31'")
def k_11_load_log(spark, sf):
    t = T(spark, sf)
    frames = {name: t.__getattr__(name).select(F.lit(1).alias("x")) for name in TABLES}
    frames["missing_table"] = None
    return K.load_log(frames, D(2024, 1, 31))


@register("k_12_export_delimited", """SELECT * FROM supplier""")
def k_12_export_delimited(spark, sf):
    path = scratch_path(spark, "k12")
    K.export_delimited(T(spark, sf).supplier, path)
    return spark.read.schema("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double") \
        .option("sep", "|").option("header", True).csv(f"{path}/data")


@register("k_13_clean_column_names", """
SELECT p_partkey, p_name, p_brand, p_type, p_size AS p_size_cm, p_retailprice AS retail_price_eur
FROM part""")
def k_13_clean_column_names(spark, sf):
    messy = T(spark, sf).part.toDF(" P.Partkey ", "p--Name!!", "P Brand#", "p_Type__", "p size (cm)",
                                   "Retail Price (EUR)")
    return K.clean_column_names(messy)


@register("k_14_catalog_inventory")
def k_14_catalog_inventory(spark, sf):
    t = T(spark, sf)
    return K.catalog_inventory(spark, {name: t.__getattr__(name) for name in TABLES})
