"""H-01..H-06 (history) and P-08 bound to customer versions and orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dossier.operators import history as H
from dossier.operators.relational import current_rows
from dossier.plans.common import T
from dossier.plans.fixtures import CUSTOMER_COLS, CUSTOMER_VERSIONS_SQL, customer_versions
from dossier.plans.registry import register

D = dt.date
COLS = ", ".join(CUSTOMER_COLS)


def _match(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in CUSTOMER_COLS)


def _step(prev: str, snap: str, d: str) -> str:
    """One SCD2 merge step written as SQL (independent of the Spark closed form)."""
    gone = f"NOT EXISTS (SELECT 1 FROM {snap} s WHERE {_match('p', 's')})"
    return f"""(
  SELECT {COLS}, start_date,
    CASE WHEN is_active = 'Y' AND {gone} THEN DATE '{d}' ELSE end_date END AS end_date,
    CASE WHEN is_active = 'Y' AND {gone} THEN 'N' ELSE is_active END AS is_active
  FROM {prev} p
  UNION ALL
  SELECT {COLS}, DATE '{d}', DATE '9999-12-31', 'Y' FROM {snap} s
  WHERE NOT EXISTS (SELECT 1 FROM {prev} p WHERE p.is_active = 'Y' AND {_match('p', 's')}))"""


SCD_SQL = f"""
WITH {CUSTOMER_VERSIONS_SQL},
s1 AS (SELECT DISTINCT {COLS} FROM cv WHERE snapshot_date = DATE '2024-01-01'),
s2 AS (SELECT DISTINCT {COLS} FROM cv WHERE snapshot_date = DATE '2024-02-01'),
s3 AS (SELECT DISTINCT {COLS} FROM cv WHERE snapshot_date = DATE '2024-03-01'),
t1 AS (SELECT {COLS}, DATE '2024-01-01' AS start_date, DATE '9999-12-31' AS end_date, 'Y' AS is_active
       FROM s1),
t2 AS {_step('t1', 's2', '2024-02-01')},
t3 AS {_step('t2', 's3', '2024-03-01')}"""


@register("h_01_scd2_merge", SCD_SQL + " SELECT * FROM t2")
def h_01_scd2_merge(spark, sf):
    cv = customer_versions(T(spark, sf))
    v1 = cv.where(F.col("snapshot_date") == F.lit("2024-01-01").cast("date"))
    v2 = cv.where(F.col("snapshot_date") == F.lit("2024-02-01").cast("date"))
    target = H.scd2_init(v1, CUSTOMER_COLS, D(2024, 1, 1))
    return H.scd2_merge(target, v2, CUSTOMER_COLS, D(2024, 2, 1)).drop("row_hash")


@register("h_02_scd2_replay", SCD_SQL + " SELECT * FROM t3")
def h_02_scd2_replay(spark, sf):
    cv = customer_versions(T(spark, sf))
    return H.scd2_replay(cv, CUSTOMER_COLS, "snapshot_date").drop("row_hash")


@register("p_08_current_rows", SCD_SQL + """
SELECT * FROM t3 WHERE end_date = DATE '9999-12-31' AND is_active = 'Y'""")
def p_08_current_rows(spark, sf):
    cv = customer_versions(T(spark, sf))
    scd = H.scd2_replay(cv, CUSTOMER_COLS, "snapshot_date").drop("row_hash")
    return current_rows(scd, "end_date", deleted=None).where(F.col("is_active") == "Y")


@register("h_03_merge_live_history", """
WITH live AS (
  SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         CAST(NULL AS BOOLEAN) AS archived
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
hist AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         CAST(NULL AS VARCHAR) AS o_orderpriority, TRUE AS archived
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01')
SELECT * FROM live
UNION ALL SELECT * FROM hist WHERE o_orderkey NOT IN (SELECT o_orderkey FROM live)""")
def h_03_merge_live_history(spark, sf):
    o = T(spark, sf).orders
    live = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) \
        .withColumn("o_orderstatus", F.lit("F"))
    hist = o.where(F.col("o_orderdate") < F.lit("1998-06-01").cast("timestamp_ntz")) \
        .drop("o_orderpriority").withColumn("archived", F.lit(True))
    return H.merge_live_history(live, hist, ["o_orderkey"])


@register("h_04_history_window", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE (CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31')
   OR (CAST(o_orderdate AS DATE) BETWEEN DATE '2000-06-01' AND DATE '2001-03-14')""")
def h_04_history_window(spark, sf):
    o = T(spark, sf).orders.select("o_orderkey", "o_orderdate")
    return H.history_window(o, "o_orderdate", requested=D(2001, 3, 15), cutoff=D(1999, 12, 31),
                            hist_start=D(1996, 1, 1), ongoing_start=D(2000, 6, 1))


@register("h_04_history_window_one_time", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-03-31'""")
def h_04_history_window_one_time(spark, sf):
    o = T(spark, sf).orders.select("o_orderkey", "o_orderdate")
    return H.history_window(o, "o_orderdate", requested=D(1998, 3, 31), cutoff=D(1999, 12, 31),
                            hist_start=D(1996, 1, 1), ongoing_start=D(2000, 6, 1))


ACTIVE_SQL = """
WITH x AS (
  SELECT o_orderkey,
    CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS hub_state,
    CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN 'DL' ELSE 'AC' END AS status_cd,
    CASE WHEN o_totalprice > 100000 THEN 'T24RURAL' WHEN o_totalprice > 50000 THEN 'OMB'
         ELSE 'OTHER' END AS src_sys
  FROM orders)"""


@register("h_05_active_records", ACTIVE_SQL + """
SELECT o_orderkey, hub_state, coalesce(status_cd, 'AC') AS status_cd, src_sys FROM x
WHERE hub_state = 1 AND src_sys IN ('T24RURAL', 'OMB')
  AND coalesce(status_cd, 'AC') NOT IN ('DL', 'RD', 'WD')""")
def h_05_active_records(spark, sf):
    o = T(spark, sf).orders
    x = o.select("o_orderkey",
                 F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(1).alias("hub_state"),
                 F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
                 .when(F.col("o_orderstatus") == "O", "DL").otherwise("AC").alias("status_cd"),
                 F.when(F.col("o_totalprice") > 100000, "T24RURAL").when(F.col("o_totalprice") > 50000, "OMB")
                 .otherwise("OTHER").alias("src_sys"))
    return H.active_records(x, "status_cd", ["DL", "RD", "WD"], hub_col="hub_state", source_col="src_sys",
                            allowed_sources=["T24RURAL", "OMB"])


@register("h_06_snapshot_diff", f"""
WITH {CUSTOMER_VERSIONS_SQL},
o AS (SELECT * FROM cv WHERE snapshot_date = DATE '2024-02-01'),
n AS (SELECT * FROM cv WHERE snapshot_date = DATE '2024-03-01' AND c_nationkey <> 2),
j AS (
  SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
    CASE WHEN o.c_custkey IS NULL THEN 'new' WHEN n.c_custkey IS NULL THEN 'deleted'
         WHEN o.c_name IS DISTINCT FROM n.c_name OR o.c_nationkey IS DISTINCT FROM n.c_nationkey
           OR o.c_acctbal IS DISTINCT FROM n.c_acctbal OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment
         THEN 'changed' END AS change_type,
    CASE WHEN n.c_custkey IS NULL THEN o.c_name ELSE n.c_name END AS c_name,
    CASE WHEN n.c_custkey IS NULL THEN o.c_nationkey ELSE n.c_nationkey END AS c_nationkey,
    CASE WHEN n.c_custkey IS NULL THEN o.c_acctbal ELSE n.c_acctbal END AS c_acctbal,
    CASE WHEN n.c_custkey IS NULL THEN o.c_mktsegment ELSE n.c_mktsegment END AS c_mktsegment
  FROM o FULL OUTER JOIN n ON o.c_custkey = n.c_custkey)
SELECT *, change_type IN ('new', 'changed') AS in_upsert FROM j WHERE change_type IS NOT NULL""")
def h_06_snapshot_diff(spark, sf):
    cv = customer_versions(T(spark, sf))
    old = cv.where(F.col("snapshot_date") == F.lit("2024-02-01").cast("date"))
    new = cv.where((F.col("snapshot_date") == F.lit("2024-03-01").cast("date")) & (F.col("c_nationkey") != 2))
    return H.snapshot_diff(old, new, ["c_custkey"], ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
