"""S-* sources and snapshot selection bound to the driver tables (and snapshots derived from them)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dossier.plans.common import EVENTS_AS_OF, T
from dossier.plans.fixtures import order_snapshots, order_snapshots_sql
from dossier.plans.registry import register
from dossier.session import scratch_path
from dossier.sources import files as FL
from dossier.sources import snapshots as S

D = dt.date
SNAPS = order_snapshots_sql("10")
SNAPS_V2 = order_snapshots_sql("2")
ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@register("s_01_scan_parquet", """SELECT * FROM lineitem""")
def s_01_scan_parquet(spark, sf):
    from dossier.sources.tables import scan_parquet
    return scan_parquet(spark, f"{sf}/lineitem.parquet")


@register("s_02_scan_latest_snapshot", f"""
WITH {SNAPS} SELECT * FROM snaps WHERE load_date = DATE '2024-03-01'""")
def s_02_scan_latest_snapshot(spark, sf):
    return S.scan_latest_snapshot(spark, order_snapshots(spark, sf), "orders")


@register("s_03_scan_exact_snapshot", f"""
WITH {SNAPS} SELECT * FROM snaps WHERE load_date = DATE '2024-02-01'""")
def s_03_scan_exact_snapshot(spark, sf):
    # 2024-02-02 is absent; the previous day is allowed for this source
    return S.scan_exact_snapshot(spark, order_snapshots(spark, sf), "orders", D(2024, 2, 2),
                                 allow_previous_day=True)


@register("s_04_resolve_version", f"""
WITH {SNAPS_V2} SELECT * FROM snaps""")
def s_04_resolve_version(spark, sf):
    return S.scan_latest_snapshot(spark, order_snapshots(spark, sf), "orders",
                                  mapping=S.version_map({"sales": {"1": ["lineitem"], "2": ["orders"]}}, "sales"))


@register("s_05_scan_asof_snapshot", f"""
WITH {SNAPS} SELECT * FROM snaps WHERE load_date = DATE '2024-02-01'""")
def s_05_scan_asof_snapshot(spark, sf):
    return S.scan_asof_snapshot(spark, order_snapshots(spark, sf), "orders", D(2024, 2, 15),
                                max_age_days=30)


@register("s_06_scan_snapshot_range", f"""
WITH {SNAPS} SELECT * FROM snaps WHERE load_date BETWEEN DATE '2024-01-15' AND DATE '2024-03-01'
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY load_date DESC) = 1""")
def s_06_scan_snapshot_range(spark, sf):
    return S.scan_snapshot_range(spark, order_snapshots(spark, sf), "orders", D(2024, 1, 15),
                                 D(2024, 3, 2), ["o_orderkey"], max_age_days=31)


@register("s_07_scan_all_snapshots", f"""
WITH {SNAPS} SELECT * FROM snaps
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY load_date DESC) = 1""")
def s_07_scan_all_snapshots(spark, sf):
    return S.scan_all_snapshots(spark, order_snapshots(spark, sf), "orders", ["o_orderkey"])


@register("s_08_freshness_guard", f"""
SELECT max(CAST(ts AS DATE)) AS newest_date,
       CAST(DATE '{EVENTS_AS_OF}' - max(CAST(ts AS DATE)) AS INTEGER) AS age_days
FROM events""")
def s_08_freshness_guard(spark, sf):
    return S.freshness_guard(T(spark, sf).events, "ts", D.fromisoformat(EVENTS_AS_OF), 7)


@register("s_09_empty_like", """SELECT * FROM orders WHERE FALSE""")
def s_09_empty_like(spark, sf):
    return S.empty_like(T(spark, sf).orders)


@register("s_10_partition_from_path", f"""
WITH {SNAPS} SELECT load_date AS path_date, count(*) AS n_rows FROM snaps GROUP BY 1""")
def s_10_partition_from_path(spark, sf):
    root = order_snapshots(spark, sf)
    df = spark.read.parquet(f"{root}/orders/10/*")  # no partition discovery: date only in the path
    return df.groupBy(S.partition_from_path("path_date")).agg(F.count(F.lit(1)).alias("n_rows"))


def _region_csv(spark, sf):
    path = scratch_path(spark, "region_csv")
    T(spark, sf).region.write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
    return path


@register("s_11_scan_csv", """SELECT * FROM region""")
def s_11_scan_csv(spark, sf):
    return FL.scan_csv(spark, _region_csv(spark, sf), "r_regionkey int, r_name string", sep=";")


def _framed(spark, sf):
    path = scratch_path(spark, "framed")
    FL.write_framed_fixture(T(spark, sf).supplier, path)
    return path


@register("s_12_scan_framed_text")
def s_12_scan_framed_text(spark, sf):
    return FL.scan_framed_text(spark, _framed(spark, sf), n_fields=5)


@register("s_13_rename_positional", """
WITH c AS (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1)
SELECT '1' AS record_code, s_suppkey AS suppkey, s_name AS name, s_nationkey AS nationkey,
       s_acctbal AS acctbal
FROM supplier JOIN c USING (s_nationkey) WHERE n + 2 > 4""")
def s_13_rename_positional(spark, sf):
    raw = FL.scan_framed_text(spark, _framed(spark, sf), n_fields=5)
    return FL.rename_positional(raw, [("record_code", "string"), ("suppkey", "bigint"), ("name", "string"),
                                      ("nationkey", "int"), ("acctbal", "double")])


# Region code per region key (the static lookup of S-14).
REGION_CODES = [(0, "AF"), (1, "AM"), (2, "AS"), (3, "EU"), (4, "ME")]


@register("s_14_static_lookup", """
SELECT n_nationkey, n_name, c.code AS region_code FROM nation
LEFT JOIN (VALUES (0, 'AF'), (1, 'AM'), (2, 'AS'), (3, 'EU'), (4, 'ME')) c(k, code)
  ON n_regionkey = c.k""")
def s_14_static_lookup(spark, sf):
    lk = spark.createDataFrame(REGION_CODES, "k int, code string")
    n = T(spark, sf).nation
    # a literal table: its size is fixed by the code, a broadcast is safe
    return n.join(F.broadcast(lk), F.col("n_regionkey") == F.col("k"), "left") \
        .select("n_nationkey", "n_name", F.col("code").alias("region_code"))


@register("s_15_file_inventory")
def s_15_file_inventory(spark, sf):
    target = scratch_path(spark, "copy")
    for name in ("region", "nation"):  # the copy holds only two of the tables
        T(spark, sf).__getattr__(name).write.mode("overwrite").parquet(f"{target}/{name}.parquet")
    src = FL.file_inventory(spark, f"{sf}/*.parquet")
    dst = FL.file_inventory(spark, f"{target}/*.parquet/*.parquet", name_depth=2).distinct()
    return FL.missing_files(src, dst)


@register("s_16_normalize_mixed_dates", r"""
WITH x AS (
  SELECT o_orderkey,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown'
         WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
         WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%d/%m/%Y')
         ELSE CAST(CAST(o_orderdate AS DATE) - DATE '1899-12-30' AS VARCHAR) END AS raw
  FROM orders),
p AS (
  SELECT o_orderkey, raw,
    CASE WHEN regexp_matches(raw, '^[0-9]{1,5}$') THEN DATE '1899-12-30' + CAST(raw AS INTEGER)
         WHEN regexp_matches(raw, '^[0-9]{2}/[0-9]{2}/[0-9]{4}$') THEN try_strptime(raw, '%d/%m/%Y')::DATE
         WHEN regexp_matches(raw, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN try_strptime(raw, '%Y-%m-%d')::DATE
    END AS parsed_date
  FROM x)
SELECT o_orderkey, parsed_date, CASE WHEN parsed_date IS NULL THEN raw END AS text_value FROM p""")
def s_16_normalize_mixed_dates(spark, sf):
    o = T(spark, sf).orders
    raw = (F.when(F.col("o_orderpriority") == "5-LOW", "unknown")
           .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
           .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd/MM/yyyy"))
           .otherwise(F.datediff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date")).cast("string")))
    x = o.select("o_orderkey", raw.alias("raw"))
    parsed = FL.normalize_mixed_date("raw")
    return x.select("o_orderkey", parsed.alias("parsed_date"),
                    F.when(parsed.isNull(), F.col("raw")).alias("text_value"))


@register("s_17_high_water_mark_load", f"""
WITH {SNAPS}
SELECT * FROM snaps
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY load_date DESC) = 1""")
def s_17_high_water_mark_load(spark, sf):
    root = order_snapshots(spark, sf)
    target = S.scan_exact_snapshot(spark, root, "orders", D(2024, 1, 1))
    source = spark.read.option("basePath", f"{root}/orders/10").parquet(f"{root}/orders/10")
    return S.high_water_mark_load(target, source, ["o_orderkey"], "load_date")


@register("s_18_missing_snapshots", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
s AS (SELECT user_id, min(d) AS lo, max(d) AS hi FROM d GROUP BY user_id),
cal AS (SELECT user_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM s),
m AS (SELECT * FROM cal EXCEPT SELECT * FROM d)
SELECT s.user_id, CAST(count(m.d) AS INTEGER) AS n_missing,
  coalesce(array_to_string(list_sort(list(strftime(m.d, '%Y-%m-%d')) FILTER (WHERE m.d IS NOT NULL)), ','), '')
    AS missing
FROM s LEFT JOIN m ON s.user_id = m.user_id GROUP BY s.user_id""")
def s_18_missing_snapshots(spark, sf):
    m = S.missing_snapshots(T(spark, sf).events, "ts", ["user_id"])
    return m.select("user_id", F.size("missing_dates").alias("n_missing"),
                    F.array_join(F.transform("missing_dates", lambda d: F.date_format(d, "yyyy-MM-dd")), ",")
                    .alias("missing"))


@register("s_19_missing_dates", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS missing_date FROM d
EXCEPT SELECT d FROM d""")
def s_19_missing_dates(spark, sf):
    return S.missing_dates(T(spark, sf).orders, "o_orderdate")


BACKFILL_DATES = [D(1998, m, 1) - dt.timedelta(days=1) for m in range(2, 8)]


@register("s_20_backfill", """
WITH a(as_of) AS (VALUES """ + ", ".join(f"(DATE '{d}')" for d in BACKFILL_DATES) + """)
SELECT o_orderstatus, count(*) AS n_orders, as_of FROM orders JOIN a
  ON CAST(o_orderdate AS DATE) <= a.as_of GROUP BY o_orderstatus, as_of""")
def s_20_backfill(spark, sf):
    return S.counts_as_of(T(spark, sf).orders, ["o_orderstatus"], "o_orderdate", BACKFILL_DATES, out="n_orders")


@register("s_20_backfill_valid", """
WITH a(as_of) AS (VALUES """ + ", ".join(f"(DATE '{d}')" for d in BACKFILL_DATES) + """)
SELECT o_orderpriority, count(*) AS n_open, as_of FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN a
  ON CAST(o_orderdate AS DATE) <= a.as_of AND CAST(l_shipdate AS DATE) > a.as_of GROUP BY o_orderpriority, as_of""")
def s_20_backfill_valid(spark, sf):
    """Lines ordered but not yet shipped on each date."""
    t = T(spark, sf)
    lines = t.lineitem.select("l_orderkey", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    return S.counts_as_of(lines, ["o_orderpriority"], "o_orderdate", BACKFILL_DATES, valid_to="l_shipdate", out="n_open")


@register("s_21_period_calendar", """
WITH m AS (SELECT date_trunc('month', max(l_shipdate))::DATE AS last_loaded FROM lineitem
           WHERE l_linestatus = 'F'),
cal AS (SELECT CAST(unnest(generate_series(last_loaded + INTERVAL 1 MONTH, DATE '2002-05-01',
                                           INTERVAL 1 MONTH)) AS DATE) AS m FROM m)
SELECT CAST(year(m) AS INTEGER) AS yr, CAST(month(m) AS INTEGER) AS mo FROM cal""")
def s_21_period_calendar(spark, sf):
    li = T(spark, sf).lineitem.where(F.col("l_linestatus") == "F")
    last = li.agg(F.max(F.to_date("l_shipdate")).alias("last_loaded"))
    cal = last.select(F.explode(S.period_calendar(F.col("last_loaded"), D(2002, 6, 15))).alias("m"))
    return cal.select(F.year("m").alias("yr"), F.month("m").alias("mo"))


@register("s_17_high_water_mark_stream", f"""
WITH {SNAPS}
SELECT * FROM snaps
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY load_date DESC) = 1""")
def s_17_high_water_mark_stream(spark, sf):
    """S-17 + K-02 as Structured Streaming: availableNow file stream, foreachBatch upsert."""
    from dossier.streaming.incremental import incremental_snapshot_load
    root = order_snapshots(spark, sf)
    src = f"{root}/orders/10"
    schema = spark.read.option("basePath", src).parquet(src).schema
    return incremental_snapshot_load(spark, src, schema, scratch_path(spark, "stream_target"),
                                     scratch_path(spark, "stream_ckpt"), ["o_orderkey"],
                                     max_files_per_trigger=2, buckets=32)
