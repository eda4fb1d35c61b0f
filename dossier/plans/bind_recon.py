"""Q-01..Q-04, Q-14..Q-17: reconciliation and screening bound to customer / supplier / part / nation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dossier.functions.text import ABBREVIATIONS, ACCENTED, PLAIN, normalize_name
from dossier.operators import recon as RC
from dossier.operators.pick import dedupe_latest
from dossier.plans.bind_sources import REGION_CODES
from dossier.plans.common import T
from dossier.plans.fixtures import CUSTOMER_VERSIONS_SQL, customer_versions
from dossier.plans.registry import register

D = dt.date


def norm_sql(x: str) -> str:
    """DuckDB twin of ``normalize_name``."""
    s = f"translate({x}, '{ACCENTED}', '{PLAIN}')"
    for short, long_, word in ABBREVIATIONS:
        pat = rf"(?i)\b{short}\b\.?" if word else short
        s = f"regexp_replace({s}, '{pat}', '{long_}', 'g')"
    return f"lower(trim(regexp_replace({s}, '[^a-zA-Z0-9]', '', 'g')))"


def tier_sql(a: str, b: str) -> str:
    return (f"CASE WHEN lower(trim({a})) = lower(trim({b})) THEN 1 WHEN {norm_sql(a)} = {norm_sql(b)} THEN 3 "
            f"WHEN {a} IS NULL OR trim({a}) = '' OR {b} IS NULL OR trim({b}) = '' THEN 2 ELSE 0 END")


B_SQL = """
a AS (SELECT c_custkey, c_name AS name, c_mktsegment AS segment FROM customer),
b AS (
  SELECT c_custkey,
    CASE WHEN c_nationkey = 1 THEN upper(c_name) WHEN c_nationkey = 2 THEN replace(c_name, 'Customer#', 'Cüstomer #')
         WHEN c_nationkey = 3 THEN NULL WHEN c_nationkey = 4 THEN 'Other' ELSE c_name END AS name,
    CASE WHEN c_nationkey = 5 THEN lower(c_mktsegment) || ' ' ELSE c_mktsegment END AS segment
  FROM customer WHERE c_nationkey <> 6
  UNION ALL
  SELECT c_custkey + 100000, c_name, c_mktsegment FROM customer WHERE c_nationkey = 7)"""


def _systems(t):
    c = t.customer
    a = c.select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    name_b = (F.when(F.col("c_nationkey") == 1, F.upper("c_name"))
              .when(F.col("c_nationkey") == 2, F.replace("c_name", F.lit("Customer#"), F.lit("Cüstomer #")))
              .when(F.col("c_nationkey") == 3, F.lit(None).cast("string"))
              .when(F.col("c_nationkey") == 4, F.lit("Other")).otherwise(F.col("c_name")))
    seg_b = F.when(F.col("c_nationkey") == 5, F.concat(F.lower("c_mktsegment"), F.lit(" "))) \
        .otherwise(F.col("c_mktsegment"))
    b = c.where(F.col("c_nationkey") != 6).select("c_custkey", name_b.alias("name"), seg_b.alias("segment"))
    extra = c.where(F.col("c_nationkey") == 7).select((F.col("c_custkey") + 100000).alias("c_custkey"),
                                                      F.col("c_name").alias("name"),
                                                      F.col("c_mktsegment").alias("segment"))
    return a, b.unionByName(extra)


@register("q_01_match_tier", f"""
WITH {B_SQL}
SELECT a.c_custkey, {tier_sql('a.name', 'b.name')} AS name_tier FROM a JOIN b ON a.c_custkey = b.c_custkey""")
def q_01_match_tier(spark, sf):
    a, b = _systems(T(spark, sf))
    j = a.join(b.withColumnRenamed("name", "name_b").withColumnRenamed("segment", "segment_b"), "c_custkey")
    return j.select("c_custkey", RC.match_tier("name", "name_b").alias("name_tier"))


@register("q_02_normalize_name", f"""
WITH x AS (SELECT s_suppkey, s_name || CASE WHEN s_nationkey < 5 THEN ' Ltd.' WHEN s_nationkey < 10
             THEN ' DAC Ltda' ELSE ' Société Générale' END AS raw_name FROM supplier)
SELECT s_suppkey, raw_name, {norm_sql('raw_name')} AS normalized FROM x""")
def q_02_normalize_name(spark, sf):
    s = T(spark, sf).supplier
    suffix = (F.when(F.col("s_nationkey") < 5, " Ltd.").when(F.col("s_nationkey") < 10, " DAC Ltda")
              .otherwise(" Société Générale"))
    x = s.select("s_suppkey", F.concat("s_name", suffix).alias("raw_name"))
    return x.select("s_suppkey", "raw_name", normalize_name("raw_name").alias("normalized"))


@register("q_03_system_comparison", f"""
WITH {B_SQL}
SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, a.c_custkey IS NOT NULL AS in_a,
       b.c_custkey IS NOT NULL AS in_b, a.name AS name_a, b.name AS name_b,
       {tier_sql('a.name', 'b.name')} AS name_tier, a.segment AS segment_a, b.segment AS segment_b,
       {tier_sql('a.segment', 'b.segment')} AS segment_tier
FROM a FULL OUTER JOIN b ON a.c_custkey = b.c_custkey""")
def q_03_system_comparison(spark, sf):
    a, b = _systems(T(spark, sf))
    return RC.system_comparison(a, b, "c_custkey", ["name", "segment"])


@register("q_04_missing_in_other", """
WITH a AS (SELECT p_partkey, p_type AS code FROM part WHERE p_size < 30),
b0 AS (SELECT DISTINCT l_partkey AS p_partkey,
         CASE WHEN p_type = 'PROMO' THEN 'PROMOTION' ELSE p_type END AS code
       FROM lineitem JOIN part ON l_partkey = p_partkey),
b AS (SELECT p_partkey, CASE WHEN code = 'PROMOTION' THEN 'PROMO' ELSE code END AS code FROM b0)
SELECT DISTINCT p_partkey, code, 'missing_in_b' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL
SELECT DISTINCT p_partkey, code, 'missing_in_a' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def q_04_missing_in_other(spark, sf):
    t = T(spark, sf)
    a = t.part.where(F.col("p_size") < 30).select("p_partkey", F.col("p_type").alias("code"))
    b = (t.lineitem.select("l_partkey").join(t.part, F.col("l_partkey") == F.col("p_partkey"))
         .select("p_partkey", F.when(F.col("p_type") == "PROMO", "PROMOTION").otherwise(F.col("p_type")).alias("code"))
         .distinct())
    mapping = spark.createDataFrame([("PROMOTION", "PROMO")], "from_value string, to_value string")
    return RC.missing_in_other(a, b, ["p_partkey", "code"], mapping, map_col="code")


REGION_VALUES = ", ".join(f"({k}, '{c}')" for k, c in REGION_CODES)

SCREEN_SQL = f"""
WITH {CUSTOMER_VERSIONS_SQL},
rc(k, code) AS (VALUES {REGION_VALUES}),
latest AS (SELECT * FROM cv QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY snapshot_date DESC) = 1),
parties AS (
  SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN n_name END AS country,
         CASE WHEN c_nationkey >= 20 THEN rc.code END AS iso
  FROM latest JOIN nation ON c_nationkey = n_nationkey JOIN rc ON rc.k = n_regionkey),
lists AS (
  SELECT r_name AS tab, CASE WHEN r_regionkey % 2 = 0 THEN rc.code END AS iso, unnest(string_split(
           string_agg(CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) WHEN n_nationkey % 5 = 0 THEN 'former ' || n_name
                           ELSE n_name END, '~' ORDER BY n_name), '~')) AS list_name
  FROM region JOIN nation ON n_regionkey = r_regionkey JOIN rc ON rc.k = r_regionkey
  GROUP BY r_name, r_regionkey, rc.code),
hits AS (
  SELECT DISTINCT c_custkey, tab AS list_tab FROM parties JOIN lists
    ON lower(trim(parties.country)) = lower(trim(lists.list_name))
    OR lower(trim(parties.iso)) = lower(trim(lists.iso))),
hits_l AS (SELECT *, 'Sanction hit: ' || list_tab AS hit_label FROM hits)"""


def _screening(spark, sf):
    t = T(spark, sf)
    cv = customer_versions(t)
    latest = dedupe_latest(cv, ["c_custkey"], [F.col("snapshot_date").desc()])
    rc = spark.createDataFrame(REGION_CODES, "k int, code string")
    parties = (latest.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
               .join(F.broadcast(rc), F.col("n_regionkey") == F.col("k"))
               .select("c_custkey", F.when(F.col("c_nationkey") < 20, F.col("n_name")).alias("country"),
                       F.when(F.col("c_nationkey") >= 20, F.col("code")).alias("iso")))
    # lists of all regions; some names match no country, and some lists have no code
    names = (F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name"))
             .when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit("former "), "n_name")).otherwise(F.col("n_name")))
    lists = (t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey"))
             .join(F.broadcast(rc), F.col("k") == F.col("r_regionkey"))
             .groupBy(F.col("r_name").alias("tab"), F.when(F.col("r_regionkey") % 2 == 0, F.col("code")).alias("iso"))
             .agg(F.concat_ws("~", F.transform(F.array_sort(F.collect_list(F.struct("n_name", names.alias("v")))),
                                               lambda s: s.getField("v"))).alias("names")))
    lists = RC.explode_watch_list(lists, "names")
    return RC.list_screening(parties, lists, "c_custkey", "country", "iso", "list_name", "iso", "tab")


@register("q_14_list_screening", SCREEN_SQL + " SELECT * FROM hits_l")
def q_14_list_screening(spark, sf):
    return _screening(spark, sf)


@register("q_15_new_hits", SCREEN_SQL + """,
hist AS (SELECT h.c_custkey, h.list_tab, DATE '2024-01-01' AS first_alert FROM hits h
         JOIN customer c ON c.c_custkey = h.c_custkey WHERE c.c_acctbal > 5000)
SELECT hits_l.*, CASE WHEN hist.first_alert IS NULL THEN 1 ELSE 0 END AS new_hit,
       coalesce(hist.first_alert, DATE '2024-03-01') AS alert_date
FROM hits_l LEFT JOIN hist ON hits_l.c_custkey = hist.c_custkey AND hits_l.list_tab = hist.list_tab""")
def q_15_new_hits(spark, sf):
    hits = _screening(spark, sf)
    c = T(spark, sf).customer.where(F.col("c_acctbal") > 5000).select("c_custkey")
    hist = hits.join(c, "c_custkey").select("c_custkey", "list_tab",
                                             F.lit("2024-01-01").cast("date").alias("first_alert"))
    return RC.new_hits(hits, hist, ["c_custkey", "list_tab"], "first_alert", D(2024, 3, 1))


SPLIT_SQL = """
loc AS (SELECT c_custkey, c_nationkey AS l FROM customer
        UNION ALL SELECT c_custkey, CAST(c_custkey % 25 AS INTEGER) FROM customer
        UNION ALL SELECT c_custkey, CAST((c_nationkey + 7) % 25 AS INTEGER) FROM customer),
rmap AS (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
split AS (SELECT DISTINCT r_name AS region, c_custkey FROM loc JOIN rmap ON l = n_nationkey)"""


def _split(t):
    c = t.customer.select("c_custkey", "c_nationkey", (F.col("c_custkey") % 25).cast("int").alias("residence"),
                          ((F.col("c_nationkey") + 7) % 25).cast("int").alias("owner_nation"))
    rmap = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return RC.split_by_region(c, "c_custkey", ["c_nationkey", "residence", "owner_nation"], rmap,
                              "n_nationkey", "r_name")


@register("q_16_split_by_region", f"WITH {SPLIT_SQL} SELECT * FROM split")
def q_16_split_by_region(spark, sf):
    return _split(T(spark, sf))


@register("q_17_attribute_distribution", """
SELECT 'c_mktsegment' AS attribute, c_mktsegment AS value, count(*) / sum(count(*)) OVER () AS freq
FROM customer GROUP BY c_mktsegment
UNION ALL
SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) / sum(count(*)) OVER () FROM customer
GROUP BY c_nationkey""")
def q_17_attribute_distribution(spark, sf):
    return RC.attribute_distribution(T(spark, sf).customer, ["c_mktsegment", "c_nationkey"])


@register("q_17_distribution_distance", """
WITH p AS (
  SELECT 'c_mktsegment' AS attribute, c_mktsegment AS value, count(*) / sum(count(*)) OVER () AS freq
  FROM customer GROUP BY 2
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) / sum(count(*)) OVER () FROM customer GROUP BY 2),
s AS (
  SELECT 'c_mktsegment' AS attribute, c_mktsegment AS value, count(*) / sum(count(*)) OVER () AS freq
  FROM customer WHERE c_acctbal > 5000 GROUP BY 2
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) / sum(count(*)) OVER () FROM customer
  WHERE c_acctbal > 5000 GROUP BY 2)
SELECT coalesce(p.attribute, s.attribute) AS attribute,
       round(sum(abs(coalesce(p.freq, 0) - coalesce(s.freq, 0))), 9) AS distance
FROM p FULL OUTER JOIN s ON p.attribute = s.attribute AND p.value = s.value GROUP BY 1""")
def q_17_distribution_distance(spark, sf):
    c = T(spark, sf).customer
    attrs = ["c_mktsegment", "c_nationkey"]
    pop = RC.attribute_distribution(c, attrs)
    smp = RC.attribute_distribution(c.where(F.col("c_acctbal") > 5000), attrs)
    d = RC.distribution_distance(pop, smp)
    return d.select("attribute", F.round("distance", 9).alias("distance"))
