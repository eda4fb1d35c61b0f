"""H-07..H-15: identity resolution and hierarchies on synthetic edges derived from customer.

Party type by market segment; structural edge child k -> parent k div 3,
credit edge for negative balances k -> k div 7 (SURVEY §7 binding).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.operators import hierarchy as HI
from dossier.operators.identity import assign_identity, build_typed_id, exclude_ids, leading_source_union
from dossier.plans.common import PARTIES_SQL, T, crosswalk, parties
from dossier.plans.registry import register

# Party type per market segment in the synthetic hierarchy.
SEGMENT_TYPE = [("BUILDING", "Legal Entity"), ("AUTOMOBILE", "Branch"), ("MACHINERY", "Sub Account"),
                ("HOUSEHOLD", "Organisation Unit"), ("FURNITURE", "Managed Fund")]
TYPE_SQL = "CASE c_mktsegment " + " ".join(f"WHEN '{s}' THEN '{t}'" for s, t in SEGMENT_TYPE) + " END"
REL_SQL = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Branch of' WHEN 'MACHINERY' THEN 'Main Account' "
           "WHEN 'HOUSEHOLD' THEN 'Organisation Unit of' WHEN 'FURNITURE' THEN 'Managed by' END")


def _party_type():
    e = None
    for s, t in SEGMENT_TYPE:
        e = F.when(F.col("c_mktsegment") == s, t) if e is None else e.when(F.col("c_mktsegment") == s, t)
    return e


def _nodes(t):
    return t.customer.select(F.col("c_custkey").alias("id"), _party_type().alias("party_type"))


def _div(n):
    return F.expr(f"c_custkey div {n}")


def _edges(t):
    c = t.customer
    rel = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Branch of")
           .when(F.col("c_mktsegment") == "MACHINERY", "Main Account")
           .when(F.col("c_mktsegment") == "HOUSEHOLD", "Organisation Unit of")
           .when(F.col("c_mktsegment") == "FURNITURE", "Managed by"))
    s = c.where(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("id"), rel.alias("rel_type"), _div(3).alias("parent"))
    cr = c.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("id"), F.lit("Credit").alias("rel_type"),
                                                 _div(7).alias("parent"))
    return s.unionByName(cr).where(F.col("id") != F.col("parent"))


EDGES_SQL = f"""
nodes AS (SELECT c_custkey AS id, {TYPE_SQL} AS party_type FROM customer),
edges AS (
  SELECT * FROM (
    SELECT c_custkey AS id, {REL_SQL} AS rel_type, c_custkey // 3 AS parent FROM customer
    WHERE c_mktsegment <> 'BUILDING'
    UNION ALL
    SELECT c_custkey, 'Credit', c_custkey // 7 FROM customer WHERE c_acctbal < 0)
  WHERE id <> parent)"""


# ------------------------------------------------------------------ identity

@register("h_07_assign_identity", f"""
WITH {PARTIES_SQL},
cw AS (SELECT * FROM crosswalk
       UNION ALL SELECT 'CUS_' || CAST(c_custkey AS VARCHAR), 'X' || CAST(c_custkey AS VARCHAR)
       FROM customer WHERE c_nationkey = 0),
m AS (SELECT local_id, min(party_id) AS party_id FROM cw GROUP BY local_id)
SELECT p.source, p.key, p.name, m.party_id FROM parties p LEFT JOIN m ON p.local_id = m.local_id""")
def h_07_assign_identity(spark, sf):
    t = T(spark, sf)
    extra = t.customer.where(F.col("c_nationkey") == 0).select(
        build_typed_id("c_custkey", "CUS_").alias("local_id"),
        F.concat(F.lit("X"), F.col("c_custkey").cast("string")).alias("party_id"))
    cw = crosswalk(t).unionByName(extra)
    p = parties(t).select("local_id", "source", "key", "name")
    return assign_identity(p, cw, "local_id")


@register("h_08_build_typed_id", r"""
SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'LEC_' ELSE 'IND_' END
       || regexp_extract(c_name, '(\d+)', 1) AS typed_id, c_name AS name FROM customer
UNION ALL
SELECT 'SUP_' || regexp_extract(s_name, '(\d+)', 1), s_name FROM supplier""")
def h_08_build_typed_id(spark, sf):
    t = T(spark, sf)
    prefix = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.lit("LEC_")).otherwise(F.lit("IND_"))
    a = t.customer.select(build_typed_id("c_name", prefix).alias("typed_id"), F.col("c_name").alias("name"))
    b = t.supplier.select(build_typed_id("s_name", "SUP_").alias("typed_id"), F.col("s_name").alias("name"))
    return a.unionByName(b)


@register("h_09_leading_source_union", """
WITH m AS (SELECT c_custkey AS local_id, 'CUS' AS source, c_name AS name, c_nationkey AS nationkey
           FROM customer WHERE c_mktsegment = 'BUILDING'),
o AS (SELECT s_suppkey AS local_id, 'SUP' AS source, s_name AS name, s_nationkey AS nationkey FROM supplier),
u AS (SELECT * FROM m UNION ALL SELECT * FROM o WHERE local_id NOT IN (SELECT local_id FROM m))
SELECT u.local_id, u.source, u.name, r_name AS region
FROM u JOIN nation ON u.nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def h_09_leading_source_union(spark, sf):
    t = T(spark, sf)
    m = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("local_id"), F.lit("CUS").alias("source"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"))
    o = t.supplier.select(F.col("s_suppkey").alias("local_id"), F.lit("SUP").alias("source"),
                          F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    u = leading_source_union(m, [o], "local_id")
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.col("n_nationkey").alias("nationkey"), F.col("r_name").alias("region"))
    return u.join(geo, "nationkey").select("local_id", "source", "name", "region")


@register("h_10_exclude_unmatched_legacy", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (
  SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'AUTOMOBILE')""")
def h_10_exclude_unmatched_legacy(spark, sf):
    c = T(spark, sf).customer
    bad = c.where((F.col("c_acctbal") < 0) & (F.col("c_mktsegment") == "AUTOMOBILE"))
    return exclude_ids(c.select("c_custkey", "c_name"), "c_custkey", bad, "c_custkey")


# ----------------------------------------------------------------- hierarchy

@register("h_11_leading_entity", f"""
WITH RECURSIVE {EDGES_SQL},
credit AS (SELECT id, min(parent) AS credit FROM edges WHERE rel_type = 'Credit' GROUP BY id),
step AS (
  SELECT e.id, min(e.parent) AS nxt FROM edges e JOIN nodes c ON c.id = e.id JOIN nodes p ON p.id = e.parent
  WHERE e.rel_type <> 'Credit'
    AND e.rel_type = CASE c.party_type WHEN 'Branch' THEN 'Branch of' WHEN 'Foreign Branch' THEN 'Branch of'
        WHEN 'Sub Account' THEN 'Main Account' WHEN 'Organisation Unit' THEN 'Organisation Unit of'
        WHEN 'Managed Fund' THEN 'Managed by' WHEN 'Sub-fund' THEN 'Sub-fund of' END
    AND ((c.party_type IN ('Branch', 'Foreign Branch') AND p.party_type = 'Legal Entity')
      OR (c.party_type IN ('Sub Account', 'Organisation Unit', 'Managed Fund', 'Sub-fund')
          AND p.party_type IN ('Legal Entity', 'Branch', 'Foreign Branch')))
  GROUP BY e.id),
walk(id, cur, depth) AS (
  SELECT id, id, 0 FROM nodes
  UNION ALL
  SELECT w.id, s.nxt, w.depth + 1 FROM walk w JOIN nodes n ON n.id = w.cur
  LEFT JOIN credit c ON c.id = w.cur JOIN step s ON s.id = w.cur
  WHERE n.party_type <> 'Legal Entity' AND c.credit IS NULL AND w.depth < 4),
last AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY id ORDER BY depth DESC) = 1)
SELECT l.id, CASE WHEN n.party_type = 'Legal Entity' THEN l.cur WHEN c.credit IS NOT NULL THEN c.credit
                  ELSE l.cur END AS leading_id, l.depth
FROM last l JOIN nodes n ON n.id = l.cur LEFT JOIN credit c ON c.id = l.cur""")
def h_11_leading_entity(spark, sf):
    t = T(spark, sf)
    return HI.leading_entity(_nodes(t), _edges(t), max_depth=4)


UP_EDGES_SQL = """
e AS (
  SELECT * FROM (
    SELECT c_custkey AS child, 'Credit' AS rel_type, c_custkey // 4 AS parent FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
    UNION ALL
    SELECT c_custkey, 'Operational Hierarchy', c_custkey // 3 FROM customer
    WHERE c_mktsegment IN ('HOUSEHOLD', 'BUILDING')
    UNION ALL SELECT c_custkey, 'Commercial', c_custkey // 2 FROM customer)
  WHERE child <> parent)"""


def _up_edges(t):
    c = t.customer
    a = c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.col("c_custkey").alias("id"), F.lit("Credit").alias("rel_type"), _div(4).alias("parent"))
    b = c.where(F.col("c_mktsegment").isin("HOUSEHOLD", "BUILDING")).select(
        F.col("c_custkey").alias("id"), F.lit("Operational Hierarchy").alias("rel_type"), _div(3).alias("parent"))
    com = c.select(F.col("c_custkey").alias("id"), F.lit("Commercial").alias("rel_type"), _div(2).alias("parent"))
    return a.unionByName(b).unionByName(com).where(F.col("id") != F.col("parent"))


@register("h_12_ultimate_parent", f"""
WITH RECURSIVE {UP_EDGES_SQL},
ents AS (SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN 'Legal Entity'
         WHEN 'FURNITURE' THEN 'Natural Person' ELSE 'Branch' END AS party_type FROM customer),
walk(start, chain, rk, node, depth, path) AS (
  SELECT id, 'Credit', 0, id, 0, [id] FROM ents
  UNION ALL SELECT id, 'Operational Hierarchy', 1, id, 0, [id] FROM ents
  UNION ALL
  SELECT w.start, w.chain, w.rk, e.parent, w.depth + 1, list_append(w.path, e.parent)
  FROM walk w JOIN e ON e.child = w.node AND e.rel_type = w.chain
  WHERE NOT list_contains(w.path, e.parent)),
best AS (SELECT * FROM walk WHERE depth > 0
         QUALIFY row_number() OVER (PARTITION BY start ORDER BY depth DESC, rk, node) = 1),
com AS (SELECT e.child, min(e.parent) AS parent FROM e JOIN ents x ON x.id = e.child JOIN ents y ON y.id = e.parent
        WHERE e.rel_type = 'Commercial' AND x.party_type IN ('Legal Entity', 'Natural Person')
          AND y.party_type IN ('Legal Entity', 'Natural Person') GROUP BY e.child)
SELECT ents.id, coalesce(b.node, ents.id) AS ultimate_parent, coalesce(b.chain, 'self') AS chain,
       coalesce(b.depth, 0) AS depth, coalesce(com.parent, b.node, ents.id) AS super_parent
FROM ents LEFT JOIN best b ON b.start = ents.id LEFT JOIN com ON com.child = coalesce(b.node, ents.id)""")
def h_12_ultimate_parent(spark, sf):
    t = T(spark, sf)
    ents = t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", "Legal Entity")
                             .when(F.col("c_mktsegment") == "FURNITURE", "Natural Person").otherwise("Branch")
                             .alias("party_type"))
    return HI.ultimate_parent(ents, _up_edges(t), ents)


@register("h_13_translate_hierarchy_ids", """
WITH h AS (SELECT c_custkey AS id, c_custkey AS level_1, c_custkey // 3 AS level_2, c_custkey // 9 AS level_3,
                  c_custkey // 27 AS level_4, c_custkey // 81 AS level_5 FROM customer),
ks AS (SELECT c_custkey AS k, 'KS' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS ks_id FROM customer
       WHERE c_acctbal > 0)
SELECT h.id, k1.ks_id AS level_1_ks, k2.ks_id AS level_2_ks, k3.ks_id AS level_3_ks, k4.ks_id AS level_4_ks,
       k5.ks_id AS level_5_ks
FROM h LEFT JOIN ks k1 ON k1.k = h.level_1 LEFT JOIN ks k2 ON k2.k = h.level_2
LEFT JOIN ks k3 ON k3.k = h.level_3 LEFT JOIN ks k4 ON k4.k = h.level_4 LEFT JOIN ks k5 ON k5.k = h.level_5""")
def h_13_translate_hierarchy_ids(spark, sf):
    c = T(spark, sf).customer
    h = c.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("level_1"),
                 _div(3).alias("level_2"), _div(9).alias("level_3"), _div(27).alias("level_4"),
                 _div(81).alias("level_5"))
    ks = c.where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("k"), F.concat(F.lit("KS"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
        .alias("ks_id"))
    return HI.translate_hierarchy_ids(h, "id", ["level_1", "level_2", "level_3", "level_4", "level_5"], ks,
                                      "k", "ks_id")


REL_EDGES_SQL = """
e AS (SELECT * FROM (
        SELECT c_custkey AS child, c_custkey // 2 AS parent FROM customer
        UNION ALL SELECT c_custkey, c_custkey // 5 FROM customer WHERE c_nationkey = 3)
      WHERE child <> parent),
roots AS (SELECT c_custkey AS root FROM customer)"""


@register("h_14_related_parties", f"""
WITH RECURSIVE {REL_EDGES_SQL},
r(root, node, depth) AS (
  SELECT root, root, 0 FROM roots
  UNION
  SELECT r.root, e.parent, r.depth + 1 FROM r JOIN e ON e.child = r.node)
SELECT root, node, min(depth) AS depth FROM r GROUP BY root, node HAVING min(depth) > 0""")
def h_14_related_parties(spark, sf):
    c = T(spark, sf).customer
    e = c.select(F.col("c_custkey").alias("child"), _div(2).alias("parent")).unionByName(
        c.where(F.col("c_nationkey") == 3).select(F.col("c_custkey").alias("child"), _div(5).alias("parent")))
    return HI.related_parties(c.select(F.col("c_custkey").alias("id")), e)


@register("h_15_row_volume_guard", """SELECT count(*) AS n_rows FROM orders""")
def h_15_row_volume_guard(spark, sf):
    return HI.row_volume_guard(T(spark, sf).orders, 1000)
