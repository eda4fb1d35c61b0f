"""R-* reshape operators bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.operators.shape import (explode_aligned, explode_list, explode_outer_multi,
                                     flags_to_rows, last_element, pivot_dynamic, pivot_open,
                                     rows_to_flags, unpivot, unpivot_groups)
from dossier.plans.common import T
from dossier.plans.registry import register

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("r_01_pivot_dynamic", r"""
WITH x AS (SELECT user_id, event_type, regexp_extract(props, '"k": (\d+)', 1) AS k FROM events)
SELECT user_id,
  array_to_string(list_sort(list_distinct(list(k) FILTER (WHERE event_type = 'click'))), ',') AS click,
  array_to_string(list_sort(list_distinct(list(k) FILTER (WHERE event_type = 'error'))), ',') AS error,
  array_to_string(list_sort(list_distinct(list(k) FILTER (WHERE event_type = 'purchase'))), ',') AS purchase,
  array_to_string(list_sort(list_distinct(list(k) FILTER (WHERE event_type = 'signup'))), ',') AS signup,
  array_to_string(list_sort(list_distinct(list(k) FILTER (WHERE event_type = 'view'))), ',') AS view
FROM x GROUP BY user_id""")
def r_01_pivot_dynamic(spark, sf):
    e = T(spark, sf).events.select("user_id", "event_type",
                                   F.regexp_extract("props", r'"k": (\d+)', 1).alias("k"))
    # pivot values discovered from the data (bounded), not hard-coded
    return pivot_dynamic(e, ["user_id"], "event_type",
                         F.array_join(F.array_sort(F.collect_set("k")), ","), max_values=100)


@register("r_01_pivot_open", """
WITH x AS (SELECT l_returnflag, l_linestatus,
                  coalesce(CAST(CASE WHEN l_linenumber < 7 THEN l_partkey END AS VARCHAR), '(null)') AS v, l_quantity FROM lineitem),
c AS (SELECT l_returnflag, l_linestatus, v, CAST(sum(l_quantity) AS BIGINT) AS q FROM x GROUP BY ALL)
SELECT l_returnflag, l_linestatus, count(*)::INTEGER AS n_values, string_agg(v || '=' || q, ',' ORDER BY v) AS cells
FROM c GROUP BY ALL""")
def r_01_pivot_open(spark, sf):
    """Quantity per part, one open set of parts per key; lines numbered 7 have no part."""
    x = T(spark, sf).lineitem.select("l_returnflag", "l_linestatus", "l_quantity",
                                     F.when(F.col("l_linenumber") < 7, F.col("l_partkey")).alias("part"))
    cells = pivot_open(x, ["l_returnflag", "l_linestatus"], "part", F.sum("l_quantity").cast("long"))
    texts = F.transform(F.map_entries("cells"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return cells.select("l_returnflag", "l_linestatus", F.size("cells").alias("n_values"),
                        F.array_join(texts, ",").alias("cells"))


@register("r_02_pivot_sql", """
SELECT o_orderpriority,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS F,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS P
FROM orders GROUP BY o_orderpriority""")
def r_02_pivot_sql(spark, sf):
    o = T(spark, sf).orders.select("o_orderpriority", "o_orderstatus", "o_orderkey")
    return spark.sql("SELECT * FROM {o} PIVOT (count(o_orderkey) FOR o_orderstatus "
                     "IN ('F' AS F, 'O' AS O, 'P' AS P))", o=o)


@register("r_03_unpivot_structs", """
SELECT l_orderkey, l_linenumber, measure, value FROM (
  SELECT l_orderkey, l_linenumber, l_quantity,
         CASE WHEN l_discount > 0 THEN l_discount END AS l_discount, l_tax FROM lineitem)
UNPIVOT INCLUDE NULLS (value FOR measure IN (l_quantity, l_discount, l_tax))""")
def r_03_unpivot_structs(spark, sf):
    li = T(spark, sf).lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("l_discount"), "l_tax")
    return unpivot(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"],
                   "measure", "value")


@register("r_04_unpivot_stack", """
SELECT p_partkey, 'Primary' AS level, p_brand AS code, p_name AS description,
       CAST(p_size AS DOUBLE) AS pct FROM part
UNION ALL SELECT p_partkey, 'Secondary', p_type, p_name, CAST(p_size AS DOUBLE) / 2 FROM part
UNION ALL SELECT p_partkey, 'Tertiary', CAST(p_size AS VARCHAR), NULL, NULL FROM part""")
def r_04_unpivot_stack(spark, sf):
    p = T(spark, sf).part
    groups = {
        "Primary": [F.col("p_brand"), F.col("p_name"), F.col("p_size").cast("double")],
        "Secondary": [F.col("p_type"), F.col("p_name"), F.col("p_size").cast("double") / 2],
        "Tertiary": [F.col("p_size").cast("string"), F.lit(None).cast("string"),
                     F.lit(None).cast("double")],
    }
    return unpivot_groups(p, ["p_partkey"], groups, ["level", "code", "description", "pct"])


@register("r_05_unpivot_sql", """
UNPIVOT (SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS disc, nullif(l_tax, 0) AS tax
         FROM lineitem)
ON disc, tax INTO NAME risk_type VALUE risk_value""")
def r_05_unpivot_sql(spark, sf):
    li = T(spark, sf).lineitem.select("l_orderkey", "l_linenumber",
                                      F.nullif("l_discount", F.lit(0.0)).alias("disc"),
                                      F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    return spark.sql("SELECT * FROM {li} UNPIVOT (risk_value FOR risk_type IN (disc, tax))", li=li)


@register("r_06_flags_to_rows", """
SELECT l_orderkey, l_linenumber, unnest(list_filter([
  CASE WHEN l_returnflag = 'R' THEN 'returned' END,
  CASE WHEN l_linestatus = 'O' THEN 'open' END,
  CASE WHEN l_discount > 0.05 THEN 'discounted' END], lambda x: x IS NOT NULL)) AS flag
FROM lineitem""")
def r_06_flags_to_rows(spark, sf):
    li = T(spark, sf).lineitem
    return flags_to_rows(li, ["l_orderkey", "l_linenumber"], {
        "returned": F.col("l_returnflag") == "R", "open": F.col("l_linestatus") == "O",
        "discounted": F.col("l_discount") > 0.05})


@register("r_07_rows_to_flags", """
SELECT user_id,
  max(CASE WHEN event_type = 'purchase' THEN 'True' ELSE 'False' END) AS has_purchase,
  max(CASE WHEN event_type = 'error' THEN 'True' ELSE 'False' END) AS has_error
FROM events GROUP BY user_id""")
def r_07_rows_to_flags(spark, sf):
    return rows_to_flags(T(spark, sf).events, ["user_id"], "event_type",
                         {"purchase": "has_purchase", "error": "has_error"})


@register("r_08_explode_list", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""")
def r_08_explode_list(spark, sf):
    return explode_list(T(spark, sf).part, ["p_partkey"], "p_name", " ", "word")


@register("r_09_explode_conditional_array", """
SELECT o_orderkey, unnest(list_filter(CASE WHEN o_orderstatus = 'O'
    THEN [o_orderpriority, o_orderstatus, CASE WHEN o_totalprice > 200000 THEN 'large' END]
    ELSE [o_orderpriority] END, lambda x: x IS NOT NULL)) AS item
FROM orders""")
def r_09_explode_conditional_array(spark, sf):
    o = T(spark, sf).orders
    arr = F.when(F.col("o_orderstatus") == "O",
                 F.array("o_orderpriority", "o_orderstatus",
                         F.when(F.col("o_totalprice") > 200000, F.lit("large")))) \
        .otherwise(F.array("o_orderpriority"))
    return o.select("o_orderkey", F.explode(F.array_compact(arr)).alias("item"))


MULTI_BASE_SQL = """
WITH agg AS (
  SELECT l_orderkey, list_sort(list_distinct(list(l_returnflag) FILTER (WHERE l_returnflag <> 'N'))) AS flags,
         list_sort(list_distinct(list(l_linestatus))) AS statuses
  FROM lineitem GROUP BY l_orderkey),
base AS (SELECT o_orderkey, flags, statuses FROM orders LEFT JOIN agg ON l_orderkey = o_orderkey)"""


@register("r_10_explode_outer_multi", MULTI_BASE_SQL + """,
a AS (SELECT o_orderkey, statuses,
        unnest(CASE WHEN flags IS NULL OR len(flags) = 0 THEN [NULL] ELSE flags END) AS flag
      FROM base)
SELECT o_orderkey, flag,
       unnest(CASE WHEN statuses IS NULL OR len(statuses) = 0 THEN [NULL] ELSE statuses END) AS status
FROM a""")
def r_10_explode_outer_multi(spark, sf):
    t = T(spark, sf)
    returned = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))  # orders without one have an empty list
    agg = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_set(returned)).alias("flags"),
                                               F.array_sort(F.collect_set("l_linestatus")).alias("statuses"))
    base = t.orders.select("o_orderkey").join(agg, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return explode_outer_multi(base, ["o_orderkey"], {"flags": "flag", "statuses": "status"})


@register("r_11_explode_aligned", """
WITH agg AS (
  SELECT l_orderkey,
    list(l_linenumber ORDER BY l_linenumber, l_partkey, l_quantity) AS lines,
    list(l_partkey ORDER BY l_linenumber, l_partkey, l_quantity) AS parts,
    list(l_quantity ORDER BY l_linenumber, l_partkey, l_quantity) AS qtys
  FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, unnest(lines) AS line, unnest(parts) AS part, unnest(qtys) AS qty FROM agg""")
def r_11_explode_aligned(spark, sf):
    li = T(spark, sf).lineitem
    s = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity")))
    agg = li.groupBy("l_orderkey").agg(s.alias("__s")).select(
        "l_orderkey", F.col("__s.l_linenumber").alias("lines"), F.col("__s.l_partkey").alias("parts"),
        F.col("__s.l_quantity").alias("qtys"))
    return explode_aligned(agg, ["l_orderkey"], {"lines": "line", "parts": "part", "qtys": "qty"})


@register("r_12_last_element", """
SELECT l_orderkey, max(CASE WHEN rn = 1 AND l_discount > 0.05 THEN l_partkey END) AS last_discounted_part
FROM (SELECT l_orderkey, l_partkey, l_discount,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_discount > 0.05 THEN 0 ELSE 1 END,
                           l_linenumber DESC, l_partkey DESC, l_discount DESC) AS rn
      FROM lineitem)
GROUP BY l_orderkey""")
def r_12_last_element(spark, sf):
    li = T(spark, sf).lineitem
    s = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_discount")))
    arr = F.transform(s, lambda x: F.when(x.getField("l_discount") > 0.05, x.getField("l_partkey")))
    return li.groupBy("l_orderkey").agg(last_element(arr).alias("last_discounted_part"))
