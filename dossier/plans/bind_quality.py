"""Q-05..Q-13: data-quality rules bound to the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dossier.operators import quality as DQ
from dossier.operators.aggregates import collect_sorted_list
from dossier.plans.bind_recon import SPLIT_SQL, _split
from dossier.plans.common import T
from dossier.plans.registry import register
from dossier.session import scratch_path


@register("q_05_dq_unique", """
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
ex AS (SELECT string_agg(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR), ','
                         ORDER BY l_orderkey, l_linenumber) AS examples
       FROM (SELECT * FROM g WHERE n > 1 ORDER BY l_orderkey, l_linenumber LIMIT 10))
SELECT 'lineitem_pk' AS rule, CASE WHEN count(*) FILTER (WHERE n > 1) = 0 THEN 'Pass' ELSE 'Fail' END AS status,
       CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_duplicate_keys,
       any_value(ex.examples) AS examples
FROM g, ex""")
def q_05_dq_unique(spark, sf):
    return DQ.dq_unique(T(spark, sf).lineitem, ["l_orderkey", "l_linenumber"], "lineitem_pk")


@register("q_05_dq_unique_filtered", """
WITH g AS (SELECT o_orderkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT 'orders_pk_closed' AS rule, CASE WHEN count(*) FILTER (WHERE n > 1) = 0 THEN 'Pass' ELSE 'Fail' END AS status,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) AS n_keys,
       count(*) FILTER (WHERE n > 1) AS n_duplicate_keys, '' AS examples
FROM g""")
def q_05_dq_unique_filtered(spark, sf):
    return DQ.dq_unique(T(spark, sf).orders, ["o_orderkey"], "orders_pk_closed",
                        where=F.col("o_orderstatus") == "F")


@register("q_06_dq_not_null", """
WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'not_null' AS rule, column_name, n_null, CASE WHEN n_null = 0 THEN 'Pass' ELSE 'Fail' END AS status FROM (
  SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS n_null FROM j
  UNION ALL SELECT 'lang', count(*) - count(lang) FROM j
  UNION ALL SELECT 'quality', count(*) - count(quality) FROM j
  UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM j)""")
def q_06_dq_not_null(spark, sf):
    t = T(spark, sf)
    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return DQ.dq_not_null(j, ["doc_id", "lang", "quality", "toxic"])


@register("q_07_dq_referential", """
SELECT o_custkey AS key, count(*) AS n_rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 0)
GROUP BY o_custkey""")
def q_07_dq_referential(spark, sf):
    t = T(spark, sf)
    return DQ.dq_referential(t.orders, "o_custkey", t.customer.where(F.col("c_nationkey") != 0), "c_custkey")


@register("q_08_dq_condition", """
SELECT 'discount_tax_range' AS rule, 'discount <= 0.08 and tax <= 0.06' AS description, count(*) AS n_rows,
  count(*) FILTER (WHERE NOT coalesce(l_discount <= 0.08 AND l_tax <= 0.06, FALSE)) AS n_violations,
  CASE WHEN count(*) FILTER (WHERE NOT coalesce(l_discount <= 0.08 AND l_tax <= 0.06, FALSE)) = 0
       THEN 'Pass' ELSE 'Fail' END AS status
FROM lineitem""")
def q_08_dq_condition(spark, sf):
    li = T(spark, sf).lineitem
    return DQ.dq_condition(li, (F.col("l_discount") <= 0.08) & (F.col("l_tax") <= 0.06), "discount_tax_range",
                           "discount <= 0.08 and tax <= 0.06")


@register("q_06_dq_not_null_examples", """
WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
           WHERE d.source IS NOT NULL),
n AS (SELECT 'lang' AS column_name, count(*) - count(lang) AS n_null FROM j
      UNION ALL SELECT 'quality', count(*) - count(quality) FROM j
      UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM j),
b AS (SELECT DISTINCT * FROM (SELECT 'lang' AS column_name, doc_id FROM j WHERE lang IS NULL
      UNION ALL SELECT 'quality', doc_id FROM j WHERE quality IS NULL
      UNION ALL SELECT 'toxic', doc_id FROM j WHERE toxic IS NULL) WHERE doc_id IS NOT NULL),
e AS (SELECT column_name, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS examples
      FROM (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY doc_id) <= 10) GROUP BY 1)
SELECT 'document_labels' AS rule, column_name, n_null, CASE WHEN n_null = 0 THEN 'Pass' ELSE 'Fail' END AS status,
       coalesce(examples, '') AS examples
FROM n LEFT JOIN e USING (column_name)""")
def q_06_dq_not_null_examples(spark, sf):
    t = T(spark, sf)
    j = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return DQ.dq_not_null(j, ["lang", "quality", "toxic"], "document_labels", F.col("source").isNotNull(), "doc_id")


@register("q_07_dq_referential_status", """
WITH m AS (SELECT o_custkey AS key, count(*) AS n FROM orders
           WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 0)
           GROUP BY 1)
SELECT 'order_client' AS rule, CASE WHEN count(*) = 0 THEN 'Pass' ELSE 'Fail' END AS status,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS n_missing_rows, count(*) AS n_missing_keys,
       coalesce((SELECT string_agg(CAST(key AS VARCHAR), ',' ORDER BY key)
                 FROM (SELECT key FROM m ORDER BY key LIMIT 10)), '') AS examples
FROM m""")
def q_07_dq_referential_status(spark, sf):
    t = T(spark, sf)
    return DQ.dq_referential_status(t.orders, "o_custkey", t.customer.where(F.col("c_nationkey") != 0), "c_custkey",
                                    "order_client", where=F.col("o_orderstatus") == "F")


@register("q_08_dq_condition_examples", """
WITH x AS (SELECT l_orderkey, coalesce(l_discount <= 0.08, FALSE) AS ok FROM lineitem WHERE l_returnflag = 'R')
SELECT 'returned_discount' AS rule, 'discount of returned lines' AS description, count(*) AS n_rows,
  count(*) FILTER (WHERE NOT ok) AS n_violations,
  CASE WHEN count(*) FILTER (WHERE NOT ok) = 0 THEN 'Pass' ELSE 'Fail' END AS status,
  coalesce((SELECT string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY l_orderkey)
            FROM (SELECT DISTINCT l_orderkey FROM x WHERE NOT ok ORDER BY 1 LIMIT 10)), '') AS examples
FROM x""")
def q_08_dq_condition_examples(spark, sf):
    return DQ.dq_condition(T(spark, sf).lineitem, F.col("l_discount") <= 0.08, "returned_discount",
                           "discount of returned lines", F.col("l_returnflag") == "R", "l_orderkey")


@register("q_09_dq_log")
def q_09_dq_log(spark, sf):
    t = T(spark, sf)
    log = DQ.run_rules(t.lineitem, "lineitem", [
        ("unique", ["l_orderkey", "l_linenumber"], "lineitem_pk"),
        ("condition", F.col("l_tax") <= 0.06, "tax_range", "tax at most 6 %"),
        ("not_null", ["l_orderkey", "l_partkey", "l_shipdate"], "lineitem_not_null"),
    ], dt.datetime(2024, 1, 31, 6, 0))
    path = scratch_path(spark, "dq_log")
    log.write.mode("append").parquet(path)
    return spark.read.parquet(path)


@register("q_10_dq_delimited_duplicates", """
WITH x AS (SELECT p_brand, array_to_string(list_sort(list(p_name)), ',') AS names FROM part GROUP BY p_brand)
SELECT p_brand, len(string_split(names, ',')) > len(list_distinct(string_split(names, ','))) AS has_duplicates
FROM x""")
def q_10_dq_delimited_duplicates(spark, sf):
    x = T(spark, sf).part.groupBy("p_brand").agg(collect_sorted_list("p_name", ",", ["p_partkey"]).alias("names"))
    return x.select("p_brand", DQ.dq_delimited_duplicates("names").alias("has_duplicates"))


@register("q_11_dq_set_compare", f"""
WITH {SPLIT_SQL},
produced AS (SELECT DISTINCT r_name AS region, c_custkey FROM customer JOIN rmap ON c_nationkey = n_nationkey)
SELECT region, c_custkey, 'missing_in_extract' AS issue FROM (SELECT * FROM split EXCEPT SELECT * FROM produced)
UNION ALL
SELECT region, c_custkey, 'unexpected_in_extract' FROM (SELECT * FROM produced EXCEPT SELECT * FROM split)""")
def q_11_dq_set_compare(spark, sf):
    t = T(spark, sf)
    expected = _split(t)
    produced = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
                .select(F.col("r_name").alias("region"), "c_custkey").distinct())
    return DQ.dq_set_compare(expected, produced, ["region", "c_custkey"])


@register("q_12_fail_on_duplicates", """SELECT * FROM customer""")
def q_12_fail_on_duplicates(spark, sf):
    return DQ.fail_on_duplicates(T(spark, sf).customer, ["c_custkey"])


@register("q_13_inconsistent_values", """
WITH x AS (SELECT l_orderkey, nullif(trim(CASE WHEN l_returnflag = 'N' THEN ' ' ELSE l_linestatus END), '') AS v
           FROM lineitem)
SELECT l_orderkey, count(DISTINCT v) AS n_values,
       CASE WHEN count(DISTINCT v) > 1 THEN 'multiple values' ELSE 'blank only' END AS issue
FROM x GROUP BY l_orderkey HAVING count(DISTINCT v) > 1 OR count(v) = 0""")
def q_13_inconsistent_values(spark, sf):
    li = T(spark, sf).lineitem.select("l_orderkey", F.when(F.col("l_returnflag") == "N", " ")
                                      .otherwise(F.col("l_linestatus")).alias("v"))
    return DQ.inconsistent_values(li, ["l_orderkey"], "v")
