"""O-* sort/limit and U-* set operations bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.functions.text import natural_sort_key
from dossier.operators.relational import (except_rows, top_n_with_ties, union_all,
                                          union_branches, union_by_name, union_distinct,
                                          union_versions)
from dossier.plans.common import PARTIES_SQL, T, parties
from dossier.plans.registry import register


@register("o_01_sort", """
SELECT p_partkey, p_brand, p_retailprice FROM part
ORDER BY p_brand ASC NULLS LAST, p_retailprice DESC, p_partkey""")
def o_01_sort(spark, sf):
    p = T(spark, sf).part
    return p.select("p_partkey", "p_brand", "p_retailprice").orderBy(
        F.col("p_brand").asc_nulls_last(), F.col("p_retailprice").desc(), F.col("p_partkey"))


@register("o_02_limit", """
SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 10""")
def o_02_limit(spark, sf):
    s = T(spark, sf).supplier
    return s.select("s_suppkey", "s_name", "s_acctbal").orderBy(
        F.col("s_acctbal").desc(), F.col("s_suppkey")).limit(10)


@register("o_02_top_n_with_ties", """
SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier
QUALIFY rank() OVER (ORDER BY round(s_acctbal, -3) DESC) <= 1""")
def o_02_top_n_with_ties(spark, sf):
    s = T(spark, sf).supplier.select("s_suppkey", "s_nationkey", "s_acctbal",
                                     F.round("s_acctbal", -3).alias("bal_k"))
    return top_n_with_ties(s, [("bal_k", False)], 1).drop("bal_k")


@register("o_02_top_n_with_ties_partitioned", """
SELECT o_custkey, o_orderkey, o_orderdate FROM orders
QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC) <= 2""")
def o_02_top_n_with_ties_partitioned(spark, sf):
    o = T(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate",
                                   F.to_date("o_orderdate").alias("d"))
    return top_n_with_ties(o, [("d", False)], 2, partition=["o_custkey"]).drop("d")


@register("o_03_natural_sort_keys", r"""
SELECT DISTINCT p_brand, TRY_CAST(NULLIF(regexp_extract(p_brand, '^Brand#(\d+)$', 1), '') AS BIGINT)
  AS brand_no
FROM part ORDER BY brand_no""")
def o_03_natural_sort_keys(spark, sf):
    p = T(spark, sf).part.select("p_brand").distinct()
    return p.select("p_brand", natural_sort_key("p_brand", "Brand#").alias("brand_no")) \
        .orderBy("brand_no")


@register("u_01_union_distinct", """
SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier""")
def u_01_union_distinct(spark, sf):
    t = T(spark, sf)
    return union_distinct(t.customer.select(F.col("c_nationkey").alias("nationkey")),
                          t.supplier.select(F.col("s_nationkey").alias("nationkey")))


@register("u_02_union_all", """
SELECT c_custkey AS key, c_name AS name FROM customer
UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def u_02_union_all(spark, sf):
    t = T(spark, sf)
    return union_all(t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")),
                     t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))


@register("u_03_union_by_name", f"""
WITH {PARTIES_SQL} SELECT local_id, source, source_rank, key, name, nationkey, acctbal, mktsegment
FROM parties""")
def u_03_union_by_name(spark, sf):
    return parties(T(spark, sf))


@register("u_04_except_rows", """
SELECT c_custkey AS key FROM customer
EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def u_04_except_rows(spark, sf):
    t = T(spark, sf)
    recent = t.orders.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return except_rows(t.customer.select(F.col("c_custkey").alias("key")),
                       recent.select(F.col("o_custkey").alias("key")))


@register("u_05_union_branches", """
SELECT 'CUS' AS source_system, c_custkey AS key, c_nationkey AS nationkey, c_acctbal AS balance
FROM customer
UNION ALL
SELECT 'SUP', s_suppkey, s_nationkey, s_acctbal FROM supplier""")
def u_05_union_branches(spark, sf):
    t = T(spark, sf)

    def proj(df, p):
        return df.select(F.col(f"{p}key").alias("key"), F.col(f"{p[0]}_nationkey").alias("nationkey"),
                         F.col(f"{p[0]}_acctbal").alias("balance"))
    return union_branches({"CUS": proj(t.customer, "c_cust"), "SUP": proj(t.supplier, "s_supp")})


@register("u_06_union_versions", """
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, '100' AS version FROM customer
UNION ALL
SELECT s_suppkey, s_name, NULL, '200' FROM supplier""")
def u_06_union_versions(spark, sf):
    t = T(spark, sf)
    return union_versions({
        "100": (t.customer.select("c_custkey", "c_name", "c_mktsegment"),
                {"c_custkey": "key", "c_name": "name", "c_mktsegment": "segment"}),
        "200": (t.supplier.select("s_suppkey", "s_name"), {"s_suppkey": "key", "s_name": "name"}),
    })
