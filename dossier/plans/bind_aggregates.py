"""A-* aggregations bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.operators.aggregates import (collect_sorted_list, collect_unique_list, merge_lists,
                                          sorted_set_nonblank)
from dossier.operators.identity import golden_aggs, survivor_aggs
from dossier.operators.pick import indicator_count, ratio_class, zero_fill_groups
from dossier.plans.common import PARTIES_SQL, T, parties
from dossier.plans.registry import register


@register("a_01_group_agg", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_price, min(l_discount) AS min_disc,
       max(l_discount) AS max_disc, round(avg(l_quantity), 4) AS avg_qty
FROM lineitem GROUP BY 1, 2""")
def a_01_group_agg(spark, sf):
    return T(spark, sf).lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.min("l_discount").alias("min_disc"), F.max("l_discount").alias("max_disc"),
        F.round(F.avg("l_quantity"), 4).alias("avg_qty"))


@register("a_02_group_by_all", """
SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n FROM orders GROUP BY ALL""")
def a_02_group_by_all(spark, sf):
    return spark.sql("SELECT o_orderstatus, year(o_orderdate) AS yr, count(*) AS n "
                     "FROM {o} GROUP BY ALL", o=T(spark, sf).orders)


@register("a_03_count_distinct", """
SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers,
       count(DISTINCT (o_orderpriority, year(o_orderdate))) AS n_prio_years
FROM orders GROUP BY o_orderstatus""")
def a_03_count_distinct(spark, sf):
    return T(spark, sf).orders.groupBy("o_orderstatus").agg(
        F.countDistinct("o_custkey").alias("n_customers"),
        F.countDistinct("o_orderpriority", F.year("o_orderdate")).alias("n_prio_years"))


@register("a_04_having", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def a_04_having(spark, sf):
    return T(spark, sf).lineitem.groupBy("l_orderkey", "l_linenumber") \
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


@register("a_05_conditional_agg", """
SELECT l_orderkey,
  max(CASE WHEN l_returnflag = 'R' THEN l_linenumber END) AS last_returned_line,
  count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS n_open,
  sum(CASE WHEN l_discount > 0.05 THEN l_quantity ELSE 0 END) AS qty_discounted,
  max(CASE WHEN l_returnflag IN ('A', 'R') THEN 'returned' END) AS any_returned
FROM lineitem GROUP BY l_orderkey""")
def a_05_conditional_agg(spark, sf):
    li = T(spark, sf).lineitem
    return li.groupBy("l_orderkey").agg(
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_linenumber"))).alias("last_returned_line"),
        F.count(F.when(F.col("l_linestatus") == "O", 1)).alias("n_open"),
        F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).otherwise(0))
        .alias("qty_discounted"),
        F.max(F.when(F.col("l_returnflag").isin("A", "R"), "returned")).alias("any_returned"))


@register("a_06_collect_unique_list", """
SELECT o_custkey,
  coalesce(array_to_string(list_sort(list_distinct(list(o_orderpriority))), ', '), '') AS priorities
FROM orders GROUP BY o_custkey""")
def a_06_collect_unique_list(spark, sf):
    return T(spark, sf).orders.groupBy("o_custkey").agg(
        collect_unique_list("o_orderpriority", ", ").alias("priorities"))


@register("a_07_collect_sorted_list", """
SELECT p_brand, array_to_string(list_sort(list(p_name)), ',') AS names
FROM part GROUP BY p_brand""")
def a_07_collect_sorted_list(spark, sf):
    return T(spark, sf).part.groupBy("p_brand").agg(
        collect_sorted_list("p_name", ",", tie_break=["p_partkey"]).alias("names"))


@register("a_08_sorted_set_nonblank", """
SELECT user_id,
  coalesce(array_to_string(list_sort(list_distinct(
      list(nullif(trim(lbl), '')) FILTER (WHERE nullif(trim(lbl), '') IS NOT NULL))), '|'), '')
    AS labels
FROM (SELECT user_id, CASE WHEN event_type = 'error' THEN ' ' ELSE event_type END AS lbl
      FROM events)
GROUP BY user_id""")
def a_08_sorted_set_nonblank(spark, sf):
    e = T(spark, sf).events.select(
        "user_id", F.when(F.col("event_type") == "error", " ").otherwise(F.col("event_type")).alias("lbl"))
    return e.groupBy("user_id").agg(F.array_join(sorted_set_nonblank("lbl"), "|").alias("labels"))


@register("a_09_merge_lists", """
SELECT l_orderkey,
  array_to_string(list_sort(list_distinct(flatten([list(l_returnflag), list(l_linestatus)]))), ',')
    AS codes
FROM lineitem GROUP BY l_orderkey""")
def a_09_merge_lists(spark, sf):
    return T(spark, sf).lineitem.groupBy("l_orderkey").agg(
        F.array_join(F.array_sort(merge_lists("l_returnflag", "l_linestatus")), ",").alias("codes"))


@register("a_10_max_by", """
SELECT o_custkey, o_orderkey AS latest_order, o_orderdate AS latest_date FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def a_10_max_by(spark, sf):
    o = T(spark, sf).orders
    order = F.struct("o_orderdate", "o_orderkey")
    return o.groupBy("o_custkey").agg(F.max_by("o_orderkey", order).alias("latest_order"),
                                      F.max("o_orderdate").alias("latest_date"))


@register("a_11_golden_record", f"""
WITH {PARTIES_SQL}
SELECT nationkey, max(name) AS name, max(acctbal) AS acctbal, max(mktsegment) AS mktsegment,
       count(*) AS n_rows
FROM parties GROUP BY nationkey""")
def a_11_golden_record(spark, sf):
    p = parties(T(spark, sf))
    return p.groupBy("nationkey").agg(*golden_aggs(["name", "acctbal", "mktsegment"]),
                                      F.count(F.lit(1)).alias("n_rows"))


@register("a_12_survivorship", f"""
WITH {PARTIES_SQL},
r AS (SELECT nationkey,
        min(source_rank) FILTER (WHERE name IS NOT NULL) AS r_name,
        min(source_rank) FILTER (WHERE acctbal IS NOT NULL) AS r_bal,
        min(source_rank) FILTER (WHERE mktsegment IS NOT NULL) AS r_seg
      FROM parties GROUP BY nationkey)
SELECT p.nationkey,
       min(name) FILTER (WHERE source_rank = r_name) AS name,
       min(acctbal) FILTER (WHERE source_rank = r_bal) AS acctbal,
       min(mktsegment) FILTER (WHERE source_rank = r_seg) AS mktsegment
FROM parties p JOIN r ON p.nationkey = r.nationkey GROUP BY p.nationkey""")
def a_12_survivorship(spark, sf):
    p = parties(T(spark, sf))
    return p.groupBy("nationkey").agg(*survivor_aggs("source_rank", ["name", "acctbal", "mktsegment"]))


@register("a_13_ratio_class", """
SELECT l_orderkey,
  CASE WHEN count(CASE WHEN l_returnflag = 'N' THEN 1 END) = count(*) THEN 'Retail'
       ELSE 'W&R' END AS class
FROM lineitem GROUP BY l_orderkey""")
def a_13_ratio_class(spark, sf):
    return ratio_class(T(spark, sf).lineitem, ["l_orderkey"], F.col("l_returnflag") == "N",
                       "Retail", "W&R")


@register("a_14_zero_fill_groups", """
WITH c AS (
  SELECT o_custkey, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_pending
  FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_name, CAST(coalesce(n_orders, 0) AS BIGINT) AS n_orders,
       CAST(coalesce(n_pending, 0) AS BIGINT) AS n_pending
FROM customer LEFT JOIN c ON o_custkey = c_custkey""")
def a_14_zero_fill_groups(spark, sf):
    t = T(spark, sf)
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("o_orderstatus") == "P").alias("n_pending"))
    return zero_fill_groups(t.customer.select("c_custkey", "c_name"), counts, ["c_custkey"],
                            ["n_orders", "n_pending"])


@register("a_15_first_value_agg", """
WITH pre AS (SELECT user_id, event_type, max(value) AS v FROM events GROUP BY 1, 2)
SELECT user_id,
  max(v) FILTER (WHERE event_type = 'click') AS click,
  max(v) FILTER (WHERE event_type = 'error') AS error,
  max(v) FILTER (WHERE event_type = 'purchase') AS purchase,
  max(v) FILTER (WHERE event_type = 'signup') AS signup,
  max(v) FILTER (WHERE event_type = 'view') AS view
FROM pre GROUP BY user_id""")
def a_15_first_value_agg(spark, sf):
    e = T(spark, sf).events
    pre = e.groupBy("user_id", "event_type").agg(F.max("value").alias("v"))
    return pre.groupBy("user_id").pivot("event_type", ["click", "error", "purchase", "signup", "view"]) \
        .agg(F.first("v"))


@register("a_16_array_agg", """
SELECT o_custkey,
  coalesce(array_to_string(list_sort(list_distinct(
    list(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END)
      FILTER (WHERE o_orderstatus = 'F'))), ', '), '') AS approved_priorities
FROM orders GROUP BY o_custkey""")
def a_16_array_agg(spark, sf):
    o = T(spark, sf).orders
    vals = F.array_agg(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")))
    return o.groupBy("o_custkey").agg(
        F.concat_ws(", ", F.array_sort(F.array_distinct(vals))).alias("approved_priorities"))


@register("a_17_monthly_average_rate", """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_returnflag AS currency,
       round(avg(l_extendedprice / l_quantity), 2) AS avg_rate, count(*) AS n_rates
FROM lineitem GROUP BY 1, 2""")
def a_17_monthly_average_rate(spark, sf):
    li = T(spark, sf).lineitem
    return li.groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("month"),
                      F.col("l_returnflag").alias("currency")).agg(
        F.round(F.avg(F.col("l_extendedprice") / F.col("l_quantity")), 2).alias("avg_rate"),
        F.count(F.lit(1)).alias("n_rates"))


@register("a_18_indicator_count", """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, l_partkey,
    (CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) + (CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END)
    + (CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) + (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)
    + (CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS n_indicators
  FROM lineitem) WHERE n_indicators >= 4""")
def a_18_indicator_count(spark, sf):
    li = T(spark, sf).lineitem
    n = indicator_count([F.col("l_discount") > 0.05, F.col("l_tax") > 0.04, F.col("l_quantity") > 25,
                         F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"])
    return li.select("l_orderkey", "l_linenumber", "l_partkey", n.alias("n_indicators")) \
        .where(F.col("n_indicators") >= 4)
