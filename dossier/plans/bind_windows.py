"""W-* window operators bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from dossier.operators.ordered import ordered_scan
from dossier.operators.pick import (dedupe_latest, gaps_and_islands, global_extreme,
                                    nearest_in_time, priority_rank, rank_keep_ties,
                                    resolve_single_latest, state_transitions, with_key_aggregates)
from dossier.plans.common import T
from dossier.plans.registry import register

LI_REST = ("l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
           "l_returnflag, l_linestatus, l_shipdate")


@register("w_01_dedupe_latest", """
SELECT user_id, event_id, ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def w_01_dedupe_latest(spark, sf):
    e = T(spark, sf).events.select("user_id", "event_id", "ts", "event_type")
    return dedupe_latest(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


@register("w_02_qualify_first", f"""
SELECT l_orderkey, {LI_REST} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_shipdate DESC, l_extendedprice DESC, {LI_REST}) = 1""")
def w_02_qualify_first(spark, sf):
    li = T(spark, sf).lineitem
    return dedupe_latest(li, ["l_orderkey"], [F.col("l_shipdate").desc(),
                                              F.col("l_extendedprice").desc()])


@register("w_03_rank_keep_ties", """
SELECT p_brand, p_partkey, p_size FROM part
QUALIFY rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) = 1""")
def w_03_rank_keep_ties(spark, sf):
    p = T(spark, sf).part.select("p_brand", "p_partkey", "p_size")
    return rank_keep_ties(p, ["p_brand"], [F.col("p_size").desc()])


@register("w_04_dense_rank", """
SELECT s_suppkey, s_nationkey,
       CAST(dense_rank() OVER (PARTITION BY s_nationkey ORDER BY round(s_acctbal, -3) DESC) AS INTEGER) AS balance_rank
FROM supplier""")
def w_04_dense_rank(spark, sf):
    s = T(spark, sf).supplier.select("s_suppkey", "s_nationkey", F.round("s_acctbal", -3).alias("__b"))
    r = ordered_scan(s, ["s_nationkey"], [("__b", False), "s_suppkey"],
                     {"balance_rank": ("dense_rank",)}, rank_by=[("__b", False)])
    return r.select("s_suppkey", "s_nationkey", F.col("balance_rank").cast("int").alias("balance_rank"))


@register("w_05_previous_value", """
SELECT o_orderkey, o_custkey, o_orderpriority,
  CASE WHEN prev IS DISTINCT FROM o_orderpriority THEN prev END AS previous_priority
FROM (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
        AS prev FROM orders)""")
def w_05_previous_value(spark, sf):
    o = T(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    x = ordered_scan(o, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                     {"__prev": ("lag", "o_orderpriority")})
    prev = F.when(~F.col("__prev").eqNullSafe(F.col("o_orderpriority")), F.col("__prev"))
    return x.select("o_orderkey", "o_custkey", "o_orderpriority", prev.alias("previous_priority"))


@register("w_06_next_value", """
SELECT o_orderkey, lead(o_orderdate, 1, NULL) OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate, o_orderkey) AS next_order_date FROM orders""")
def w_06_next_value(spark, sf):
    o = T(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    x = ordered_scan(o, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                     {"next_order_date": ("lead", "o_orderdate")})
    return x.select("o_orderkey", "next_order_date")


@register("w_07_first_value", """
SELECT event_id, first_value(event_type) OVER (PARTITION BY user_id
  ORDER BY ts DESC, event_id DESC) AS latest_type FROM events""")
def w_07_first_value(spark, sf):
    e = T(spark, sf).events.select("event_id", "user_id", "ts", "event_type")
    # with the default frame the first value of a descending order is the key's newest row
    x = with_key_aggregates(e, ["user_id"], [F.max_by("event_type", F.struct("ts", "event_id")).alias("latest_type")])
    return x.select("event_id", "latest_type")


@register("w_08_running_sum", """
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_value FROM events""")
def w_08_running_sum(spark, sf):
    e = T(spark, sf).events.select("event_id", "user_id", "ts", "value")
    x = ordered_scan(e, ["user_id"], ["ts", "event_id"], {"__s": ("sum", "value")})
    # RANGE frame: rows sharing a timestamp (peers) all get the total at the last peer
    x = with_key_aggregates(x, ["user_id", "ts"], [F.max_by("__s", "event_id").alias("__r")])
    return x.select("event_id", F.round("__r", 2).alias("running_value"))


@register("w_09_count_over", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  count(*) OVER (PARTITION BY l_orderkey) AS lines_in_order,
  count(*) OVER (PARTITION BY l_orderkey ORDER BY {LI_REST}
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_lines
FROM lineitem""")
def w_09_count_over(spark, sf):
    li = T(spark, sf).lineitem
    rest = [c.strip() for c in LI_REST.split(",")]
    x = ordered_scan(li, ["l_orderkey"], rest, {"running_lines": ("row_number",)})
    x = with_key_aggregates(x, ["l_orderkey"], [F.count(F.lit(1)).alias("lines_in_order")])
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "lines_in_order",
                    F.col("running_lines").cast("bigint").alias("running_lines"))


@register("w_10_extreme_over", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
  max(l_extendedprice) OVER (PARTITION BY l_orderkey) AS max_price,
  l_extendedprice = max(l_extendedprice) OVER (PARTITION BY l_orderkey) AS is_max
FROM lineitem""")
def w_10_extreme_over(spark, sf):
    li = T(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    x = with_key_aggregates(li, ["l_orderkey"], [F.max("l_extendedprice").alias("max_price")])
    return x.withColumn("is_max", F.col("l_extendedprice") == F.col("max_price"))


@register("w_11_conditional_extreme_over", """
SELECT o_orderkey, o_custkey,
  max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) OVER (PARTITION BY o_custkey)
    AS latest_approved
FROM orders""")
def w_11_conditional_extreme_over(spark, sf):
    o = T(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    x = with_key_aggregates(o, ["o_custkey"], [F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")))
                                               .alias("latest_approved")])
    return x.select("o_orderkey", "o_custkey", "latest_approved")


GAPS_SQL = """
WITH iv AS (
  SELECT user_id, CAST(ts AS DATE) AS s, CAST(ts AS DATE) + CAST(event_id % 3 AS INTEGER) AS e
  FROM events),
f AS (
  SELECT *, CASE WHEN max(e) OVER w1 IS NULL OR (s - max(e) OVER w1) > 1 THEN 1 ELSE 0 END AS nw
  FROM iv WINDOW w1 AS (PARTITION BY user_id ORDER BY s, e
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (
  SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY s, e
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM f)
SELECT user_id, CAST(island AS BIGINT) AS island, min(s) AS island_start, max(e) AS island_end,
       count(*) AS n_items
FROM g GROUP BY user_id, island"""


@register("w_12_gaps_and_islands", GAPS_SQL)
def w_12_gaps_and_islands(spark, sf):
    e = T(spark, sf).events
    iv = e.select("user_id", F.to_date("ts").alias("s"),
                  F.date_add(F.to_date("ts"), (F.col("event_id") % 3).cast("int")).alias("e"))
    return gaps_and_islands(iv, ["user_id"], "s", "e", 1)


@register("w_13_row_number_pivot", """
WITH n AS (SELECT l_orderkey, l_partkey,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber) AS rn
           FROM lineitem)
SELECT l_orderkey,
  max(l_partkey) FILTER (WHERE rn = 1) AS part_1,
  max(l_partkey) FILTER (WHERE rn = 2) AS part_2,
  max(l_partkey) FILTER (WHERE rn = 3) AS part_3,
  max(l_partkey) FILTER (WHERE rn = 4) AS part_4,
  count(*) FILTER (WHERE rn > 4) AS n_more
FROM n GROUP BY l_orderkey""")
def w_13_row_number_pivot(spark, sf):
    li = T(spark, sf).lineitem
    w = Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_linenumber")
    n = li.select("l_orderkey", "l_partkey", F.row_number().over(w).alias("rn"))
    # the first four by column, and how many values there are beyond them
    return n.groupBy("l_orderkey").agg(
        *[F.max(F.when(F.col("rn") == i, F.col("l_partkey"))).alias(f"part_{i}") for i in range(1, 5)],
        F.count_if(F.col("rn") > 4).alias("n_more"))


@register("w_14_priority_pick", """
SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY
  CASE WHEN lower(o_orderpriority) LIKE '%urgent%' THEN 1
       WHEN lower(o_orderpriority) LIKE '%high%' THEN 2 ELSE 10 END,
  o_orderdate DESC, o_orderkey) = 1""")
def w_14_priority_pick(spark, sf):
    o = T(spark, sf).orders
    pr = priority_rank("o_orderpriority", ["%urgent%", "%high%"], 10)
    w = Window.partitionBy("o_custkey").orderBy(pr, F.col("o_orderdate").desc(), F.col("o_orderkey"))
    return (o.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= 1)
            .select("o_custkey", "o_orderkey", "o_orderpriority"))


@register("w_15_latest_and_direct", f"""
SELECT l_orderkey, {LI_REST} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY
  CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, l_shipdate DESC, {LI_REST}) = 1""")
def w_15_latest_and_direct(spark, sf):
    li = T(spark, sf).lineitem
    direct = F.when(F.col("l_returnflag") == "R", 0).otherwise(1)
    return dedupe_latest(li, ["l_orderkey"], [direct, F.col("l_shipdate").desc()])


@register("w_16_resolve_single_latest", """
WITH f AS (
  SELECT o_orderkey, o_custkey, o_orderstatus = 'F' AS approved,
    count(CASE WHEN o_orderstatus = 'F' THEN 1 END) OVER (PARTITION BY o_custkey) AS n_flag,
    row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END,
      o_orderpriority, o_orderdate DESC NULLS LAST, o_orderkey) AS rn
  FROM orders)
SELECT o_orderkey, o_custkey,
  CASE WHEN n_flag <= 1 THEN approved ELSE approved AND rn = 1 END AS is_latest_approved
FROM f""")
def w_16_resolve_single_latest(spark, sf):
    o = T(spark, sf).orders.withColumn("approved", F.col("o_orderstatus") == "F")
    r = resolve_single_latest(o, "o_custkey", "approved",
                              ["o_orderpriority", ("o_orderdate", False), "o_orderkey"], out="is_latest_approved")
    return r.select("o_orderkey", "o_custkey", "is_latest_approved")


@register("w_17_state_transitions", """
SELECT user_id, CAST(sum(CASE WHEN prev = 'view' AND event_type = 'purchase' THEN 1 ELSE 0 END)
                     AS BIGINT) AS n_transitions
FROM (SELECT user_id, event_type,
        lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
GROUP BY user_id""")
def w_17_state_transitions(spark, sf):
    e = T(spark, sf).events
    return state_transitions(e, ["user_id"], ["ts", "event_id"], "event_type",
                             "view", "purchase")


@register("w_18_retry_number", """
SELECT event_id, user_id AS job, event_type AS task, CAST(ts AS DATE) AS run_date,
  CAST(row_number() OVER w AS INTEGER) AS retry_no,
  CAST(floor(datediff('microsecond', lag(ts) OVER w, ts) / 60000000) AS BIGINT) AS minutes_since_prev
FROM events
WINDOW w AS (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id)""")
def w_18_retry_number(spark, sf):
    e = T(spark, sf).events.select("event_id", F.col("user_id").alias("job"), F.col("event_type").alias("task"),
                                   F.to_date("ts").alias("run_date"), "ts")
    x = ordered_scan(e, ["job", "task", "run_date"], ["ts", "event_id"],
                     {"retry_no": ("row_number",), "__prev_ts": ("lag", "ts")})
    micros = F.timestamp_diff("MICROSECOND", F.col("__prev_ts"), F.col("ts"))
    return x.select("event_id", "job", "task", "run_date", F.col("retry_no").cast("int").alias("retry_no"),
                    F.floor(micros / 60000000).cast("bigint").alias("minutes_since_prev"))


@register("w_19_nearest_in_time", """
SELECT o_orderkey, o_custkey, event_id, CAST(ts AS DATE) AS ts, CAST(day_diff AS INTEGER) AS day_diff FROM (
  SELECT o_orderkey, o_custkey, event_id, ts,
    abs(datediff('day', CAST(o_orderdate AS DATE), CAST(ts AS DATE))) AS day_diff,
    row_number() OVER (PARTITION BY o_orderkey
      ORDER BY abs(datediff('day', CAST(o_orderdate AS DATE), CAST(ts AS DATE))),
               CAST(ts AS DATE), event_id) AS rn
  FROM orders JOIN events ON o_custkey = user_id)
WHERE rn = 1""")
def w_19_nearest_in_time(spark, sf):
    t = T(spark, sf)
    o = t.orders.select("o_orderkey", F.col("o_custkey"), "o_orderdate")
    e = t.events.select(F.col("user_id").alias("o_custkey"), "event_id", "ts")
    r = nearest_in_time(o, e, "o_custkey", "o_orderdate", "ts", "o_orderkey", "event_id")
    return r.select("o_orderkey", "o_custkey", "event_id", "ts", "day_diff")


@register("w_20_global_extreme", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date,
       max(CAST(l_shipdate AS DATE)) OVER () AS last_ship_date
FROM lineitem""")
def w_20_global_extreme(spark, sf):
    li = T(spark, sf).lineitem.select("l_orderkey", "l_linenumber",
                                      F.to_date("l_shipdate").alias("ship_date"))
    return global_extreme(li, "ship_date", "last_ship_date")
