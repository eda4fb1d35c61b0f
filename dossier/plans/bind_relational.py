"""P-* projections/filters and J-* joins bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.operators.relational import (any_column_equals, blank_to_null,
                                          cast_all_string, coalesce_sources, drop_all_null,
                                          project, protect_names, safe_convert,
                                          scalar_subquery_filter, theta_or_join)
from dossier.operators.joins import interval_join, not_in
from dossier.operators.pick import dedupe_latest
from dossier.plans.common import AS_OF, T
from dossier.plans.registry import register


# ----------------------------------------------------------------------- P

@register("p_01_project", """
SELECT c_custkey AS id, upper(c_name) AS name_upper, 'CUS' AS source, c_acctbal AS balance,
       c_nationkey
FROM customer""")
def p_01_project(spark, sf):
    return project(T(spark, sf).customer, {
        "id": "c_custkey", "name_upper": F.upper("c_name"), "source": F.lit("CUS"),
        "balance": "c_acctbal", "c_nationkey": "c_nationkey"})


@register("p_02_filter", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_linestatus
FROM lineitem
WHERE (l_quantity >= 10 AND l_quantity < 40)
  AND l_discount BETWEEN 0.02 AND 0.06
  AND l_returnflag IN ('A', 'R')
  AND NOT (l_linestatus <> 'F' AND l_tax = 0)
  AND (l_shipdate >= TIMESTAMP '1996-01-01' OR l_quantity = 20)""")
def p_02_filter(spark, sf):
    li = T(spark, sf).lineitem
    return li.where(
        ((F.col("l_quantity") >= 10) & (F.col("l_quantity") < 40))
        & F.col("l_discount").between(0.02, 0.06)
        & F.col("l_returnflag").isin("A", "R")
        & ~((F.col("l_linestatus") != "F") & (F.col("l_tax") == 0))
        & ((F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
           | (F.col("l_quantity") == 20))
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag",
             "l_linestatus")


@register("p_02_filter_pattern", """
SELECT p_partkey, p_name, p_brand
FROM part
WHERE (p_name LIKE 'red%' OR regexp_matches(p_name, '^(blue|hot) (bolt|gear)$'))
  AND p_brand IS NOT NULL AND p_type NOT LIKE '%PROMO%'""")
def p_02_filter_pattern(spark, sf):
    p = T(spark, sf).part
    return p.where((F.col("p_name").like("red%") | F.col("p_name").rlike("^(blue|hot) (bolt|gear)$"))
                   & F.col("p_brand").isNotNull() & ~F.col("p_type").like("%PROMO%")) \
        .select("p_partkey", "p_name", "p_brand")


@register("p_03_case_map", """
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN 'approved'
       WHEN o_totalprice > 300000 THEN 'large open'
       WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'urgent pending'
       ELSE 'other' END AS case_class,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
       ELSE 9 END AS prio
FROM orders""")
def p_03_case_map(spark, sf):
    o = T(spark, sf).orders
    cls = (F.when(F.col("o_orderstatus") == "F", "approved")
           .when(F.col("o_totalprice") > 300000, "large open")
           .when((F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
                 "urgent pending")
           .otherwise("other"))
    pr = F.col("o_orderpriority")
    prio = (F.when(pr == "1-URGENT", 1).when(pr == "2-HIGH", 2).when(pr == "3-MEDIUM", 3)
            .otherwise(9))
    return o.select("o_orderkey", cls.alias("case_class"), prio.alias("prio"))


@register("p_04_distinct", """
SELECT DISTINCT c_nationkey, c_mktsegment FROM customer""")
def p_04_distinct(spark, sf):
    return T(spark, sf).customer.select("c_nationkey", "c_mktsegment").distinct()


@register("p_04_distinct_subset", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment
                           ORDER BY c_acctbal DESC, c_custkey) = 1""")
def p_04_distinct_subset(spark, sf):
    c = T(spark, sf).customer
    d = dedupe_latest(c, ["c_nationkey", "c_mktsegment"], [F.col("c_acctbal").desc()])
    return d.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@register("p_05_blank_to_null", """
SELECT event_id,
  CASE WHEN lower(trim(status_text)) IN ('', 'null') THEN NULL ELSE status_text END AS status_text,
  CASE WHEN lower(trim(props)) IN ('', 'null') THEN NULL ELSE props END AS props
FROM (SELECT event_id, props,
        CASE WHEN event_type = 'error' THEN '  ' WHEN event_type = 'view' THEN 'NULL'
             ELSE event_type END AS status_text FROM events)""")
def p_05_blank_to_null(spark, sf):
    e = T(spark, sf).events
    raw = e.select("event_id", "props", F.when(F.col("event_type") == "error", "  ")
                   .when(F.col("event_type") == "view", "NULL")
                   .otherwise(F.col("event_type")).alias("status_text"))
    return blank_to_null(raw).select("event_id", "status_text", "props")


@register("p_06_drop_all_null", """
SELECT d.doc_id, d.lang, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL OR l.toxic IS NOT NULL""")
def p_06_drop_all_null(spark, sf):
    t = T(spark, sf)
    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return drop_all_null(j, ["quality", "toxic"])


@register("p_06_fillna", """
SELECT d.doc_id, d.lang, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def p_06_fillna(spark, sf):
    t = T(spark, sf)
    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return j.na.fill({"quality": -1, "toxic": -1})


@register("p_07_cast_all_string", r"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id,
       regexp_replace(text, '[\r\n]+', ' ', 'g') AS text,
       lang, source, CAST(n_chars AS VARCHAR) AS n_chars
FROM documents""")
def p_07_cast_all_string(spark, sf):
    return cast_all_string(T(spark, sf).documents)


@register("p_09_scalar_subquery_filter", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def p_09_scalar_subquery_filter(spark, sf):
    o = T(spark, sf).orders
    return scalar_subquery_filter(o, "o_orderdate", o, "o_orderdate") \
        .select("o_orderkey", "o_custkey", "o_orderdate")


@register("p_10_coalesce_sources", """
SELECT c.c_custkey AS key, coalesce(s.s_name, c.c_name) AS name,
       coalesce(s.s_acctbal, c.c_acctbal) AS balance,
       coalesce(s.s_nationkey, c.c_nationkey) AS nationkey
FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey""")
def p_10_coalesce_sources(spark, sf):
    t = T(spark, sf)
    j = t.customer.join(t.supplier, F.col("s_suppkey") == F.col("c_custkey"), "left")
    return j.select(F.col("c_custkey").alias("key"),
                    coalesce_sources("s_name", "c_name").alias("name"),
                    coalesce_sources("s_acctbal", "c_acctbal").alias("balance"),
                    coalesce_sources("s_nationkey", "c_nationkey").alias("nationkey"))


@register("p_11_protect_names", """
SELECT c_custkey,
  CASE WHEN p.k IS NOT NULL THEN 'protected account ' || CAST(c_custkey AS VARCHAR)
       ELSE c_name END AS c_name
FROM customer LEFT JOIN (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal < 0) p
  ON c_custkey = p.k""")
def p_11_protect_names(spark, sf):
    c = T(spark, sf).customer
    prot = c.where(F.col("c_acctbal") < 0).select("c_custkey")
    return protect_names(c.select("c_custkey", "c_name"), "c_custkey", "c_name", prot, "c_custkey")


@register("p_12_in_scope_reason", """
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN 'Pending: out of scope'
       WHEN o_orderpriority = '5-LOW' THEN 'Low priority: out of scope'
       WHEN o_totalprice < 5000 THEN 'Below threshold: out of scope'
       ELSE 'In scope for sampling' END AS scope_reason
FROM orders""")
def p_12_in_scope_reason(spark, sf):
    o = T(spark, sf).orders
    reason = (F.when(F.col("o_orderstatus") == "P", "Pending: out of scope")
              .when(F.col("o_orderpriority") == "5-LOW", "Low priority: out of scope")
              .when(F.col("o_totalprice") < 5000, "Below threshold: out of scope")
              .otherwise("In scope for sampling"))
    return o.select("o_orderkey", reason.alias("scope_reason"))


@register("p_13_any_column_equals", """
SELECT * FROM nation
WHERE CAST(n_nationkey AS VARCHAR) = '3' OR n_name = '3' OR CAST(n_regionkey AS VARCHAR) = '3'""")
def p_13_any_column_equals(spark, sf):
    return any_column_equals(T(spark, sf).nation, "3")


@register("p_14_safe_convert", r"""
SELECT event_id,
  coalesce(TRY_CAST(NULLIF(regexp_extract(props, '"k": (\d+)', 1), '') AS BIGINT), 0) AS k,
  coalesce(TRY_CAST(regexp_extract(props, '"q": (\d+)', 1) AS BIGINT), 0) AS q,
  TRY_CAST(CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN 'false'
                ELSE event_type END AS BOOLEAN) AS is_click,
  TRY_CAST(CASE WHEN event_type = 'error' THEN 'not a time'
                ELSE strftime(ts, '%Y-%m-%d') || ' 00:00:00' END AS TIMESTAMP) AS day_start
FROM events""")
def p_14_safe_convert(spark, sf):
    e = T(spark, sf).events
    b = (F.when(F.col("event_type") == "click", "true").when(F.col("event_type") == "view", "false")
         .otherwise(F.col("event_type")))
    tstext = F.when(F.col("event_type") == "error", F.lit("not a time")) \
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" 00:00:00")))
    return e.select("event_id",
                    safe_convert(F.nullif(F.regexp_extract("props", r'"k": (\d+)', 1), F.lit("")),
                                 "bigint").alias("k"),
                    safe_convert(F.regexp_extract("props", r'"q": (\d+)', 1), "bigint").alias("q"),
                    safe_convert(b, "boolean").alias("is_click"),
                    safe_convert(tstext, "timestamp").alias("day_start"))


# ----------------------------------------------------------------------- J

@register("j_inner", """
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def j_inner(spark, sf):
    t = T(spark, sf)
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "inner") \
        .select("o_orderkey", "c_name", "o_totalprice")


@register("j_left", """
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = 2 * c_custkey""")
def j_left(spark, sf):
    t = T(spark, sf)
    return t.customer.join(t.orders, F.col("o_custkey") == 2 * F.col("c_custkey"), "left") \
        .select("c_custkey", "o_orderkey")


@register("j_full", """
SELECT coalesce(c.c_custkey, s.s_suppkey) AS key, c.c_name, s.s_name
FROM customer c FULL OUTER JOIN supplier s ON c.c_custkey = 2 * s.s_suppkey""")
def j_full(spark, sf):
    t = T(spark, sf)
    j = t.customer.join(t.supplier, F.col("c_custkey") == 2 * F.col("s_suppkey"), "full")
    return j.select(F.coalesce("c_custkey", "s_suppkey").alias("key"), "c_name", "s_name")


@register("j_anti", """
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = 2 * c_custkey)""")
def j_anti(spark, sf):
    t = T(spark, sf)
    return t.customer.join(t.orders, F.col("o_custkey") == 2 * F.col("c_custkey"), "left_anti") \
        .select("c_custkey", "c_name")


@register("j_semi", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT 2 * c_custkey FROM customer)""")
def j_semi(spark, sf):
    t = T(spark, sf)
    return t.orders.join(t.customer, F.col("o_custkey") == 2 * F.col("c_custkey"), "left_semi") \
        .select("o_orderkey", "o_custkey")


@register("j_notin", """
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def j_notin(spark, sf):
    t = T(spark, sf)
    sub = t.orders.where(F.col("o_totalprice") > 400000).select("o_custkey")
    return not_in(t.customer.select("c_custkey"), "c_custkey", sub, "o_custkey")


@register("j_notin_null", """
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END
                        FROM orders WHERE o_totalprice > 400000)""")
def j_notin_null(spark, sf):
    t = T(spark, sf)
    sub = t.orders.where(F.col("o_totalprice") > 400000).select(
        F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_custkey")).alias("k"))
    return not_in(t.customer.select("c_custkey"), "c_custkey", sub, "k")


@register("j_notexists", """
SELECT o_orderkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                  AND l.l_linestatus = o.o_orderstatus)""")
def j_notexists(spark, sf):
    t = T(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_linestatus")
    return t.orders.join(li, (F.col("l_orderkey") == F.col("o_orderkey"))
                         & (F.col("l_linestatus") == F.col("o_orderstatus")), "left_anti") \
        .select("o_orderkey", "o_orderstatus")


@register("j_self", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate FROM orders o
JOIN (SELECT o_custkey, max(o_orderdate) AS max_date FROM orders GROUP BY o_custkey) m
  ON o.o_custkey = m.o_custkey AND o.o_orderdate = m.max_date""")
def j_self(spark, sf):
    o = T(spark, sf).orders
    m = o.groupBy(F.col("o_custkey").alias("__k")).agg(F.max("o_orderdate").alias("__d"))
    return o.join(m, (F.col("o_custkey") == F.col("__k")) & (F.col("o_orderdate") == F.col("__d"))) \
        .select("o_orderkey", "o_custkey", "o_orderdate")


@register("j_theta", """
SELECT DISTINCT c_custkey, n_nationkey, n_name FROM customer JOIN nation
  ON lower(n_name) = lower('nation_' || CAST(c_nationkey AS VARCHAR))
  OR n_nationkey = CAST(c_custkey % 25 AS INTEGER)""")
def j_theta(spark, sf):
    t = T(spark, sf)
    c = t.customer.select("c_custkey", "c_nationkey",
                          F.lower(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")))
                          .alias("country_text"),
                          (F.col("c_custkey") % 25).cast("int").alias("residence"))
    n = t.nation.select("n_nationkey", "n_name", F.lower("n_name").alias("n_lname"))
    j = theta_or_join(c, n, [(F.col("country_text"), F.col("n_lname")),
                             (F.col("residence"), F.col("n_nationkey"))])
    return j.select("c_custkey", "n_nationkey", "n_name").distinct()


@register("j_typed", """
SELECT c_custkey, n.n_name AS america_nation
FROM customer LEFT JOIN nation n ON c_nationkey = n.n_nationkey AND n.n_regionkey = 1""")
def j_typed(spark, sf):
    t = T(spark, sf)
    n = t.nation
    j = t.customer.join(n, (F.col("c_nationkey") == F.col("n_nationkey"))
                        & (F.col("n_regionkey") == F.lit(1)), "left")
    return j.select("c_custkey", F.col("n_name").alias("america_nation"))


@register("j_interval", f"""
WITH s AS (
  SELECT user_id, ts AS act,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS repl
  FROM events WHERE event_type = 'signup')
SELECT p.event_id, p.user_id, s.act
FROM events p JOIN s ON p.user_id = s.user_id
 AND p.ts > s.act AND p.ts < coalesce(s.repl, TIMESTAMP '{AS_OF} 00:00:00' + INTERVAL 9999 DAY)
WHERE p.event_type = 'purchase'""")
def j_interval(spark, sf):
    e = T(spark, sf).events
    from dossier.operators.ordered import ordered_scan
    s = ordered_scan(e.where(F.col("event_type") == "signup").select("user_id", "event_id", F.col("ts").alias("act")),
                     ["user_id"], ["act", "event_id"], {"repl": ("lead", "act")}).drop("event_id")
    far = F.lit(AS_OF).cast("timestamp_ntz") + F.expr("INTERVAL 9999 DAYS")
    s = s.withColumn("until", F.coalesce("repl", far))
    p = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return interval_join(p, s, "user_id", "ts", "act", "until", bucket="month") \
        .select("event_id", "user_id", "act")


@register("j_expr", """
SELECT e.event_id, c.c_custkey, c.c_name
FROM (SELECT event_id, CAST(user_id AS VARCHAR) || ':' || CAST(event_id AS VARCHAR) AS ref
      FROM events) e
JOIN customer c ON substring(e.ref, 1, instr(e.ref, ':') - 1) = CAST(c.c_custkey AS VARCHAR)""")
def j_expr(spark, sf):
    t = T(spark, sf)
    e = t.events.select("event_id", F.concat_ws(":", F.col("user_id").cast("string"),
                                                F.col("event_id").cast("string")).alias("ref"))
    e = e.withColumn("__k", F.expr("substring(ref, 1, instr(ref, ':') - 1)"))
    c = t.customer.withColumn("__ck", F.col("c_custkey").cast("string"))
    return e.join(c, F.col("__k") == F.col("__ck")).select("event_id", "c_custkey", "c_name")


@register("j_broadcast", """
SELECT r_name, CAST(count(*) AS BIGINT) AS n_lines,
       round(sum(l_extendedprice), 2) AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name""")
def j_broadcast(spark, sf):
    t = T(spark, sf)
    # no hint: AQE broadcasts nation and region by their measured sizes
    n = t.nation
    r = t.region
    j = (t.lineitem.select("l_suppkey", "l_extendedprice")
         .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
         .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.groupBy("r_name").agg(F.count(F.lit(1)).alias("n_lines"),
                                   F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


@register("j_chain", """
WITH o AS (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS order_value
           FROM orders GROUP BY o_custkey),
     s AS (SELECT s_nationkey, count(*) AS n_suppliers FROM supplier GROUP BY s_nationkey)
SELECT c_custkey, n_name, r_name, CAST(coalesce(o.n_orders, 0) AS BIGINT) AS n_orders,
       o.order_value, CAST(coalesce(s.n_suppliers, 0) AS BIGINT) AS n_suppliers
FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN o ON o.o_custkey = c_custkey
LEFT JOIN s ON s.s_nationkey = c_nationkey""")
def j_chain(spark, sf):
    t = T(spark, sf)
    o = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                          F.round(F.sum("o_totalprice"), 2).alias("order_value"))
    s = t.supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_suppliers"))
    j = (t.customer
         .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
         .join(o, F.col("o_custkey") == F.col("c_custkey"), "left")
         .join(s, F.col("s_nationkey") == F.col("c_nationkey"), "left"))
    return j.select("c_custkey", "n_name", "r_name",
                    F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("n_orders"),
                    "order_value",
                    F.coalesce("n_suppliers", F.lit(0)).cast("bigint").alias("n_suppliers"))
