"""T-* work time / timeliness, M-* money and N-01 bound to the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dossier.operators import money as M
from dossier.operators import worktime as W
from dossier.plans.common import AS_OF, T
from dossier.plans.registry import register

D = dt.date

WD_SQL = """
WITH x AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS s,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
         ELSE CAST(l_shipdate AS DATE) + l_linenumber * 3 END AS e
  FROM lineitem),
y AS (SELECT *, CASE WHEN s IS NULL OR e IS NULL OR e < s THEN []
                     ELSE list_filter(generate_series(s, e, INTERVAL 1 DAY), lambda d: isodow(d) < 6) END AS wd
      FROM x)
SELECT l_orderkey, l_linenumber, CAST(len(wd) AS INTEGER) AS n_workdays, CAST(wd[1] AS DATE) AS first_workday,
       CAST(wd[-1] AS DATE) AS last_workday FROM y"""


def _wd(spark, sf):
    li = T(spark, sf).lineitem
    s = F.to_date("l_shipdate")
    e = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(None).cast("date")) \
        .otherwise(F.date_add(s, F.col("l_linenumber") * 3))
    days = W.workdays(s, e)
    return li.select("l_orderkey", "l_linenumber", F.size(days).alias("n_workdays"),
                     F.try_element_at(days, F.lit(1)).alias("first_workday"),
                     F.try_element_at(days, F.lit(-1)).alias("last_workday"))


@register("t_01_workdays", WD_SQL)
def t_01_workdays(spark, sf):
    return _wd(spark, sf)


@register("n_01_udf_replaced", WD_SQL)
def n_01_udf_replaced(spark, sf):
    """The reference's only Python UDF (list of workdays) as built-ins: no BatchEvalPython."""
    return _wd(spark, sf)


@register("t_02_days_in_status", """
WITH x AS (SELECT l_orderkey, l_linestatus,
             unnest(generate_series(CAST(l_shipdate AS DATE), CAST(l_shipdate AS DATE) + l_linenumber * 3,
                                    INTERVAL 1 DAY)) AS d FROM lineitem),
y AS (SELECT DISTINCT l_orderkey, l_linestatus, CAST(d AS DATE) AS d FROM x WHERE isodow(d) < 6)
SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'F') AS days_F,
       count(*) FILTER (WHERE l_linestatus = 'O') AS days_O
FROM y GROUP BY l_orderkey""")
def t_02_days_in_status(spark, sf):
    t = T(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_linestatus", F.to_date("l_shipdate").alias("s"),
                           F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber") * 3).alias("e"))
    return W.days_in_status(li, ["l_orderkey"], "l_linestatus", "s", "e", ["F", "O"], tasks=t.tasks("lineitem", 2))


@register("t_03_days_in_rebound", """
WITH e AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS s,
    coalesce(CAST(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DATE), CAST(ts AS DATE)) AS e,
    min(CASE WHEN event_type = 'error' THEN CAST(ts AS DATE) END) OVER (PARTITION BY user_id) AS first_err
  FROM events),
x AS (SELECT user_id, greatest(s, first_err) AS s, e FROM e
      WHERE event_type = 'view' AND first_err IS NOT NULL AND e >= greatest(s, first_err)),
d AS (SELECT DISTINCT user_id, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM x),
c AS (SELECT user_id, count(*) FILTER (WHERE isodow(d) < 6) AS n FROM d GROUP BY user_id)
SELECT u.user_id, CAST(coalesce(c.n, 0) AS BIGINT) AS rebound_days
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN c ON u.user_id = c.user_id""")
def t_03_days_in_rebound(spark, sf):
    t = T(spark, sf)
    return W.days_in_rebound(t.events, ["user_id"], "event_type", "ts", ["ts", "event_id"], "view", "error",
                             tasks=t.tasks("events", 2))


@register("t_04_workday_count_formula", """
WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s,
             CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 10000) AS INTEGER) AS e FROM orders)
SELECT o_orderkey,
  CAST(len(list_filter(generate_series(s, e, INTERVAL 1 DAY), lambda d: isodow(d) < 6)) AS INTEGER) AS n_formula,
  CAST(len(list_filter(generate_series(s, e, INTERVAL 1 DAY), lambda d: isodow(d) < 6)) AS INTEGER) AS n_enumerated
FROM x""")
def t_04_workday_count_formula(spark, sf):
    o = T(spark, sf).orders
    s = F.to_date("o_orderdate")
    e = F.date_add(s, F.floor(F.col("o_totalprice") / 10000).cast("int"))
    return o.select("o_orderkey", W.workday_count(s, e).alias("n_formula"),
                    F.size(W.workdays(s, e)).alias("n_enumerated"))


@register("t_05_shift_to_monday", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) - 90 - CAST(isodow(CAST(o_orderdate AS DATE) - 90) - 1 AS INTEGER) AS review_start
FROM orders""")
def t_05_shift_to_monday(spark, sf):
    return T(spark, sf).orders.select("o_orderkey", W.shift_to_monday("o_orderdate").alias("review_start"))


@register("t_06_valid_planned_date", """
WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 1000) AS INTEGER) AS planned,
                  CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS DATE) AS nrd FROM orders)
SELECT o_orderkey, CASE WHEN planned IS NOT NULL AND nrd - planned < 300 AND planned < nrd THEN planned
                        ELSE nrd - 69 END AS planned_valid
FROM x""")
def t_06_valid_planned_date(spark, sf):
    o = T(spark, sf).orders
    planned = F.date_add(F.to_date("o_orderdate"), F.floor(F.col("o_totalprice") / 1000).cast("int"))
    nrd = F.add_months(F.to_date("o_orderdate"), 12)
    return o.select("o_orderkey", W.valid_planned_date(planned, nrd).alias("planned_valid"))


REVIEW_TYPE = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'Event Driven Review' WHEN '2-HIGH' THEN 'Periodic Review' "
               "WHEN '3-MEDIUM' THEN 'Initial On-Boarding' WHEN '4-NOT SPECIFIED' THEN 'Offboarding' "
               "ELSE 'QC EDR' END")


@register("t_07_completed_on_time", f"""
WITH c AS (
  SELECT o_custkey, o_orderkey, {REVIEW_TYPE} AS review_type, CAST(o_orderdate AS DATE) AS signoff,
    CAST(o_orderkey % 180 AS INTEGER) AS duration,
    CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter, o_totalprice > 300000 AS high FROM orders),
base AS (
  SELECT *, CASE WHEN high THEN CAST(quarter + INTERVAL 14 MONTH AS DATE)
                 WHEN review_type = 'Event Driven Review' THEN signoff - duration + 90
                 ELSE CAST(quarter + INTERVAL 12 MONTH AS DATE) END AS nrd FROM c),
former AS (SELECT *, lag(nrd) OVER (PARTITION BY o_custkey ORDER BY signoff, o_orderkey) AS former_nrd FROM base),
s AS (
  SELECT *, lead(signoff) OVER (PARTITION BY o_custkey ORDER BY signoff, o_orderkey) AS next_signoff
  FROM base WHERE review_type <> 'QC EDR' AND o_custkey NOT IN (
    SELECT o_custkey FROM former WHERE nrd = former_nrd AND review_type <> 'Offboarding'))
SELECT o_custkey, o_orderkey, signoff, next_signoff, nrd, CAST(CASE
    WHEN review_type = 'Event Driven Review' AND duration <= 90 THEN 1
    WHEN review_type = 'Event Driven Review' AND duration > 90 THEN 0
    WHEN next_signoff <= nrd THEN 1
    WHEN next_signoff > nrd THEN 0
    WHEN nrd < DATE '{AS_OF}' AND next_signoff IS NULL THEN 0 END AS INTEGER) AS completed_on_time
FROM s""")
def t_07_completed_on_time(spark, sf):
    o = T(spark, sf).orders
    rt = (F.when(F.col("o_orderpriority") == "1-URGENT", "Event Driven Review")
          .when(F.col("o_orderpriority") == "2-HIGH", "Periodic Review")
          .when(F.col("o_orderpriority") == "3-MEDIUM", "Initial On-Boarding")
          .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Offboarding").otherwise("QC EDR"))
    quarter, days = F.trunc(F.to_date("o_orderdate"), "quarter"), (F.col("o_orderkey") % 180).cast("int")
    nrd = (F.when(F.col("o_totalprice") > 300000, F.add_months(quarter, 14))
           .when(rt == "Event Driven Review", F.date_add(F.date_sub(F.to_date("o_orderdate"), days), 90))
           .otherwise(F.add_months(quarter, 12)))
    cases = o.select("o_custkey", "o_orderkey", rt.alias("review_type"), "o_orderdate", nrd.alias("next_review"),
                     days.alias("duration"))
    return W.completed_on_time(cases, "o_custkey", "o_orderkey", "review_type", "o_orderdate", "next_review",
                               "duration", D.fromisoformat(AS_OF))


@register("t_08_plan_vs_actual_snapshot", """
WITH h AS (
  SELECT o_orderkey, o_orderstatus, DATE '1998-01-01' AS snapshot_date FROM orders
  WHERE o_orderdate < TIMESTAMP '1998-01-01'
  UNION ALL
  SELECT o_orderkey, CASE WHEN o_totalprice > 150000 THEN 'F' ELSE o_orderstatus END, DATE '1998-07-01'
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01' AND o_orderpriority <> '5-LOW'),
jan AS (SELECT * FROM h WHERE snapshot_date = DATE '1998-01-01'),
lat AS (SELECT * FROM h WHERE snapshot_date = DATE '1998-07-01')
SELECT jan.o_orderkey, CASE WHEN lat.o_orderkey IS NULL THEN 'Offboarding'
                            WHEN lat.o_orderstatus = 'F' THEN 'On time' ELSE 'Not on time' END AS outcome
FROM jan LEFT JOIN lat ON jan.o_orderkey = lat.o_orderkey""")
def t_08_plan_vs_actual_snapshot(spark, sf):
    o = T(spark, sf).orders
    jan = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_orderstatus", F.lit("1998-01-01").cast("date").alias("snapshot_date"))
    lat = o.where((F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz"))
                  & (F.col("o_orderpriority") != "5-LOW")).select(
        "o_orderkey", F.when(F.col("o_totalprice") > 150000, "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.lit("1998-07-01").cast("date").alias("snapshot_date"))
    hist = jan.unionByName(lat)
    return W.plan_vs_actual(hist, "o_orderkey", "snapshot_date", D(1998, 1, 1), D(1998, 7, 1), "o_orderstatus", "F")


@register("t_09_nearest_snapshot_value", f"""
SELECT o_custkey, o_orderkey, CAST(DATE '{AS_OF}' - CAST(o_orderdate AS DATE) AS INTEGER) AS days_diff FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY DATE '{AS_OF}' - CAST(o_orderdate AS DATE) DESC, o_orderkey) = 1""")
def t_09_nearest_snapshot_value(spark, sf):
    o = T(spark, sf).orders
    return W.nearest_snapshot_value(o, ["o_custkey"], "o_orderdate", D.fromisoformat(AS_OF), "o_orderkey",
                                    "o_orderkey")


@register("t_10_stage_milestones", """
WITH f AS (SELECT user_id, min(CASE WHEN event_type = 'purchase' THEN ts END) AS first_purchase
           FROM events GROUP BY user_id),
v AS (SELECT e.user_id, e.ts, e.event_id FROM events e JOIN f ON e.user_id = f.user_id
      WHERE e.event_type = 'view' AND (f.first_purchase IS NULL OR e.ts < f.first_purchase))
SELECT f.user_id, f.first_purchase, min(v.ts) AS first_view, max(v.ts) AS last_view,
       arg_max(v.event_id, v.ts) AS last_view_event_id
FROM f LEFT JOIN v ON f.user_id = v.user_id GROUP BY f.user_id, f.first_purchase""")
def t_10_stage_milestones(spark, sf):
    e = T(spark, sf).events
    return W.stage_milestones(e, ["user_id"], "event_type", "ts", "event_id", "view", "purchase")


@register("t_11_utc_to_local", """
SELECT event_id,
  strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Amsterdam', '%Y-%m-%d %H:%M:%S') AS local_text,
  CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Amsterdam' AS DATE) AS local_date
FROM events""")
def t_11_utc_to_local(spark, sf):
    e = T(spark, sf).events
    txt, day = W.utc_to_local("ts", "Europe/Amsterdam")
    return e.select("event_id", txt.alias("local_text"), day.alias("local_date"))


# ---------------------------------------------------------------------- money

CURRENCY_SQL = ("CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 'CHF' WHEN l_returnflag = 'A' THEN 'EUR' "
                "WHEN l_returnflag = 'N' THEN 'USD' ELSE 'GBP' END")
#: The month of a line, and the average rate per currency and month: price per piece of the first line of an order.
#: No rate is quoted in the last month of a quarter, where the month before counts.
MONTH_SQL = "CAST(date_trunc('month', l_shipdate) AS DATE)"
RATES_SQL = f"""rates AS (
  SELECT {CURRENCY_SQL} AS currency, {MONTH_SQL} AS month,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
         / (CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) * 100000) AS rate
  FROM lineitem WHERE l_linenumber = 1 AND month(l_shipdate) % 3 <> 0 GROUP BY 1, 2)"""
BASE_SQL = "CASE WHEN y.currency = 'EUR' THEN l_extendedprice ELSE l_extendedprice / nullif(r.rate, 0) END"


def _currency():
    return (F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "R"), "CHF")
            .when(F.col("l_returnflag") == "A", "EUR").when(F.col("l_returnflag") == "N", "USD").otherwise("GBP"))


def _month(c):
    return F.trunc(F.to_date(c), "month")


def _rates(t):
    """Average rates per currency and month, derived from the lines, with gaps filled by the last earlier month."""
    quoted = t.lineitem.where((F.col("l_linenumber") == 1) & (F.month("l_shipdate") % 3 != 0))
    cents, pieces = F.round(F.col("l_extendedprice") * 100).cast("bigint"), F.col("l_quantity").cast("bigint")
    rate = F.sum(cents).cast("double") / (F.sum(pieces).cast("double") * 100000)
    rates = quoted.groupBy(_currency().alias("currency"), _month("l_shipdate").alias("month")).agg(rate.alias("rate"))
    return M.period_dimension(rates, "currency", "month", t.lineitem.agg(F.max(_month("l_shipdate"))).scalar())


@register("m_01_to_base_currency", f"""
WITH {RATES_SQL},
y AS (SELECT l_orderkey, l_linenumber, l_extendedprice, {MONTH_SQL} AS month, {CURRENCY_SQL} AS currency FROM lineitem)
SELECT y.l_orderkey, y.l_linenumber, y.month, y.currency, CAST({BASE_SQL} AS DECIMAL(20, 2)) AS amount_base
FROM y ASOF LEFT JOIN rates r ON y.currency = r.currency AND y.month >= r.month""")
def m_01_to_base_currency(spark, sf):
    t = T(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", _month("l_shipdate").alias("month"),
                           _currency().alias("currency"))
    return M.to_base_currency(li, _rates(t), "l_extendedprice", "currency", "EUR", keys=["month"]).drop("l_extendedprice")


@register("m_02_limit_breach", """
WITH u AS (SELECT o_custkey, round(sum(o_totalprice) / 100, 2) AS utilisation FROM orders
           WHERE o_orderstatus = 'O' GROUP BY o_custkey),
x AS (SELECT c_custkey,
             CAST(CASE WHEN c_acctbal < 0 THEN 0.0 ELSE round(c_acctbal, 0) END AS DECIMAL(20, 2)) AS effective,
             CAST(coalesce(u.utilisation, 0.0) AS DECIMAL(20, 2)) AS utilisation,
             CAST(1000 AS DECIMAL(20, 2)) AS intraday
      FROM customer LEFT JOIN u ON o_custkey = c_custkey),
y AS (SELECT *, CASE WHEN c_custkey % 5 = 0 THEN effective ELSE CAST(0 AS DECIMAL(20, 2)) END AS unavailable FROM x),
z AS (SELECT *, CAST(effective - unavailable - utilisation AS DECIMAL(20, 2)) AS available FROM y)
SELECT c_custkey, effective, unavailable, utilisation, available,
  effective - unavailable <> 0 AND effective - unavailable - utilisation < 0 AS effective_breach,
  effective - unavailable = 0 AND intraday - utilisation < 0 AS intraday_breach,
  available < 0 AS available_breach,
  CAST(CASE WHEN effective = 0 THEN available + intraday ELSE available END AS DECIMAL(20, 2)) AS new_available
FROM z""")
def m_02_limit_breach(spark, sf):
    t = T(spark, sf)
    u = t.orders.where(F.col("o_orderstatus") == "O").groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice") / 100, 2).alias("utilisation"))
    money = "decimal(20,2)"
    effective = F.when(F.col("c_acctbal") < 0, F.lit(0.0)).otherwise(F.round("c_acctbal", 0)).cast(money)
    x = t.customer.join(u, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey", effective.alias("effective"),
        F.when(F.col("c_custkey") % 5 == 0, effective).otherwise(F.lit(0)).cast(money).alias("unavailable"),
        F.coalesce("utilisation", F.lit(0.0)).cast(money).alias("utilisation"))
    x = x.withColumn("available", F.expr("effective - unavailable - utilisation").cast(money))
    return x.withColumns(M.limit_breach(F.col("effective"), F.col("unavailable"), F.col("utilisation"), F.lit(1000),
                                        F.col("available")))


#: name -> (Spark SQL and DuckDB alike) high risk of a country in a month, from its orders there:
#: n orders, f finished ones, cents of all
RISKS = {"sanction_risk": "n % 5 = 0", "ml_risk": "2 * f > n", "tf_risk": "f % 3 = 0", "tax_risk": "cents % 7 < 3",
         "corruption_risk": "n % 2 = 0"}


@register("m_03_transaction_rollup", f"""
WITH {RATES_SQL},
ocn AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, c_nationkey, c_mktsegment, n_name
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
k AS (SELECT upper(substring(n_name, 1, 2)) AS country, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n,
             count(*) FILTER (o_orderstatus = 'F') AS f, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
      FROM ocn WHERE month(o_orderdate) % 4 <> 0 GROUP BY 1, 2),
li AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_returnflag, l_linestatus, l_shipdate
       FROM lineitem),
tx AS (SELECT *, {CURRENCY_SQL} AS currency, {MONTH_SQL} AS month,
         CASE WHEN l_quantity > 40 THEN 'batch' ELSE 'single' END AS batch_kind,
         CASE WHEN l_linestatus = 'O' THEN 'C' ELSE 'D' END AS credit_debit,
         'N' || CAST(c_nationkey AS VARCHAR) AS holder_country,
         CASE WHEN l_returnflag = 'A' THEN upper(substring(n_name, 1, 2)) || '00BANK' END AS iban,
         CASE WHEN l_linestatus = 'O' THEN 'BANK' || upper(substring(n_name, 8, 2)) || 'XX' END AS bic
       FROM li JOIN ocn ON l_orderkey = o_orderkey),
y AS (SELECT *, coalesce(CASE WHEN regexp_matches(iban, '^[A-Z]{{2}}[0-9]{{2}}') THEN substring(iban, 1, 2) END,
                         CASE WHEN length(bic) >= 6 THEN substring(bic, 5, 2) END, holder_country) AS country FROM tx)
SELECT batch_kind, c_mktsegment AS client_group, y.month, credit_debit, holder_country, y.country,
  {', '.join(f"CASE WHEN k.n IS NULL THEN NULL WHEN {sql} THEN 'High' ELSE 'Low' END AS {name}" for name, sql in RISKS.items())},
  y.currency, count(*) AS n_tx, sum(l_quantity) AS quantity,
  CAST(sum(CAST({BASE_SQL} AS DECIMAL(20, 2))) AS DECIMAL(38, 2)) AS amount_base
FROM y ASOF LEFT JOIN rates r ON y.currency = r.currency AND y.month >= r.month
ASOF LEFT JOIN k ON y.country = k.country AND y.month >= k.month
GROUP BY ALL""")
def m_03_transaction_rollup(spark, sf):
    t = T(spark, sf)
    # order, customer and nation follow from l_orderkey: the lines alone are made distinct, and the shuffle
    # by l_orderkey serves both that and the join
    li = (t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_returnflag",
                            "l_linestatus", "l_shipdate").repartition("l_orderkey").distinct())
    ocn = (t.orders.join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
           .join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
           .select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "c_nationkey", "c_mktsegment", "n_name"))
    iban = F.when(F.col("l_returnflag") == "A", F.concat(F.upper(F.substring("n_name", 1, 2)), F.lit("00BANK")))
    bic = F.when(F.col("l_linestatus") == "O", F.concat(F.lit("BANK"), F.upper(F.substring("n_name", 8, 2)), F.lit("XX")))
    holder = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    y = li.join(ocn.select("o_orderkey", "c_nationkey", "c_mktsegment", "n_name"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("l_quantity") > 40, "batch").otherwise("single").alias("batch_kind"),
        F.col("c_mktsegment").alias("client_group"), _month("l_shipdate").alias("month"),
        F.when(F.col("l_linestatus") == "O", "C").otherwise("D").alias("credit_debit"), holder.alias("holder_country"),
        M.counterparty_country(iban, bic, holder).alias("country"), _currency().alias("currency"), "l_quantity", "l_extendedprice")
    months = ocn.where(F.month("o_orderdate") % 4 != 0).groupBy(
        F.upper(F.substring("n_name", 1, 2)).alias("country"), _month("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    listed = months.select("country", "month", *[F.when(F.expr(sql), "High").otherwise("Low").alias(name)
                                                  for name, sql in RISKS.items()])
    risks = M.period_dimension(listed, "country", "month", t.lineitem.agg(F.max(_month("l_shipdate"))).scalar())
    y = M.to_base_currency(y.join(risks, ["country", "month"], "left"), _rates(t), "l_extendedprice", "currency", "EUR", keys=["month"])
    return y.groupBy("batch_kind", "client_group", "month", "credit_debit", "holder_country", "country", *RISKS, "currency").agg(
        F.count(F.lit(1)).alias("n_tx"), F.sum("l_quantity").alias("quantity"),
        F.sum("amount_base").cast("decimal(38,2)").alias("amount_base"))


@register("m_04_in_out_counts", """
WITH i AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1),
o AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1)
SELECT n_nationkey, n_name, CAST(coalesce(i.n, 0) AS BIGINT) AS n_in, CAST(coalesce(o.n, 0) AS BIGINT) AS n_out,
       CAST(coalesce(i.n, 0) + coalesce(o.n, 0) AS BIGINT) AS n_total
FROM nation LEFT JOIN i ON i.k = n_nationkey LEFT JOIN o ON o.k = n_nationkey""")
def m_04_in_out_counts(spark, sf):
    t = T(spark, sf)
    return M.in_out_counts(t.nation.select("n_nationkey", "n_name"),
                           t.customer.select(F.col("c_nationkey").alias("n_nationkey")),
                           t.supplier.select(F.col("s_nationkey").alias("n_nationkey")), "n_nationkey")
