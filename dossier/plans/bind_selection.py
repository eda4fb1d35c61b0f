"""X-* sampling/text/vectors, D-* documents, E-* entitlements, N-02/N-03 bound to the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dossier.operators import documents as DOC
from dossier.operators import entitlement as ENT
from dossier.operators import sampling as SM
from dossier.plans.common import T
from dossier.plans.registry import register

# --------------------------------------------------------------- sampling

X01 = dict(strata=["o_orderpriority"], keys=["o_orderkey"], fraction=0.05, minimum=400, seed=42,
           dedup_keys=["o_custkey"])


def _x01(spark, sf):
    return SM.stratified_minimum_sample(T(spark, sf).orders, **X01)


X01_SIZES_SQL = """
SELECT o_orderpriority, count(*) AS n_population, count(DISTINCT o_custkey) AS n_dedup,
       CAST(least(count(DISTINCT o_custkey), greatest(ceil(count(*) * 0.05), 400)) AS BIGINT) AS n_sample
FROM orders GROUP BY o_orderpriority"""


@register("x_01_stratified_minimum_sample")
def x_01_stratified_minimum_sample(spark, sf):
    return _x01(spark, sf)[0]


@register("x_01_sample_sizes", X01_SIZES_SQL)
def x_01_sample_sizes(spark, sf):
    return _x01(spark, sf)[1]


@register("x_01_sample_counts", f"""
WITH s AS ({X01_SIZES_SQL}) SELECT o_orderpriority, n_sample AS n_rows FROM s""")
def x_01_sample_counts(spark, sf):
    sample = _x01(spark, sf)[0]
    # exactly n_sample rows per stratum, one per customer
    return sample.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("n_rows"))


@register("x_02_equal_split_balance")
def x_02_equal_split_balance(spark, sf):
    return SM.equal_split_balance(T(spark, sf).customer, "c_mktsegment", ["c_custkey"], 500)


@register("x_02_equal_split_total", """
WITH g AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1),
k AS (SELECT sum(least(n, ceil(500.0 / (SELECT count(*) FROM g)))) AS avail FROM g)
SELECT CAST(least(avail, 500) AS BIGINT) AS n_total FROM k""")
def x_02_equal_split_total(spark, sf):
    s = SM.equal_split_balance(T(spark, sf).customer, "c_mktsegment", ["c_custkey"], 500)
    return s.agg(F.count(F.lit(1)).alias("n_total"))


@register("x_03_sample_by_strata")
def x_03_sample_by_strata(spark, sf):
    return SM.sample_by_strata(T(spark, sf).orders, "o_orderstatus", {"F": 0.1, "O": 0.2, "P": 0.3}, seed=42)


@register("x_04_representative_sample")
def x_04_representative_sample(spark, sf):
    c = T(spark, sf).customer.select("c_custkey", "c_mktsegment", "c_nationkey",
                                     (F.col("c_acctbal") + 1000).alias("weight"),
                                     (F.col("c_acctbal") > 9900).alias("mandatory"))
    return SM.representative_sample(c, "c_custkey", "weight", "mandatory", ["c_mktsegment", "c_nationkey"],
                                    size=100)


@register("x_05_rule_tagging", """
SELECT o_orderkey, unnest(list_filter([
  CASE WHEN o_totalprice > 300000 THEN 'large' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END,
  CASE WHEN o_orderstatus = 'P' THEN 'pending' END,
  CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'old' END], lambda x: x IS NOT NULL)) AS rule
FROM orders""")
def x_05_rule_tagging(spark, sf):
    o = T(spark, sf).orders
    return SM.rule_tagging(o, ["o_orderkey"], {
        "large": F.col("o_totalprice") > 300000, "urgent": F.col("o_orderpriority") == "1-URGENT",
        "pending": F.col("o_orderstatus") == "P",
        "old": F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")})


@register("x_09_generate_test_data")
def x_09_generate_test_data(spark, sf):
    seeds = T(spark, sf).customer.select(F.col("c_custkey").alias("party_key"))
    return SM.generate_test_data(seeds, "party_key", {
        "party_type": {"values": ["Legal Entity", "Branch", "Sub Account", "Individual"]},
        "country": {"values": ["NL", "DE", "US", "AU", "NZ", "CL"], "null_pct": 10},
        "lifecycle": {"values": ["Active", "Prospect", "Closed"], "null_pct": 5},
        "party_id": {"expr": "concat('PTY', lpad(CAST(party_key AS STRING), 8, '0'))"},
    })


# ---------------------------------------------------------------- text / vectors

@register("x_06_chunk_text", """
SELECT doc_id, CAST(s // 400 AS INTEGER) AS chunk_no, CAST(s AS INTEGER) AS start,
       substring(text, s + 1, 500) AS chunk
FROM (SELECT doc_id, text, unnest(generate_series(0, length(text) - 1, 400)) AS s FROM documents
      WHERE length(text) > 0)""")
def x_06_chunk_text(spark, sf):
    d = T(spark, sf).documents
    c = d.select("doc_id", F.explode(DOC.chunk_text("text", 500, 100)).alias("c"))
    return c.select("doc_id", "c.chunk_no", "c.start", "c.chunk")


def _centroids(e):
    p = e.select("label", F.posexplode("embedding").alias("pos", "x"))
    g = p.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("v"))
    return g.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))),
                                              lambda s: s.getField("v")).alias("centroid"))


@register("x_07_vector_top_k", """
WITH p AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS x FROM embeddings),
c AS (SELECT label, list(v ORDER BY i) AS centroid FROM (SELECT label, i, avg(CAST(x AS DOUBLE)) AS v FROM p
      GROUP BY label, i) GROUP BY label),
d AS (SELECT c.label, e.vec_id,
        list_sum(list_transform(range(1, len(e.embedding) + 1),
                                lambda i: (CAST(e.embedding[i] AS DOUBLE) - c.centroid[i]) ^ 2)) AS d2
      FROM embeddings e, c)
SELECT label, vec_id, CAST(row_number() OVER (PARTITION BY label ORDER BY d2, vec_id) AS INTEGER) AS rank FROM d
QUALIFY rank <= 5""")
def x_07_vector_top_k(spark, sf):
    e = T(spark, sf).embeddings
    q = _centroids(e)
    r = DOC.vector_top_k(e, "vec_id", "embedding", q, "label", "centroid", k=5)
    return r.select("label", "vec_id", "rank")


@register("x_08_entity_edges", """
SELECT DISTINCT source, unnest(regexp_extract_all(text, '[A-Z][a-z]+')) AS entity FROM documents""")
def x_08_entity_edges(spark, sf):
    return DOC.entity_edges(T(spark, sf).documents, "source", "text")


# ---------------------------------------------------------------- documents

SETS = {"addresses": ["address_type", "country", "region"], "activities": ["activity"],
        "parties": ["party_id", "party_name"], "relationships": ["relation", "related_id"]}
CHAIN = ("orders", ["o_orderkey", "o_orderstatus", "o_orderdate"], "lines", ["l_linenumber", "l_partkey", "l_quantity"])


def _documents(spark, sf):
    """Every client with its addresses, activities, parties, relationships, and orders with their lines.

    A client's own row and the rows of its lines are stacked into one frame with one scan per table, and
    unpacked into their kinds in their client's task.  A client is registered in
    its own country and operates in those of its suppliers; its activities are the types of the parts
    it orders; its parties are its suppliers, related by supply or return.
    """
    t = T(spark, sf)
    chain = [*CHAIN[1], *CHAIN[3]]
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus",
                        F.to_date("o_orderdate").alias("o_orderdate"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    facts = (o.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
             .join(t.part.select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey"), "left")
             .join(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), F.col("s_suppkey") == F.col("l_suppkey"), "left"))
    own = {"c_name": "string", "address_type": "string", "country": "string", "region": "string", "activity": "string",
           "party_id": "bigint", "party_name": "string", "relation": "string", "related_id": "bigint", "o_orderkey": "bigint",
           "o_orderstatus": "string", "o_orderdate": "date", "l_linenumber": "int", "l_partkey": "bigint", "l_quantity": "double"}

    def row(kind: str, **values) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), *[
            (values[c] if c in values else F.lit(None)).cast(kind_of).alias(c) for c, kind_of in own.items()])

    def address(kind: str) -> F.Column:
        return row("addresses", address_type=F.lit(kind), country=F.col("country"), region=F.col("region"))

    relation = F.when(F.col("returned"), "Returns to").otherwise("Supplied by")
    registered, supplied = F.col("nationkey").isNotNull(), F.col("s_suppkey").isNotNull()
    child = F.array_compact(F.array(
        row("orders", **{c: F.col(c) for c in chain}),
        # an order without lines has no supplier and no part
        F.when(F.col("p_type").isNotNull(), row("activities", activity=F.col("p_type"))),
        F.when(supplied, row("parties", party_id=F.col("s_suppkey"), party_name=F.col("s_name"))),
        F.when(supplied, row("relationships", relation=relation, related_id=F.col("s_suppkey"))),
        F.when(registered, address("Operating"))))
    client = F.array_compact(F.array(row("", c_name=F.col("c_name")), F.when(registered, address("Registered"))))
    unpack = F.when(F.col("is_client"), client).otherwise(child)
    places = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
              .select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("country"), F.col("r_name").alias("region")))
    stacked = (facts.select("c_custkey", *chain, "p_type", "s_suppkey", "s_name", (F.col("l_returnflag") == "R").alias("returned"),
                            F.col("s_nationkey").alias("nationkey"), F.lit(False).alias("is_client"))
               .unionByName(t.customer.select("c_custkey", "c_name", F.col("c_nationkey").alias("nationkey"),
                                              F.lit(True).alias("is_client")), allowMissingColumns=True)
               .join(places, "nationkey", "left"))
    return DOC.nest_siblings(stacked, "c_custkey", ["c_name"], SETS, CHAIN, unpack=unpack, tasks=t.tasks("lineitem", 2))


@register("d_01_build_documents")
def d_01_build_documents(spark, sf):
    """Every client with its arrays, whole; a long document is several rows (parts)."""
    return _documents(spark, sf)


@register("d_01_document_json", """
WITH li AS (SELECT o_custkey AS c, o_orderkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
                   l_linenumber, l_partkey, l_quantity, p_type, s_suppkey, s_name, s_nationkey, l_returnflag
            FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey
            LEFT JOIN supplier ON s_suppkey = l_suppkey),
ad AS (SELECT c_custkey AS c, 'Registered' AS address_type, c_nationkey AS nk FROM customer
       UNION SELECT c, 'Operating', s_nationkey FROM li WHERE s_suppkey IS NOT NULL),
addresses AS (SELECT c, list({address_type: address_type, country: n_name, region: r_name}
                             ORDER BY address_type, n_name, r_name) AS x
              FROM ad JOIN nation ON n_nationkey = nk JOIN region ON r_regionkey = n_regionkey GROUP BY c),
activities AS (SELECT c, list({activity: p_type} ORDER BY p_type) AS x
               FROM (SELECT DISTINCT c, p_type FROM li WHERE p_type IS NOT NULL) GROUP BY c),
parties AS (SELECT c, list({party_id: s_suppkey, party_name: s_name} ORDER BY s_suppkey, s_name) AS x
            FROM (SELECT DISTINCT c, s_suppkey, s_name FROM li WHERE s_suppkey IS NOT NULL) GROUP BY c),
relationships AS (SELECT c, list({relation: relation, related_id: s_suppkey} ORDER BY relation, s_suppkey) AS x
  FROM (SELECT DISTINCT c, CASE WHEN l_returnflag = 'R' THEN 'Returns to' ELSE 'Supplied by' END AS relation, s_suppkey
        FROM li WHERE s_suppkey IS NOT NULL) GROUP BY c),
o AS (SELECT c, o_orderkey, o_orderstatus, o_orderdate,
        list({l_linenumber: l_linenumber, l_partkey: l_partkey, l_quantity: l_quantity}
             ORDER BY l_linenumber, l_partkey, l_quantity) FILTER (l_linenumber IS NOT NULL) AS lines FROM li GROUP BY ALL),
orders_ AS (SELECT c, list({o_orderkey: o_orderkey, o_orderstatus: o_orderstatus, o_orderdate: o_orderdate,
                            lines: coalesce(lines, [])} ORDER BY o_orderkey, o_orderstatus, o_orderdate) AS x FROM o GROUP BY c),
d AS (SELECT c_custkey, CAST(1 AS BIGINT) AS part, CAST(to_json({c_custkey: c_custkey, addresses: coalesce(a.x, []),
        activities: coalesce(b.x, []), parties: coalesce(p.x, []), relationships: coalesce(r.x, []),
        orders: coalesce(q.x, [])}) AS VARCHAR) AS document
      FROM customer LEFT JOIN addresses a ON a.c = c_custkey LEFT JOIN activities b ON b.c = c_custkey
      LEFT JOIN parties p ON p.c = c_custkey LEFT JOIN relationships r ON r.c = c_custkey LEFT JOIN orders_ q ON q.c = c_custkey)
SELECT *, CAST(length(document) AS BIGINT) AS json_length FROM d""")
def d_01_document_json(spark, sf):
    """The documents as JSON text, with the length predicted before anything was collected."""
    d = _documents(spark, sf)
    return d.select("c_custkey", "part", F.to_json(F.struct("c_custkey", *SETS, CHAIN[0])).alias("document"), "json_length")


@register("d_01_document_counts", """
WITH l AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT c_custkey, count(o_orderkey) AS n_orders, CAST(coalesce(sum(l.n), 0) AS INTEGER) AS n_lines
FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN l ON l.l_orderkey = o_orderkey
GROUP BY c_custkey""")
def d_01_document_counts(spark, sf):
    t = T(spark, sf)
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    per = (t.orders.select("o_custkey", "o_orderkey").join(lines, "o_orderkey", "left")
           .groupBy(F.col("o_custkey").alias("c_custkey"))
           .agg(F.count("o_orderkey").alias("n_orders"), F.sum("n").alias("n_lines")))
    return t.customer.select("c_custkey").join(per, "c_custkey", "left").select(
        "c_custkey", F.coalesce("n_orders", F.lit(0).cast("bigint")).alias("n_orders"),
        F.coalesce("n_lines", F.lit(0)).cast("int").alias("n_lines"))


@register("d_01_document_length_check", """
SELECT CAST(NULL AS BIGINT) AS c_custkey, CAST(NULL AS BIGINT) AS part, CAST(NULL AS INTEGER) AS real_length,
       CAST(NULL AS BIGINT) AS json_length FROM customer WHERE FALSE""")
def d_01_document_length_check(spark, sf):
    """Predicted JSON length (computed before collecting) against the real one, for every part of
    every client: must be equal."""
    real = F.length(F.to_json(F.struct("c_custkey", *SETS, CHAIN[0])))
    return (_documents(spark, sf).select("c_custkey", "part", real.alias("real_length"), "json_length")
            .where(~F.col("json_length").eqNullSafe(F.col("real_length"))))


def _life_cycle_documents(t):
    """One document per (client, life-cycle), size-guarded before anything is collected; and the rejected ones."""
    life = (F.when(F.col("o_orderstatus") == "O", "Active").when(F.col("o_orderstatus") == "P", "Prospect")
            .otherwise("Closed"))
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), life.alias("lifecycle"), "o_orderkey",
                             F.to_date("o_orderdate").alias("o_orderdate")) \
        .withColumn("doc_key", F.concat_ws("|", F.col("c_custkey").cast("string"), "lifecycle"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity")
    parent = orders.select("doc_key", "c_custkey", "lifecycle").distinct()
    return DOC.build_documents_2(parent, "doc_key", orders, "o_orderkey", ["o_orderkey", "o_orderdate"],
                                 lines, ["l_linenumber", "l_partkey", "l_quantity"], "orders", "lines")


@register("d_02_document_size_guard")
def d_02_document_size_guard(spark, sf):
    per, _ = _life_cycle_documents(T(spark, sf))
    prio = F.when(F.col("lifecycle") == "Active", 0).when(F.col("lifecycle") == "Prospect", 1).otherwise(2)
    g = DOC.document_size_guard(per, "c_custkey", prio, ["c_custkey", "lifecycle", "orders"])
    return g.select("c_custkey", "lifecycle", "json_length")


@register("d_02_rejected_documents")
def d_02_rejected_documents(spark, sf):
    """Keys and JSON lengths of the documents that the size guard leaves out."""
    return _life_cycle_documents(T(spark, sf))[1]


# ---------------------------------------------------------------- entitlements

USERS_SQL = """
ua AS (SELECT lower(r_name) || '@bank.example' AS upn, 'Region' AS attribute_type, r_name AS attribute_value
       FROM region
       UNION ALL SELECT 'auditor@bank.example', 'Global', 'ALL'),
ca AS (SELECT c_custkey AS client_id, r_name AS attribute_value FROM customer
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
em AS (SELECT DISTINCT upn, client_id FROM ua JOIN ca ON ua.attribute_value = ca.attribute_value)"""


def _users(t):
    ua = t.region.select(F.concat(F.lower("r_name"), F.lit("@bank.example")).alias("upn"),
                         F.lit("Region").alias("attribute_type"), F.col("r_name").alias("attribute_value"))
    glob = t.spark.range(1).select(F.lit("auditor@bank.example").alias("upn"), F.lit("Global").alias("attribute_type"),
                                    F.lit("ALL").alias("attribute_value"))
    return ua.unionByName(glob)


def _client_regions(t):
    return (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("client_id"), F.col("r_name").alias("attribute_value")))


def _ent_map(t):
    return ENT.entitlement_map(_users(t), _client_regions(t), "upn", "client_id", "attribute_value")


@register("e_01_entitlement_map", f"WITH {USERS_SQL} SELECT * FROM em")
def e_01_entitlement_map(spark, sf):
    return _ent_map(T(spark, sf))


@register("e_01_entitled_counts", f"""
WITH {USERS_SQL} SELECT upn, count(*) AS n_clients FROM em GROUP BY upn""")
def e_01_entitled_counts(spark, sf):
    t = T(spark, sf)
    return ENT.entitled_counts(ENT.entitlement_bitmaps(_users(t), _client_regions(t)))


@register("e_02_bitmap_row_filter", f"""
WITH {USERS_SQL}
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT client_id FROM em WHERE upn = 'asia@bank.example')""")
def e_02_bitmap_row_filter(spark, sf):
    t = T(spark, sf)
    bitmaps = ENT.entitlement_bitmaps(_users(t), _client_regions(t))
    return ENT.bitmap_row_filter(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", bitmaps, "asia@bank.example")


@register("e_02_row_filter", f"""
WITH {USERS_SQL}
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT client_id FROM em WHERE upn = 'europe@bank.example')""")
def e_02_row_filter(spark, sf):
    t = T(spark, sf)
    return ENT.row_filter(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", _ent_map(t),
                          "europe@bank.example")


MASK_SQL = """
SELECT c_custkey, r_name AS region,
  CASE WHEN {shown} THEN CAST(DATE '1970-01-01' + CAST(c_custkey * 7 AS INTEGER) AS VARCHAR)
       ELSE '****-**-**' END AS dob
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _dob_frame(t):
    return (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", F.col("r_name").alias("region"),
                    F.date_add(F.lit("1970-01-01").cast("date"), (F.col("c_custkey") * 7).cast("int")).alias("dob")))


@register("e_03_column_mask", MASK_SQL.format(shown="r_name = 'ASIA'"))
def e_03_column_mask(spark, sf):
    t = T(spark, sf)
    return ENT.apply_column_mask(_dob_frame(t), "dob", "region", _users(t), "asia@bank.example")


@register("e_04_secure_view", MASK_SQL.format(shown="TRUE"))
def e_04_secure_view(spark, sf):
    t = T(spark, sf)
    name = f"customer_dob_secure_{uuid.uuid4().hex[:8]}"
    return ENT.secure_view(spark, _dob_frame(t), name, "dob", "region", _users(t), "auditor@bank.example",
                           keep=["c_custkey", "region"])


@register("n_02_sql_function_exists", f"""
WITH {USERS_SQL}
SELECT c_custkey, EXISTS (SELECT 1 FROM em WHERE em.client_id = c_custkey AND em.upn = 'europe@bank.example')
  AS visible
FROM customer""")
def n_02_sql_function_exists(spark, sf):
    t = T(spark, sf)
    view = f"ent_map_{uuid.uuid4().hex[:8]}"
    _ent_map(t).createOrReplaceTempView(view)
    fn = ENT.register_can_view(spark, view, f"can_view_{uuid.uuid4().hex[:8]}")
    return spark.sql(f"SELECT c_custkey, {fn}(c_custkey, 'europe@bank.example') AS visible FROM {{c}}",
                     c=t.customer)


@register("n_03_generators", """
SELECT p_partkey, CAST(generate_subscripts(string_split(p_name, ' '), 1) - 1 AS INTEGER) AS pos,
       unnest(string_split(p_name, ' ')) AS word
FROM part""")
def n_03_generators(spark, sf):
    p = T(spark, sf).part
    return p.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "word"))
