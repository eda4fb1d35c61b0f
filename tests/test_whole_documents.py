"""D-01 keeps every client, order and line, also beyond 2,000,000 JSON characters."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import dossier.operators.ordered as ordered_mod
from dossier.operators.documents import nest_siblings


@pytest.fixture(scope="module")
def hot_dir(spark, small_dir, tmp_path_factory):
    """The small tables, with one client whose document has over 2,000,000 characters, a third of it in one order."""
    d = tmp_path_factory.mktemp("hot")
    for t in ("customer", "orders", "lineitem"):
        df = spark.read.parquet(f"{small_dir}/{t}.parquet")
        if t == "orders":
            df = df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).cast(df.schema["o_custkey"].dataType))
        if t == "lineitem":
            more = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(25)))).where("l_orderkey % 3 = 0")
            least = df.where("l_orderkey % 3 = 0").agg(F.min("l_orderkey")).collect()[0][0]
            more = more.withColumn("l_linenumber", (F.col("l_linenumber") + 10 * F.col("copy")).cast(df.schema["l_linenumber"].dataType))
            one = more.withColumn("l_orderkey", F.lit(least).cast(df.schema["l_orderkey"].dataType))
            df = df.unionByName(more.drop("copy")).unionByName(one.drop("copy"))
        df.write.parquet(f"{d}/{t}.parquet")
    for t in ("nation", "region", "part", "supplier"):
        spark.read.parquet(f"{small_dir}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    return str(d)


def test_hot_client_is_whole(spark, hot_dir):
    q = E.queries()
    n_customers, n_orders, n_lines = (spark.read.parquet(f"{hot_dir}/{t}.parquet").count() for t in ("customer", "orders", "lineitem"))
    counts = q["d_01_document_counts"](spark, hot_dir)
    assert counts.agg(F.count("*"), F.sum("n_orders"), F.sum("n_lines")).collect()[0][:] == (n_customers, n_orders, n_lines)
    docs = q["d_01_build_documents"](spark, hot_dir).cache()
    assert docs.select("c_custkey").distinct().count() == n_customers
    flat = docs.select("c_custkey", "part", F.explode("orders").alias("o"))
    assert flat.select("o.o_orderkey").distinct().count() == n_orders
    got = flat.select("o.o_orderkey", F.explode("o.lines").alias("l")).select("o_orderkey", "l.*")
    want = spark.read.parquet(f"{hot_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    assert got.count() == n_lines and got.exceptAll(want).isEmpty()
    parts = [r["part"] for r in docs.where("c_custkey = 1").orderBy("part").collect()]
    assert len(parts) > 2 and parts == list(range(1, len(parts) + 1))
    assert docs.agg(F.max(F.length(F.to_json("orders")))).collect()[0][0] <= 2_000_000
    assert q["d_01_document_length_check"](spark, hot_dir).isEmpty()
    for name, field in (("addresses", "a"), ("activities", "a"), ("parties", "a"), ("relationships", "a")):
        each = docs.select("c_custkey", F.explode(name).alias(field))  # distinct over all parts
        assert each.count() == each.distinct().count()
    assert docs.where("c_custkey = 1").select(F.explode("parties")).count() == spark.read.parquet(f"{hot_dir}/supplier.parquet").count()


@pytest.mark.parametrize("chunks", [None, 64])  # 64: the scan splits the client
@pytest.mark.parametrize("chars", [1, 150, 10_000])
def test_parts_have_every_row_once(spark, chars, chunks, monkeypatch):
    monkeypatch.setattr(ordered_mod, "CHUNKS", chunks)
    parent = [(1, "x"), (2, "y"), (3, "z")]
    orders = [(1, o) for o in range(10, 30)] + [(1, 10), (2, 50), (None, 60), (9, 61), (1, None)]
    lines = [(10, "a" * k) for k in range(40)] + [(10, "a")] * 5 + [(11, None), (50, "b"), (60, "c"), (None, "d")]
    tags = [(1, t % 9) for t in range(30)] + [(2, None), (9, 1)]
    mid, sub = spark.createDataFrame(orders, "c int, o int"), spark.createDataFrame(lines, "o int, t string")
    chain = mid.join(sub.withColumn("k", F.lit(1)), "o", "left").select("c", F.lit("orders").alias("kind"), "o", "t", "k")
    rows = (spark.createDataFrame(parent, "c int, name string").withColumn("kind", F.lit(""))
            .unionByName(chain, allowMissingColumns=True)
            .unionByName(spark.createDataFrame(tags, "c int, tag int").withColumn("kind", F.lit("tags")), allowMissingColumns=True))
    docs = nest_siblings(rows, "c", ["name"], {"tags": ["tag"]}, ("orders", ["o"], "lines", ["t", "k"]), chars)
    rows = docs.collect()
    got = Counter((r["c"], r["name"], o["o"], x["t"]) for r in rows for o in r["orders"] for x in o["lines"])
    want = Counter((c, n, o, t) for c, n in parent for d, o in orders if d == c
                   for p, t in lines if p == o and o is not None)
    assert got == want
    assert {(r["c"], o["o"]) for r in rows for o in r["orders"]} == {(c, o) for c, o in orders if c in (1, 2)}
    assert sorted((r["c"], x["tag"]) for r in rows for x in r["tags"] if r["c"] == 1) == [(1, t) for t in range(9)]
    assert [x["tag"] for r in rows if r["c"] == 2 for x in r["tags"]] == [None] and {r["c"] for r in rows} == {1, 2, 3}
    for c in (1, 2, 3):
        parts = sorted(r["part"] for r in rows if r["c"] == c)
        assert parts == list(range(1, len(parts) + 1)) and (len(parts) == 1 or chars < 10_000)
    real = docs.select("json_length", F.length(F.to_json(F.struct("c", "tags", "orders"))).alias("n")).collect()
    assert all(r["json_length"] == r["n"] for r in real) and max(r["n"] for r in real) < 2 * max(chars, 150) + 100


def test_documents_read_each_table_once(spark, small_dir):
    """One scan per table in the documents' own plan; the only others choose the ordered scan's borders and carries."""
    docs = E.queries()["d_01_build_documents"](spark, small_dir)
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    # the ordered scan has a main branch and a carry branch, each with the choice of borders
    assert plan.count("Relation [l_orderkey") == plan.count("Relation [o_orderkey") == plan.count("Relation [c_custkey") <= 4


@pytest.mark.parametrize("chunks", [None, 64])  # 64: the scan splits both clients
def test_packed_rows_give_the_same_documents(spark, chunks, monkeypatch):
    monkeypatch.setattr(ordered_mod, "CHUNKS", chunks)
    lines = spark.range(400).selectExpr("CAST(1 + id % 2 AS INT) AS c", "CAST(id DIV 8 AS INT) AS o", "concat('t', id % 7) AS t",
                                        "CAST(id % 5 AS INT) AS tag", "CAST(NULL AS STRING) AS name", "false AS own")
    packed = lines.unionByName(spark.createDataFrame([(1, "x", True), (2, "y", True)], "c int, name string, own boolean"), allowMissingColumns=True)
    unpack = F.expr("""CASE WHEN own THEN array(named_struct('kind', '', 'name', name, 'tag', CAST(NULL AS INT), 'o', CAST(NULL AS INT), 't', CAST(NULL AS STRING)))
        ELSE array(named_struct('kind', 'orders', 'name', CAST(NULL AS STRING), 'tag', CAST(NULL AS INT), 'o', o, 't', t),
                   named_struct('kind', 'tags', 'name', CAST(NULL AS STRING), 'tag', tag, 'o', CAST(NULL AS INT), 't', CAST(NULL AS STRING))) END""")
    args = "c", ["name"], {"tags": ["tag"]}, ("orders", ["o"], "lines", ["t"]), 300
    one = nest_siblings(packed, *args, unpack=unpack, tasks=3)
    many = nest_siblings(packed.select("c", F.inline(unpack)), *args)
    assert one.count() > 4 and one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    # the structs of a row are made behind the shuffle: no exchange by all fields
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(c" in plan and ", kind" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def test_tasks_follow_the_files(spark, small_dir):
    from dossier.sources.tables import Tables
    t = Tables(spark, small_dir)
    assert t.tasks("lineitem", 2) == 4 and t.tasks("lineitem", 0.01) >= 11  # 4 shuffle partitions, 116 kB
