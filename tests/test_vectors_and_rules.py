"""X-07's vector index, E-01/E-02 by bitmaps, rule options of Q-06..Q-08, rejected documents of D-02."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dossier.operators import documents as DOC
from dossier.operators import entitlement as ENT
from dossier.operators import quality as DQ


def _frames(spark, n=600, n_queries=40, seed=7):
    """Vectors in 12 clusters, with a repeated one and unusable ones, and queries near them."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8)) * 50
    v = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, 8))
    v[1] = v[0]
    q = centres[rng.integers(0, 12, n_queries)] + rng.normal(size=(n_queries, 8))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(9001, None), (9002, [math.nan] * 8), (9003, [math.inf] * 8), (9004, [None] * 8)]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)] + [(99, None)], "q long, qv array<double>")
    return v, q, vectors, queries


@pytest.mark.parametrize("k", [1, 5, 700])
def test_nearest_vectors_equal_brute_force(spark, k):
    v, q, vectors, queries = _frames(spark)
    found = DOC.vector_top_k(vectors, "vec_id", "embedding", queries, "q", "qv", k).collect()
    want = set()
    for i, x in enumerate(q):
        d = np.sqrt(((v - x) ** 2).sum(axis=1))
        want |= {(i, int(j), r + 1) for r, j in enumerate(sorted(range(len(v)), key=lambda j: (d[j], j))[:k])}
    assert {(r["q"], r["vec_id"], r["rank"]) for r in found} == want and len(found) == len(want)
    for r in found[:20]:
        a, b = v[r["vec_id"]], q[r["q"]]
        assert r["l2_distance"] == pytest.approx(np.linalg.norm(a - b))
        assert r["cosine_similarity"] == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b))


def test_bound_rules_pairs_out_and_slices_lose_none(spark, monkeypatch):
    v, q, vectors, queries = _frames(spark)
    monkeypatch.setattr(DOC, "SLICE_ROWS", 7)
    monkeypatch.setattr(DOC, "PIVOTS", 16)  # for twelve clusters
    n = DOC.candidate_pairs(vectors, "vec_id", "embedding", queries, "q", "qv", 5).count()
    assert len(q) * 5 <= n < len(v) * len(q) / 3
    ranks = DOC.vector_top_k(vectors, "vec_id", "embedding", queries, "q", "qv", 5)
    for r in ranks.groupBy("q").agg(F.max("l2_distance").alias("d")).collect():
        assert r["d"] == pytest.approx(np.sort(np.sqrt(((v - q[r["q"]]) ** 2).sum(axis=1)))[4])


def test_equal_vectors_empty_tables_and_unequal_lengths(spark):
    same = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(50)], "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(1, [1.0, 1.0])], "q long, qv array<double>")
    got = DOC.vector_top_k(same, "vec_id", "embedding", q, "q", "qv", 3).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [0, 1, 2]
    assert DOC.vector_top_k(same.limit(0), "vec_id", "embedding", q, "q", "qv").count() == 0
    assert DOC.vector_top_k(same, "vec_id", "embedding", q.limit(0), "q", "qv").count() == 0
    with pytest.raises(Exception, match="unequal length"):
        DOC.vector_top_k(same, "vec_id", "embedding", spark.createDataFrame([(1, [1.0])], q.schema), "q", "qv").collect()


def test_bitmaps_name_the_clients_of_the_map(spark):
    users = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x"), ("b", "y"), ("c", None)], "upn string, attribute_value string")
    ids = [0, 1, 7, 8, 32767, 32768, 32769, 65536, 10 ** 12, -5]
    clients = spark.createDataFrame([(i, "xyz"[k % 3]) for k, i in enumerate(ids)] + [(1, "y"), (1, "y"), (None, "x"), (3, None)],
                                    "client_id long, attribute_value string")
    pairs = ENT.entitlement_map(users, clients).where("client_id IS NOT NULL")
    maps = ENT.entitlement_bitmaps(users, clients)
    counts = {r["upn"]: r["n_clients"] for r in ENT.entitled_counts(maps).collect()}
    assert counts == {r["upn"]: r["count"] for r in pairs.groupBy("upn").count().collect()}
    rows = spark.createDataFrame([(i, n) for i in [*ids, 2, 3, None] for n in range(2)], "k long, n int")
    for user in "abc":
        assert sorted(map(tuple, ENT.bitmap_row_filter(rows, "k", maps, user).collect())) == \
            sorted(map(tuple, ENT.row_filter(rows, "k", pairs, user).collect()))


def test_rule_options(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, "a"), (3, None, "b"), (3, None, "a"), (None, None, "a")], "id int, v int, g string")
    r = {x["column_name"]: x for x in DQ.dq_not_null(df, ["v", "g"], where=F.col("g") == "a", example_key="id", n_examples=1).collect()}
    assert (r["v"]["n_null"], r["v"]["status"], r["v"]["examples"]) == (3, "Fail", "1")
    assert (r["g"]["n_null"], r["g"]["status"], r["g"]["examples"]) == (0, "Pass", "")
    c = DQ.dq_condition(df, F.col("v") > 1, "r", where=F.col("g") == "a", example_key="id").collect()[0]
    assert (c["n_rows"], c["n_violations"], c["examples"]) == (4, 3, "1,3")
    known = spark.createDataFrame([(2,), (None,)], "k int")
    s = DQ.dq_referential_status(df, "id", known, "k", "r").collect()[0]
    assert (s["status"], s["n_missing_rows"], s["n_missing_keys"], s["examples"]) == ("Fail", 4, 3, "1,3")
    s = DQ.dq_referential_status(df, "id", known, "k", "r", ignore_null=True, where=F.col("id") == 2).collect()[0]
    assert (s["status"], s["n_missing_rows"], s["n_missing_keys"], s["examples"]) == ("Pass", 0, 0, "")
    e = DQ.dq_condition(df.limit(0), F.col("v") > 1, "r", example_key="id").collect()[0]
    assert (e["status"], e["n_rows"], e["examples"]) == ("Pass", 0, "")
