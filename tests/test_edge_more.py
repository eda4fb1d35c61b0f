"""More edge cases: snapshots, sinks, reshape, relational helpers."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dossier.operators import shape as SH
from dossier.operators.relational import blank_to_null, top_n_with_ties, union_by_name
from dossier.session import scratch_path
from dossier.sources import sinks as K
from dossier.sources import snapshots as S

D = dt.date


@pytest.fixture(scope="module")
def snap_root(spark):
    root = scratch_path(spark, "edge_snaps")
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    K.write_snapshot(base, root, "obj", "3", D(2024, 1, 1))
    K.write_snapshot(base.withColumn("v", F.lit("c")), root, "obj", "3", D(2024, 1, 10))
    K.write_snapshot(base, root, "obj", "11", D(2023, 6, 1))
    return root


def test_latest_version_is_numeric_max(spark, snap_root):
    df = S.scan_latest_snapshot(spark, snap_root, "obj")
    assert {r["load_date"] for r in df.collect()} == {D(2023, 6, 1)}  # version 11 > 3


def test_exact_snapshot_missing_raises(spark, snap_root):
    with pytest.raises(S.SnapshotError):
        S.scan_exact_snapshot(spark, snap_root, "obj", D(2024, 1, 5), version="3")
    ok = S.scan_exact_snapshot(spark, snap_root, "obj", D(2024, 1, 11), version="3", allow_previous_day=True)
    assert {r["v"] for r in ok.collect()} == {"c"}


def test_asof_staleness_limit(spark, snap_root):
    df = S.scan_asof_snapshot(spark, snap_root, "obj", D(2024, 1, 12), max_age_days=5, version="3")
    assert {r["load_date"] for r in df.collect()} == {D(2024, 1, 10)}
    with pytest.raises(S.SnapshotError):
        S.scan_asof_snapshot(spark, snap_root, "obj", D(2024, 3, 1), max_age_days=5, version="3")
    with pytest.raises(S.SnapshotError):
        S.scan_asof_snapshot(spark, snap_root, "obj", D(2023, 1, 1), version="3")


def test_snapshot_overwrite_is_idempotent(spark):
    root = scratch_path(spark, "edge_rewrite")
    df = spark.createDataFrame([(1,)], "k int")
    K.write_snapshot(df, root, "o", "1", D(2024, 1, 1))
    K.write_snapshot(df, root, "o", "1", D(2024, 1, 2))
    path, n = K.write_snapshot(df.union(df), root, "o", "1", D(2024, 1, 1))  # re-run of day 1
    out = spark.read.parquet(path)
    assert n == 2 and out.count() == 3  # day 1 replaced (2 rows), day 2 kept (1 row)


def test_resolve_version_rules():
    assert S.resolve_version(["1", "2", "10", "tmp"], "x") == "10"
    assert S.resolve_version(["1", "2"], "x", mapping={"x": "1"}) == "1"
    with pytest.raises(S.SnapshotError):
        S.resolve_version(["1"], "x", pinned="5")


def test_append_if_period_start(spark):
    h = spark.createDataFrame([(1, D(2024, 1, 1))], "k int, snapshot_date date")
    s = spark.createDataFrame([(9,)], "k int")
    assert K.append_if_period_start(h, s, D(2024, 1, 15)).count() == 1      # not a period start
    assert K.append_if_period_start(h, s, D(2024, 1, 1)).count() == 1       # already there
    assert K.append_if_period_start(h, s, D(2024, 2, 1)).count() == 2       # appended
    assert K.append_if_period_start(h, s, D(2024, 2, 1), period="quarter").count() == 1


def test_row_corrections_delete_wins(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    corr = spark.createDataFrame([(1, "update", "z"), (1, "delete", None), (2, "update", "y")],
                                 "k int, action string, v string")
    assert sorted(tuple(r) for r in K.row_corrections(df, ["k"], corr).collect()) == [(2, "y")]


def test_blank_to_null_and_union_by_name(spark):
    a = spark.createDataFrame([(" ", "NuLl", "x")], "a string, b string, c string")
    assert tuple(blank_to_null(a).collect()[0]) == (None, None, "x")
    b = spark.createDataFrame([(1,)], "z int")
    u = union_by_name(a, b)
    assert set(u.columns) == {"a", "b", "c", "z"} and u.count() == 2


def test_explode_outer_multi_keeps_empty(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x"]), (2, [], None)], "k int, p array<string>, q array<string>")
    out = sorted((r["k"], r["pp"], r["qq"]) for r in SH.explode_outer_multi(df, ["k"], {"p": "pp", "q": "qq"}).collect())
    assert out == [(1, "a", "x"), (1, "b", "x"), (2, None, None)]


def test_explode_aligned_by_position(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], ["a", "b", "c"])], "k int, x array<int>, y array<string>")
    out = [(r["xx"], r["yy"]) for r in SH.explode_aligned(df, ["k"], {"x": "xx", "y": "yy"}).collect()]
    assert sorted(out) == [(1, "a"), (2, "b"), (3, "c")]


def test_top_n_with_ties_global(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 4), (4, None)], "k int, v int")
    assert sorted(r["k"] for r in top_n_with_ties(df, [("v", False)], 1).collect()) == [1, 2]
    assert sorted(r["k"] for r in top_n_with_ties(df, [("v", False)], 3).collect()) == [1, 2, 3]
    assert sorted(r["k"] for r in top_n_with_ties(df, [("v", True)], 1).collect()) == [3]


def test_pivot_values_are_bounded(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("p"))
    with pytest.raises(ValueError):
        SH.pivot_values(df, "p", max_values=10)


def test_two_level_documents_guard_before_collect(spark):
    from dossier.operators.documents import build_documents_2
    parent = spark.createDataFrame([(1,), (2,), (3,)], "c int")
    mid = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "c int, o int")
    sub = spark.createDataFrame([(10, "a" * 50), (10, "b"), (11, "c"), (20, "d")], "o int, t string")
    docs, dropped = build_documents_2(parent, "c", mid, "o", ["o"], sub, ["t"], "orders", "lines", max_chars=60)
    real = {r["c"]: len(r["j"]) for r in docs.select("c", F.to_json(F.struct("c", "orders")).alias("j")).collect()}
    assert set(real) == {2, 3} and all(v <= 60 for v in real.values())
    d = {r["c"]: r["json_length"] for r in dropped.collect()}
    assert list(d) == [1] and d[1] > 60
    # the prediction equals the real length once the limit allows the document
    docs_all, _ = build_documents_2(parent, "c", mid, "o", ["o"], sub, ["t"], "orders", "lines")
    j = docs_all.where("c = 1").select(F.to_json(F.struct("c", "orders")).alias("j")).collect()[0]["j"]
    assert len(j) == d[1]


def test_representative_sample_exact_size_with_mandatory(spark):
    from dossier.operators.sampling import representative_sample
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 4).cast("string").alias("seg"),
                                 (F.col("id") % 7 + 1).cast("double").alias("w"), (F.col("id") < 5).alias("must"))
    out = representative_sample(df, "k", "w", "must", ["seg"], size=50, n_candidates=20)
    keys = [r["k"] for r in out.collect()]
    assert len(keys) == 50 and len(set(keys)) == 50 and set(range(5)) <= set(keys)
    again = [r["k"] for r in representative_sample(df, "k", "w", "must", ["seg"], size=50, n_candidates=20).collect()]
    assert sorted(keys) == sorted(again)  # seeded: the same sample every run


def test_theta_or_join_keeps_multiplicity(spark):
    from dossier.operators.relational import theta_or_join
    left = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "z")], "a int, b string")
    right = spark.createDataFrame([(1, "q"), (3, "y"), (None, "z")], "c int, d string")
    j = theta_or_join(left, right, [(F.col("a"), F.col("c")), (F.col("b"), F.col("d"))])
    got = sorted((tuple(r) for r in j.select("a", "b", "c", "d").collect()), key=str)
    want = sorted([(1, "x", 1, "q"), (1, "x", 1, "q"), (2, "y", 3, "y"), (None, "z", None, "z")], key=str)
    assert got == want


def test_representative_sample_draws_are_those_of_all_rows(spark):
    """The bound leaves every candidate's own draws, also where weights tie rows; few rows are sorted."""
    import math
    from dossier.operators.sampling import representative_sample
    df = spark.range(4000).select((F.col("id") % 3990).alias("k"), (F.col("id") % 4 * 100.0).alias("w"), (F.col("id") % 900 == 5).alias("must"),
                                  (F.col("id") % 3).cast("string").alias("seg"))
    got = representative_sample(df, "k", "w", "must", ["seg"], size=20, n_candidates=15).collect()
    drawn = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(14))).alias("candidate")).select(
        "*", F.xxhash64("k", "candidate", F.lit(42)).alias("h")).collect()
    pop, lists = Counter(r["seg"] for r in drawn if r["candidate"] == 0), {}
    for c in range(15):
        mine = [r for r in drawn if r["candidate"] == c]
        must = [r for r in mine if r["must"]]
        rest = sorted((-math.log((abs(r["h"]) % (1 << 52) + 1) / (1 << 52)) / r["w"], r["k"], r["seg"], i)
                      for i, r in enumerate(mine) if not r["must"] and r["w"] > 0)[:20 - len(must)]
        lists[c] = [(r["k"], r["seg"]) for r in must] + [(k, seg) for _, k, seg, _ in rest]

    def distance(c):
        n = Counter(seg for _, seg in lists[c])
        return round(sum(abs(n[v] / 20 - pop[v] / 4000) for v in pop), 9), c
    best = min(lists, key=distance)
    assert {r["candidate"] for r in got} == {best} and sorted((r["k"], r["seg"]) for r in got) == sorted(lists[best])
    # more mandatory rows than the sample has: they are the sample, and the first candidate's
    all_must = representative_sample(df.withColumn("must", F.col("k") < 50), "k", "w", "must", ["seg"], size=20, n_candidates=15)
    rows = all_must.collect()
    assert {r["candidate"] for r in rows} == {0} and len(rows) == df.where("k < 50").count()
    # draws meet their candidate's bound before they are sorted
    assert "get(scalar-subquery" in all_must._jdf.queryExecution().toString()
