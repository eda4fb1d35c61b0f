"""Hand-made edge cases per operator family: NULL key, ties, empty input, duplicates."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dossier.operators import hierarchy as HI
from dossier.operators import history as H
from dossier.operators import quality as DQ
from dossier.operators import recon as RC
from dossier.operators import sampling as SM
from dossier.operators import worktime as W
from dossier.operators.documents import chunk_text
from dossier.operators.identity import survivorship
from dossier.operators.joins import interval_join, not_in
from dossier.operators.pick import dedupe_latest, nearest_in_time
from dossier.sources import sinks as K
from dossier.sources import snapshots as S

D = dt.date


def _nk(t):
    return tuple((x is not None, x) for x in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_nk)


def test_dedupe_latest_ties_and_null_keys(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (None, 1, "x"), (None, 2, "y"), (2, 1, "z")],
                               "k int, d int, v string")
    out = dedupe_latest(df, ["k"], [F.col("d").desc()])
    # tie on d=5 broken by the remaining columns ascending; NULL keys form one group
    assert rows(out, "k", "d", "v") == sorted([(1, 5, "a"), (None, 2, "y"), (2, 1, "z")], key=_nk)


def test_not_in_null_semantics(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    sub = spark.createDataFrame([(1,)], "s int")
    assert rows(not_in(df, "k", sub, "s"), "k") == [(2,)]
    empty = spark.createDataFrame([], "s int")
    assert len(not_in(df, "k", empty, "s").collect()) == 3
    with_null = spark.createDataFrame([(1,), (None,)], "s int")
    assert not_in(df, "k", with_null, "s").collect() == []


def test_survivorship_skips_nulls_and_ranks(spark):
    df = spark.createDataFrame([("p", 1, None, 10.0), ("p", 2, "second", 20.0), ("p", 3, "third", None)],
                               "id string, r int, name string, bal double")
    out = survivorship(df, "id", "r", ["name", "bal"]).collect()[0]
    assert out["name"] == "second" and out["bal"] == 10.0


def test_workday_count_equals_enumeration(spark):
    random.seed(7)
    pairs = []
    for _ in range(400):
        s = D(2020, 1, 1) + dt.timedelta(days=random.randint(0, 800))
        pairs.append((s, s + dt.timedelta(days=random.randint(-3, 40))))
    pairs.append((None, D(2020, 1, 1)))
    df = spark.createDataFrame(pairs, "s date, e date")
    out = df.select(W.workday_count("s", "e").alias("a"), F.size(W.workdays("s", "e")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in out)


def test_scd2_replay_equals_folded_merge(spark):
    cols = ["k", "v"]
    snaps = [(D(2024, 1, 1), [(1, "a"), (2, "b"), (3, None)]),
             (D(2024, 2, 1), [(1, "a"), (3, "c")]),           # 2 gone, 3 changed (NULL -> c)
             (D(2024, 3, 1), [(1, "a"), (2, "b"), (3, "c")])]  # 2 back
    frames = [spark.createDataFrame(r, "k int, v string").withColumn("d", F.lit(d)) for d, r in snaps]
    t = H.scd2_init(frames[0].drop("d"), cols, snaps[0][0])
    for (d, _), f in zip(snaps[1:], frames[1:]):
        t = H.scd2_merge(t, f.drop("d"), cols, d)
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    r = H.scd2_replay(u, cols, "d")
    key = ("k", "v", "start_date", "end_date", "is_active")
    assert rows(t, *key) == rows(r, *key)


def test_snapshot_diff_null_change(spark):
    old = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "z"), (4, "w")], "k int, v string")
    d = {r["k"]: r["change_type"] for r in H.snapshot_diff(old, new, ["k"], ["v"]).collect()}
    assert d == {2: "changed", 3: "deleted", 4: "new"}


def test_upsert_refuses_duplicate_keys(spark):
    tgt = spark.createDataFrame([(1, "a")], "k int, v string")
    upd = spark.createDataFrame([(2, "b"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="duplicate"):
        K.upsert(tgt, upd, ["k"]).collect()
    ok = K.upsert(tgt, spark.createDataFrame([(1, "z"), (3, "n")], "k int, v string"), ["k"])
    assert rows(ok, "k", "v") == [(1, "z"), (3, "n")]


def test_guards_raise(spark):
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp_ntz")
    with pytest.raises(Exception, match="stale"):
        S.freshness_guard(ev, "ts", D(2024, 3, 1), 7).collect()
    with pytest.raises(Exception, match="too few rows"):
        HI.row_volume_guard(ev, 5).collect()
    with pytest.raises(Exception, match="duplicate"):
        DQ.fail_on_duplicates(spark.createDataFrame([(1,), (1,)], "k int"), ["k"]).collect()


def test_match_tier_cases(spark):
    df = spark.createDataFrame([("ACME Ltd", "acme ltd "), ("Société X Ltd.", "Societe-X Limited"),
                                (None, "x"), ("a", "b")], "a string, b string")
    assert [r[0] for r in df.select(RC.match_tier("a", "b")).collect()] == [1, 3, 2, 0]


def test_chunk_text_covers_text(spark):
    df = spark.createDataFrame([("abcdefghij",), ("",)], "t string")
    out = df.select(F.explode(chunk_text("t", 4, 1)).alias("c")).select("c.*").collect()
    assert [(r["start"], r["chunk"]) for r in out] == [(0, "abcd"), (3, "defg"), (6, "ghij"), (9, "j")]


def test_exact_hash_sample_sizes(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    sizes = spark.createDataFrame([(0, 7), (1, 1000), (2, 5000)], "g long, n long")
    out = SM.take_smallest_hashes(df, ["g"], sizes, "n", ["k"], 1)
    got = dict((r["g"], r["c"]) for r in out.groupBy("g").agg(F.count(F.lit(1)).alias("c")).collect())
    assert got == {0: 7, 1: 1000, 2: 1666}
    # exactly the smallest hashes
    h = df.where("g = 0").withColumn("h", F.xxhash64("k", F.lit(1))).orderBy("h", "k").limit(7)
    assert rows(out.where("g = 0"), "k") == rows(h, "k")


def test_interval_join_matches_brute_force(spark):
    random.seed(3)
    base = dt.datetime(2024, 1, 1)
    pts = [(i, random.randint(0, 3), base + dt.timedelta(hours=random.randint(0, 24 * 90))) for i in range(300)]
    ivs = []
    for j in range(60):
        s = base + dt.timedelta(hours=random.randint(0, 24 * 90))
        ivs.append((j, random.randint(0, 3), s, s + dt.timedelta(hours=random.randint(1, 24 * 40))))
    p = spark.createDataFrame(pts, "pid int, key int, t timestamp_ntz")
    i = spark.createDataFrame(ivs, "iid int, key int, s timestamp_ntz, e timestamp_ntz")
    got = rows(interval_join(p, i, "key", "t", "s", "e", bucket_days=7), "pid", "iid")
    want = sorted(((a, b) for a, k1, t in pts for b, k2, s, e in ivs if k1 == k2 and s < t < e), key=_nk)
    assert got == want


def test_nearest_in_time_matches_brute_force(spark):
    random.seed(5)
    L = [(i, random.randint(0, 4), D(2024, 1, 1) + dt.timedelta(days=random.randint(0, 60))) for i in range(80)]
    R = [(j, random.randint(0, 4), D(2024, 1, 1) + dt.timedelta(days=random.randint(0, 60))) for j in range(120)]
    lf = spark.createDataFrame(L, "lid int, key int, ld date")
    rf = spark.createDataFrame(R, "rid int, key int, rd date")
    got = rows(nearest_in_time(lf, rf, "key", "ld", "rd", "lid", "rid"), "lid", "rid", "day_diff")
    want = []
    for lid, k, ld in L:
        c = [(abs((rd - ld).days), rd, rid) for rid, k2, rd in R if k2 == k]
        if c:
            d, _, rid = min(c)
            want.append((lid, rid, d))
    assert got == sorted(want, key=_nk)


def test_related_parties_cycle_and_fixed_point(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 4)], "child int, parent int")
    starts = spark.createDataFrame([(1,), (4,)], "id int")
    out = rows(HI.related_parties(starts, edges), "root", "node", "depth")
    assert out == [(1, 2, 1), (1, 3, 2)]


def test_leading_entity_credit_wins(spark):
    nodes = spark.createDataFrame([(1, "Sub Account"), (2, "Branch"), (3, "Legal Entity"), (4, "Branch")],
                                  "id int, party_type string")
    edges = spark.createDataFrame([(1, "Main Account", 2), (2, "Branch of", 3), (4, "Credit", 9),
                                   (4, "Branch of", 3)], "id int, rel_type string, parent int")
    out = dict((r["id"], r["leading_id"]) for r in HI.leading_entity(nodes, edges).collect())
    assert out == {1: 3, 2: 3, 3: 3, 4: 9}


def test_dq_unique_examples_bounded(spark):
    df = spark.createDataFrame([(i % 30,) for i in range(100)], "k int")
    r = DQ.dq_unique(df, ["k"], "u", n_examples=3).collect()[0]
    assert r["status"] == "Fail" and r["n_duplicate_keys"] == 30 and r["examples"] == "0,1,2"
