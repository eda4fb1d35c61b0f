"""Hard negatives against plain products of all pairs, over small blocks, with nulls, ties and repeated rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dossier.llm import hard_negatives

KIND = "vec_id long, embedding array<float>, label int, score string, key int"


def rows():
    rng = np.random.default_rng(11)
    out = [(k, (np.round(rng.normal(size=19), 2) / 2 + (k % 3)).tolist(), int(rng.integers(0, 3))) for k in range(90)]
    out += [(90, [0.5] * 19, 1), (91, [0.5] * 19, 0), (92, [0.5] * 19, 0), (93, [0.5] * 19, 2), (92, [0.5] * 19, 0)]  # ties, a repeated row
    out += [(100, [1.0, 0.25], 0), (101, [], 0), (101, [], 0), (110, [], 1), (110, [1.0] * 19, 1), (120, [1.0] * 25, 9)]
    bad = [(None, [1.0] * 19, 0), (130, None, 0), (131, [1.0] * 19, None), (132, [1.0, None], 0), (133, [float("nan")], 0),
           (140, [float("inf")] * 19, 1), (140, [-float("inf")], 1)]
    return out, bad


def brute(given, positives, negatives, low=80):
    held = sorted({(v, label, tuple(math.floor(256 * float(np.float32(x))) for x in e)) for v, e, label in given})
    out = []
    for anchor in held:
        if anchor[0] % 10:
            continue
        scored = sorted((-sum(a * b for a, b in zip(anchor[2], r[2])), r[0], r[1]) for r in held)
        near = [(s, v) for s, v, label in scored if label == anchor[1] and v != anchor[0]][:positives]
        for s, v in near:
            far = [(t, w) for t, w, label in scored if label != anchor[1] and -low * s <= -100 * t <= -100 * s][:negatives]
            out += [(anchor[0], v, k, w, -s, -t) for k, (t, w) in enumerate(far, 1)]
    return sorted(out)


@pytest.mark.parametrize("anchors, candidates, positives, negatives, low",
                         [(512, 4096, 5, 5, 80), (2, 7, 3, 2, 30), (3, 100, 50, 60, -100)])
def test_mined_rows_are_brute_force(spark, anchors, candidates, positives, negatives, low):
    good, bad = rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in good + bad], KIND)
    out = hard_negatives.mine(spark, hard_negatives.usable(df), "vec_id % 10 = 0", positives, negatives, low, 100, anchors, candidates)
    want = brute(good, positives, negatives, low)
    assert sorted(map(tuple, out.collect())) == want and len({r[0] for r in want}) > 5


def test_scores_are_products():
    rng = np.random.default_rng(2)
    for most, width, other in ((3, 5, 9), (1 << 10, 64, 64), (1 << 25, 17, 8), (0, 4, 4)):
        a, c = rng.integers(-most - 1, most + 1, (6, width)), rng.integers(-most, most + 1, (11, other))
        both = min(width, other)
        got = hard_negatives.scores(a, hard_negatives.bit_planes(c), hard_negatives._most(c))
        assert (got == (c[:, :both] @ a[:, :both].T)).all()
    with pytest.raises(ValueError):
        hard_negatives.scores(np.full((1, 8), 1 << 40), hard_negatives.bit_planes(np.full((1, 8), 1 << 40)), 1 << 40)


def test_empty_tables(spark):
    df = spark.createDataFrame([], KIND)
    assert hard_negatives.mine(spark, hard_negatives.usable(df), "vec_id % 10 = 0").count() == 0
    one = spark.createDataFrame([(10, [1.0], 1, "x", 1)], KIND)
    assert hard_negatives.mine(spark, hard_negatives.usable(one), "vec_id % 10 = 0").count() == 0
    assert hard_negatives.mine(spark, hard_negatives.usable(one), "vec_id % 10 = 3").count() == 0
    assert hard_negatives.usable(one.withColumn("embedding", F.lit(None).cast("array<float>"))).isEmpty()


@pytest.mark.parametrize("partitions, held", [(1, 1 << 20), (1, 1), (40, 1 << 20)])
def test_blocks_meet_in_tiles_and_are_not_broadcast(spark, monkeypatch, partitions, held):
    good, _ = rows()
    plans, rows_of, write = {}, {}, hard_negatives.written

    def written(session, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        out = write(session, df, name)
        rows_of[name] = out.count()
        return out

    monkeypatch.setattr(hard_negatives, "written", written)
    monkeypatch.setattr(hard_negatives, "HELD", held)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = hard_negatives.usable(spark.createDataFrame([(*r, "x", 1) for r in good], KIND))
        out = hard_negatives.mine(spark, df, "vec_id % 10 = 0", 3, 2, 30, 100, 2, 7)
        got = sorted(map(tuple, out.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(good, 3, 2, 30) and got
    # copies of blocks go from executor to executor, however few bytes their table has before it is copied
    assert {"negatives-near", "negatives-given", "negatives-found"} <= {*plans}
    assert not [name for name, plan in plans.items() if "Broadcast" in plan]
    if (partitions, held) == (1, 1 << 20):  # one tile, of the best of each anchor and window
        anchors = {(v, label, tuple(x)) for v, x, label in good if v % 10 == 0}
        assert rows_of["negatives-near"] <= 3 * len(anchors) and rows_of["negatives-found"] <= 3 * 2 * len(anchors)


def test_first_rows():
    found = [np.array(x) for x in ([1, 1, 1, 2, 1, 2], [5, 5, 5, 5, 6, 5], [9, 8, 7, 1, 3, 2], [4, 4, 5, -1, 0, -2])]
    assert np.transpose(hard_negatives._first(found, 2, 2)).tolist() == [[1, 5, 7, 5], [1, 5, 8, 4], [1, 6, 3, 0], [2, 5, 1, -1], [2, 5, 2, -2]]
    assert [len(x) for x in hard_negatives._first([np.empty(0, np.int64)] * 4, 2, 5)] == [0] * 4


def test_scores_of_the_largest_sums(monkeypatch):
    monkeypatch.setattr(hard_negatives, "SCORED", 4)
    rng = np.random.default_rng(5)
    for most, width in ((511, 64), (512, 64), (255, 128), (255, 300), (256, 128), (256, 300), (1 << 15, 8), (1 << 20, 40)):  # to both sides of 16 bits a plane
        for sign in (1, -1):
            a = np.vstack([np.full((1, width), sign * most), rng.integers(-most, most + 1, (3, width))])
            c = np.vstack([np.full((1, width), most), np.full((1, width), -most), rng.integers(-most, most + 1, (9, width))])
            got = hard_negatives.scores(a, hard_negatives.bit_planes(c), hard_negatives._most(c))
            assert (got == c @ a.T).all()
