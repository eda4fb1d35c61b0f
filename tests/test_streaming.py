"""Streaming incremental load: bucketed state, idempotent re-runs."""

import datetime as dt

from pyspark.sql import functions as F

from dossier.session import scratch_path
from dossier.sources.sinks import write_snapshot
from dossier.streaming.incremental import incremental_snapshot_load, latest_state


def test_incremental_load_merges_and_is_idempotent(spark):
    root = scratch_path(spark, "stream_src")
    base = spark.range(50).select(F.col("id").alias("k"), F.lit("v1").alias("v"))
    write_snapshot(base, root, "o", "1", dt.date(2024, 1, 1))
    src = f"{root}/o/1"
    schema = spark.read.option("basePath", src).parquet(src).schema
    target, ckpt = scratch_path(spark, "stream_tgt"), scratch_path(spark, "stream_ck")
    s1 = incremental_snapshot_load(spark, src, schema, target, ckpt, ["k"], buckets=8)
    assert s1.count() == 50
    # a newer snapshot changes half the keys and adds new ones
    upd = spark.range(25, 75).select(F.col("id").alias("k"), F.lit("v2").alias("v"))
    write_snapshot(upd, root, "o", "1", dt.date(2024, 1, 2))
    s2 = sorted(tuple(r) for r in incremental_snapshot_load(spark, src, schema, target, ckpt, ["k"],
                                                            buckets=8).collect())
    got = {k: v for k, v, *_ in s2}
    assert len(got) == 75 and got[0] == "v1" and got[30] == "v2" and got[74] == "v2"
    # running again with no new files changes nothing
    s3 = incremental_snapshot_load(spark, src, schema, target, ckpt, ["k"], buckets=8)
    assert sorted(tuple(r) for r in s3.collect()) == s2
    # a fresh checkpoint re-reads every file (a full replay): same final state
    s4 = incremental_snapshot_load(spark, src, schema, target, scratch_path(spark, "stream_ck2"), ["k"], buckets=8)
    assert sorted(tuple(r) for r in s4.collect()) == s2
    assert latest_state(spark, target).count() == 75


def test_state_is_written_once_per_load_and_broken_loads_are_merged(spark, monkeypatch):
    import dossier.streaming.incremental as inc
    root, target, ckpt = (scratch_path(spark, x) for x in ("many_src", "many_tgt", "many_ck"))
    for day in (1, 2, 3):  # nine files, nine micro-batches
        rows = spark.range(day * 10, 60 + day * 10).select((F.col("id") % 65).alias("k"), F.lit(f"v{day}").alias("v")).repartition(3)
        write_snapshot(rows, root, "o", "1", dt.date(2024, 1, day))
    src = f"{root}/o/1"
    schema = spark.read.option("basePath", src).parquet(src).schema
    merges, batches, merge, add = [], [], inc.dedupe_latest, inc._add_batch
    monkeypatch.setattr(inc, "dedupe_latest", lambda *a: merges.append(1) or merge(*a))

    def broken(*a):  # the fifth micro-batch is lost once
        def run(batch, batch_id):
            if batch_id == 4 and not batches:
                batches.append(batch_id)
                raise RuntimeError("lost")
            add(*a)(batch, batch_id)
        return run
    monkeypatch.setattr(inc, "_add_batch", broken)
    load = lambda: inc.incremental_snapshot_load(spark, src, schema, target, ckpt, ["k"], max_files_per_trigger=1, buckets=8)
    try:
        load()
        raise AssertionError("the lost batch must fail the load")
    except Exception as e:
        assert "lost" in str(e)
    got = {r["k"]: r["v"] for r in load().collect()}
    frames = spark.read.option("basePath", src).parquet(src).orderBy("load_date").collect()
    assert got == {r["k"]: r["v"] for r in frames} and batches == [4]
    assert len(merges) == 2 and load().count() == len(got) and len(merges) == 2  # once per load with new rows
