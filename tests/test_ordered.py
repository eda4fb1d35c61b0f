"""Ordered scans equal plain windows, whichever keys are split; hot keys are split, and nothing runs while planning."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import dossier.operators.ordered as ordered_mod
from dossier.operators.ordered import CHUNK, add_chunks, ordered_scan, sort_column

SPECS = {"rn": ("row_number",), "lg": ("lag", "v"), "ld": ("lead", "v"), "s": ("sum", "v"),
         "mx": ("max", "v"), "mn": ("min", "v"), "mb": ("max_before", "v"),
         "ln": ("last_nonnull", "v"), "nn": ("next_nonnull", "v"), "f": ("is_first",)}


def plain(df, keys, order):
    """SPECS by ordinary windows."""
    w = Window.partitionBy(*keys).orderBy(*map(sort_column, order))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", F.row_number().over(w).cast("long").alias("rn"), F.lag("v").over(w).alias("lg"),
                     F.lead("v").over(w).alias("ld"), F.sum("v").over(run).alias("s"),
                     F.max("v").over(run).alias("mx"), F.min("v").over(run).alias("mn"),
                     F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("mb"),
                     F.last("v", True).over(run).alias("ln"),
                     F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("nn"),
                     (F.row_number().over(w) == 1).alias("f"))


def same(got, want):
    got = got.select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("n", [1, 7, 300])
def test_ordered_scan_matches_windows(spark, n):
    # key 0 holds ~70 % of the rows, one key is NULL; NULL values sprinkled in
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, 0).when(F.col("id") % 13 > 0, F.col("id") % 13).alias("k"), F.lit("x").alias("g"),
        F.col("id").alias("t"), F.when(F.col("id") % 17 == 0, None).otherwise(F.col("id") % 101).alias("v"))
    same(ordered_scan(df, ["k", "g"], ["t"], SPECS, n_chunks=n), plain(df, ["k", "g"], ["t"]))


VALUES = {
    "long": ("bigint", [5, -3, -(1 << 63), (1 << 63) - 1, 0, None]),
    "double": ("double", [0.5, -0.0, 0.0, float("nan"), float("inf"), -float("inf"), None]),
    "decimal": ("decimal(9,2)", [Decimal("1.50"), Decimal("-7.25"), Decimal("0"), None]),
    "boolean": ("boolean", [True, False, None]),
    "string": ("string", ["", "a", "ab", "b", "aé", "日本", "A", None]),
    "binary": ("binary", [b"", b"\x00", b"\xff", b"a", b"ab", None]),
    "date": ("date", [dt.date(1969, 12, 31), dt.date(2024, 2, 29), dt.date(1, 1, 1), None]),
    "stamp": ("timestamp", [dt.datetime(1969, 12, 31, 23), dt.datetime(2024, 2, 29, 1, 2, 3, 4), None]),
    "wall": ("timestamp_ntz", [dt.datetime(1960, 1, 1), dt.datetime(2024, 2, 29, 1, 2, 3, 4), None]),
    "array": ("array<int>", [[1], [2, 3], None]),  # no leading column to cut along
}


@pytest.mark.parametrize("name", VALUES)
def test_every_type_and_direction_is_cut_in_order(spark, name):
    kind, values = VALUES[name]
    rows = [(1, values[i % len(values)], i, i % 7 or None) for i in range(60)] + [(2, values[0], 60, 1)]
    df = spark.createDataFrame(rows, f"k int, o {kind}, t int, v int")
    for order in (["o", "t"], [("o", False), "t"], [("o", True, False), ("t", False)], [("o", False, True), "t"]):
        same(ordered_scan(df, ["k"], order, SPECS, n_chunks=5), plain(df, ["k"], order))
    chunks = add_chunks(df, ["k"], [("o", False)], 5).where("k = 1").select(CHUNK).distinct().count()
    assert chunks == 1 if name == "array" else chunks > 1


def test_hot_key_after_a_join_is_split_over_many_tasks(spark):
    facts = spark.range(20000).select((F.col("id") % 100).alias("a"), F.col("id").alias("t"), F.col("id").alias("v"))
    names = spark.range(100).select(F.col("id").alias("a"), F.when(F.col("id") < 50, 0).otherwise(F.col("id")).alias("k"))
    df = facts.join(names, "a").select("k", "t", "v")  # half of all rows have the key 0
    sizes = [r["count"] for r in add_chunks(df, ["k"], ["t"], 40).where("k = 0").groupBy(CHUNK).count().collect()]
    assert len(sizes) >= 18 and max(sizes) <= 3 * 20000 / 40
    tasks = ordered_scan(df, ["k"], ["t"], {"rn": ("row_number",)}, n_chunks=40, keep_chunk=True) \
        .where("k = 0").groupBy(F.spark_partition_id()).count().count()
    assert tasks >= 3  # of four shuffle partitions
    same(ordered_scan(df, ["k"], ["t"], SPECS, n_chunks=40), plain(df, ["k"], ["t"]))


def test_keys_below_a_partitions_share_are_not_split(spark):
    df = spark.range(3000).select((F.col("id") % 500).alias("k"), F.col("id").alias("t"))
    assert add_chunks(df, ["k"], ["t"], 8).where(f"{CHUNK} <> 0").isEmpty()


def test_nothing_runs_while_the_plan_is_built(spark):
    df = spark.range(100).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    spark.sparkContext.setJobGroup("ordered-plan", "building")
    try:
        out = ordered_scan(df, ["k"], ["t"], SPECS)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("ordered-plan")) == []
        assert out.count() == 100
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("ordered-plan")) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_empty_input(spark):
    df = spark.range(0).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    assert ordered_scan(df, ["k"], ["t"], SPECS).count() == 0


@pytest.mark.parametrize("n", [1, 6, 60])
def test_rank_and_dense_rank_with_peers(spark, n):
    df = spark.range(4000).select(F.when(F.col("id") % 5 < 4, 0).otherwise(1).alias("k"),
                                  (F.col("id") % 97).alias("score"), F.col("id").alias("t"))
    got = ordered_scan(df, ["k"], [("score", False), "t"], {"r": ("rank",), "d": ("dense_rank",)},
                       rank_by=[("score", False)], n_chunks=n)
    w = Window.partitionBy("k").orderBy(F.col("score").desc())
    same(got, df.select("*", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d")))


def test_merge_intervals_with_identical_rows(spark):
    from dossier.operators.worktime import merge_intervals
    rows = [(1, "2024-01-03", "2024-01-03")] * 3 + [(1, "2024-01-04", "2024-01-10"), (1, "2024-01-20", "2024-01-21"),
                                                    (2, "2024-01-01", "2024-01-01")] * 2
    df = spark.createDataFrame(rows, "k int, s string, e string").select(
        "k", F.to_date("s").alias("s"), F.to_date("e").alias("e"))
    got = sorted((r["k"], str(r["s"]), str(r["e"])) for r in merge_intervals(df, ["k"], "s", "e").collect())
    assert got == [(1, "2024-01-03", "2024-01-10"), (1, "2024-01-20", "2024-01-21"), (2, "2024-01-01", "2024-01-01")]


CHUNKED_QUERIES = ["w_04_dense_rank", "w_05_previous_value", "w_06_next_value", "w_08_running_sum",
                   "w_09_count_over", "w_12_gaps_and_islands", "w_16_resolve_single_latest",
                   "w_17_state_transitions", "w_18_retry_number", "w_19_nearest_in_time", "j_interval",
                   "k_03_conditional_update", "t_02_days_in_status", "t_03_days_in_rebound",
                   "t_07_completed_on_time"]


@pytest.mark.parametrize("name", CHUNKED_QUERIES)
def test_registered_queries_with_split_keys(spark, small_dir, name, monkeypatch):
    import __spark_entry__ as E
    monkeypatch.setattr(ordered_mod, "CHUNKS", 512)  # keys with a dozen rows or fewer are split already
    from tools.oracle_check import compare, duck_conn
    status, msg = compare(name, E.queries()[name], E.oracle_sql()[name], spark, duck_conn(small_dir), small_dir)
    assert status == "OK", msg


@pytest.mark.parametrize("chunks", [None, 50])
def test_interval_merging_in_tasks_by_input_size(spark, chunks, monkeypatch):
    from dossier.operators.worktime import days_in_status, merge_intervals
    monkeypatch.setattr(ordered_mod, "CHUNKS", chunks)
    df = spark.range(2000).selectExpr("IF(id % 3 > 0, 1, IF(id % 7 > 0, id % 7, NULL)) AS k", "IF(id % 2 = 0, 'A', 'B') AS st",
                                      "date_add(DATE '2024-01-01', CAST(pmod(hash(id), 900) AS INT)) AS s",
                                      "date_add(DATE '2024-01-01', CAST(pmod(hash(id), 900) + id % 4 AS INT)) AS e")
    same(merge_intervals(df, ["k", "st"], "s", "e", 9, ["k"]), merge_intervals(df, ["k", "st"], "s", "e"))
    got = days_in_status(df, ["k"], "st", "s", "e", ["A", "B"], tasks=9)
    days = df.selectExpr("k", "st", "explode(sequence(s, e)) AS d").where("weekday(d) < 5").distinct()
    want = days.groupBy("k").pivot("st", ["A", "B"]).count().na.fill(0, ["A", "B"]).toDF("k", "days_A", "days_B")
    same(got, want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    sized = [x for x in plan.splitlines() if "Exchange hashpartitioning(k" in x and ", 9)" in x]
    # rows and islands are shuffled into the given tasks, and not again for the islands, the pivot and its sums
    assert len(sized) >= 2 and plan.count("Exchange hashpartitioning(k") == len(sized)
