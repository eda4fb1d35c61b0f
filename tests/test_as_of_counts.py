"""Counts as of many dates from one scan (S-20), and the open pivot (R-01)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from dossier.operators.shape import pivot_open
from dossier.sources.snapshots import counts_as_of

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(40)]


def test_counts_match_enumeration(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None]), r.choice([*DAYS, None]), r.choice([*DAYS, None])) for _ in range(300)]
    rows += [("late", DAYS[39], None), ("gone", DAYS[0], DAYS[1]), ("back", DAYS[9], DAYS[3]), ("same", DAYS[3], DAYS[3])]
    dates = [DAYS[k] for k in (30, 5, 12, 13, 5)]
    df = spark.createDataFrame(rows, "k string, a date, b date")
    got = {(x.k, x.as_of): x.n for x in counts_as_of(df, ["k"], "a", dates, "b").collect()}
    want = {}
    for k, a, b in rows:
        for d in set(dates):
            if a is not None and a <= d and (b is None or (a < b and d < b)):
                want[k, d] = want.get((k, d), 0) + 1
    assert got == want


def test_one_scan_for_many_dates(spark, small_dir):
    from dossier.sources.tables import table
    out = counts_as_of(table(spark, small_dir, "orders"), ["o_orderstatus"], "o_orderdate",
                       [dt.date(1992, 1, 1) + dt.timedelta(days=30 * k) for k in range(80)])
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert out.count() > 80


def test_counts_of_no_rows_and_no_dates(spark):
    none = spark.createDataFrame([], "k string, a date")
    assert counts_as_of(none, ["k"], "a", DAYS).count() == 0
    assert counts_as_of(spark.createDataFrame([("x", DAYS[0])], "k string, a date"), ["k"], "a", []).count() == 0


def test_open_pivot_keeps_null_and_many_values(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") > 3, F.col("id")).alias("v"))
    got = {r.k: r.cells for r in pivot_open(df, ["k"], "v", F.count(F.lit(1))).collect()}
    assert got[0]["(null)"] == got[1]["(null)"] == 2
    assert len(got[0]) == len(got[1]) == 2499 and got[0]["4998"] == 1
