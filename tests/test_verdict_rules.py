"""Hand-made cases for rules whose SQL twin could repeat a mistake."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dossier.operators import hierarchy as HI
from dossier.operators import money as M
from dossier.operators import worktime as W
from dossier.operators.relational import union_all
from dossier.sources import snapshots as S

D = dt.date


def test_ultimate_parent_takes_the_deepest_level_over_both_chains(spark):
    edges = [(1, "Credit", 5), (1, "Operational Hierarchy", 2), (2, "Operational Hierarchy", 3),  # deeper wins
             (10, "Credit", 11), (10, "Operational Hierarchy", 12),  # equal depth: Credit
             (20, "Credit", 22), (20, "Credit", 21),  # tie: smallest id
             (3, "Commercial", 9), (11, "Commercial", 8), (30, "Credit", 31), (31, "Credit", 30)]  # a cycle
    types = [(i, "Legal Entity") for i in (3, 9, 11)] + [(8, "Branch")]
    chain = [(100 + i, "Credit", 101 + i) for i in range(12)]  # longer than any depth cap
    e = spark.createDataFrame(edges + chain, "id int, rel_type string, parent int")
    t = spark.createDataFrame(types, "id int, party_type string")
    starts = spark.createDataFrame([(i,) for i in (1, 10, 20, 30, 40, 100)], "id int")
    got = {r.id: (r.ultimate_parent, r.chain, r.depth, r.super_parent)
           for r in HI.ultimate_parent(starts, e, t).collect()}
    assert got == {1: (3, "Operational Hierarchy", 2, 9), 10: (11, "Credit", 1, 11), 20: (21, "Credit", 1, 21),
                   30: (31, "Credit", 1, 31), 40: (40, "self", 0, 40), 100: (112, "Credit", 12, 112)}


def test_ultimate_parent_of_text_ids(spark):
    e = spark.createDataFrame([("a", "Credit", "c"), ("a", "Credit", "b")], "id string, rel_type string, parent string")
    t = spark.createDataFrame([], "id string, party_type string")
    row = HI.ultimate_parent(e.select("id").distinct(), e, t).first()
    assert (row.ultimate_parent, row.super_parent) == ("b", "b")


def test_limit_breach_flags(spark):
    rows = [(1, 100, 0, 120, 50, -20), (2, 100, 100, 60, 50, -60), (3, 0, 0, 10, 50, -10), (4, 100, 0, 90, 50, 10)]
    df = spark.createDataFrame(rows, "k int, e int, u int, x int, i int, a int")
    got = df.select("k", *[c.alias(n) for n, c in M.limit_breach(*(F.col(c) for c in "euxia")).items()]).collect()
    assert {r.k: (r.effective_breach, r.intraday_breach, r.available_breach, int(r.new_available)) for r in got} == {
        1: (True, False, True, -20), 2: (False, True, True, -60), 3: (False, False, True, 40), 4: (False, False, False, 10)}


def test_completed_on_time_rules(spark):
    rows = [("repeat", 1, "Periodic Review", D(2024, 1, 1), D(2025, 1, 1), 10),
            ("repeat", 2, "QC EDR", D(2024, 2, 1), D(2025, 1, 1), 10),  # repeats the date: the client goes
            ("off", 3, "Periodic Review", D(2024, 1, 1), D(2025, 1, 1), 10),
            ("off", 4, "Offboarding", D(2024, 2, 1), D(2025, 1, 1), 10),  # an offboarding may repeat it
            ("edr", 5, "Event Driven Review", D(2024, 1, 1), D(2024, 3, 1), 91),
            ("edr", 6, "Event Driven Review", D(2024, 2, 1), D(2024, 4, 1), 90),
            ("late", 7, "Periodic Review", D(2024, 1, 1), D(2024, 6, 1), 10),
            ("late", 8, "Periodic Review", D(2024, 7, 1), D(2030, 1, 1), 10)]
    df = spark.createDataFrame(rows, "client string, id int, type string, signoff date, nrd date, days int")
    got = W.completed_on_time(df, "client", "id", "type", "signoff", "nrd", "days", D(2024, 12, 31)).collect()
    assert {r.id: r.completed_on_time for r in got} == {3: 1, 4: None, 5: 0, 6: 1, 7: 0, 8: None}


def test_version_map_raises_for_an_absent_object():
    by_source = {"sales": {"1": ["a", "b"], "3": ["c"]}}
    assert S.resolve_version(["1", "2", "3"], "b", mapping=S.version_map(by_source, "sales")) == "1"
    assert S.resolve_version(["1", "2"], "b", mapping=S.version_map(by_source, "other")) == "2"
    with pytest.raises(S.SnapshotError):
        S.resolve_version(["1", "2"], "z", mapping=S.version_map(by_source, "sales"))


def test_union_all_is_positional(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(2, "y")], "id int, name string")
    assert {tuple(r) for r in union_all(a, b).collect()} == {(1, "x"), (2, "y")}
