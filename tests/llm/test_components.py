"""Connected components against union-find, and what they and the chosen-path join write."""

from __future__ import annotations

import numpy as np
import pytest

from dossier.llm import chosen_path, components


def union_find(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return sorted((x, find(x)) for x in root if find(x) != x)


def recorded(monkeypatch, module):
    made, inner = [], module.written
    monkeypatch.setattr(module, "written", lambda spark, df, name: made.append((name, df)) or inner(spark, df, name))
    return made


rng = np.random.default_rng(3)
LINKS = {
    "none": [],
    "itself": [(4, 4)],
    "chain": [(k, k + 1) for k in rng.permutation(60).tolist()],
    "hub above": [(100, k) for k in range(40)] * 2,
    "random": [tuple(x) for x in rng.integers(-80, 80, (90, 2)).tolist()],
    "two stars that meet": [(1, k) for k in range(10, 20)] + [(2, k) for k in range(19, 30)],
}


@pytest.mark.parametrize("name", LINKS)
def test_components_are_union_find(spark, name):
    df = spark.createDataFrame(LINKS[name], "a long, b long")
    got = sorted((r.node, r.root) for r in components.components(spark, df).collect())
    assert got == union_find([x for x in LINKS[name] if x[0] != x[1]])


def test_stars_need_no_round(spark, monkeypatch):
    made = recorded(monkeypatch, components)
    df = spark.createDataFrame([(k, 1 + 100 * (k % 3)) for k in range(1000, 1300)] * 2, "a long, b long")
    assert components.components(spark, df).count() == 300
    assert len(made) == 1


def test_no_copy_of_all_texts_is_written(spark, monkeypatch):
    made = recorded(monkeypatch, chosen_path)
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(k, f"{text} x") for k in (5, 3, None)] + [(7, f"{text} y"), (8, "alone and without any partner"), (3, f"{text} x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in chosen_path.groups(spark, docs).collect()), key=str)
    assert [r[2:] for r in got] == [(3, True), (3, True), (3, False), (3, False), (8, True), (3, False)]
    assert dict(made)["paths-rows"].columns == ["doc_id", "n", "d", "sketch"]
    packed = dict(made)["paths-packed"]
    # the join's two shuffles, and none to drop repeated rows
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2
