"""The n-gram join (9) builds components again only for new links."""

from __future__ import annotations

from dossier.llm import ngram_join
from tests.llm.test_near_rounds import sharing


def test_components_are_not_built_again_without_new_links(spark, monkeypatch):
    base = [f"w{k}" for k in range(200)]
    copies = [" ".join(base[:k] + ["x"] + base[k + 1:]) for k in range(20, 26)]
    rows = list(enumerate([*copies, *sharing(5, 10, 90)]))
    calls, inner = [], ngram_join.components
    monkeypatch.setattr(ngram_join, "components", lambda spark, links: calls.append(1) or inner(spark, links))
    got = ngram_join.groups(spark, spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100)
    assert {r.doc_id: r.component_id for r in got.collect()} == {d: 0 if d < 6 else d for d, _ in rows}
    assert len(calls) == 1
