"""The chosen-path join (12) reads no text of a set that has no near one."""

from __future__ import annotations

from dossier.llm import chosen_path


def sharing(texts, shared, own):
    """Texts that have a passage in common and nothing else."""
    passage = [f"p{k}" for k in range(shared)]
    return [" ".join(passage + [f"u{t}_{k}" for k in range(own)]) for t in range(texts)]


def test_texts_without_a_near_set_are_not_read(spark, monkeypatch):
    texts = sharing(40, 60, 120)
    rows = list(enumerate([*texts, texts[3] + " end"]))
    read, inner = [], chosen_path._texts_of
    monkeypatch.setattr(chosen_path, "_texts_of", lambda sets, docs, words: read.append(sets.count()) or inner(sets, docs, words))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in chosen_path.groups(spark, docs, words=5, p=85, q=100).collect()}
    assert got == {d: 3 if d == 40 else d for d, _ in rows}
    assert read == [2]  # all 41 share leaves


def test_large_leaves_stay_whole(spark):
    texts = sharing(9, 60, 120)
    sets = chosen_path.sketched(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5)
    sets = sets.selectExpr("doc_id AS node", "d", "n", "sketch", "doc_id AS first")
    members = sets.selectExpr("7L AS path", "node", "9L AS size")
    assert chosen_path._partnered(members, sets, 8, 40, 85, 100).count() == 9
    assert chosen_path._partnered(members, sets, 9, 40, 85, 100).count() == 0
    assert chosen_path._partnered(members, sets, 9, 0, 85, 100).count() == 9
