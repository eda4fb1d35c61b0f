"""The chosen-path join against all pairs by brute force, with small leaves, nulls, ties and repeated rows."""

import numpy as np
import pytest
import zstandard

from dossier.llm import chosen_path


def shingles(text, words):
    w = (text or "").encode().lower().split()
    return {tuple(w[j:j + words]) for j in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, words, p, q=100):
    """(n_shingles, component_id, kept) of every row, by comparing every pair."""
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and root[a] != root[b] and q * len(sets[a] & sets[b]) >= p * len(sets[a] | sets[b]):
                root = [root[b] if r == root[a] else r for r in root]
    out = []
    for k, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[k] and rows[j][0] is not None] if sets[k] else [d]
        least = min(ids, default=None)
        out.append((d, len(sets[k]), least, d == least))
    return sorted(out, key=str)


def near_copies(seed, groups, size, length):
    """Groups of texts with a few words changed at random."""
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        base = [f"w{g % 3}_{k}" for k in range(length)]
        for _ in range(size):
            words = list(base)
            for at in rng.integers(0, length, rng.integers(0, 4)):
                words[at] = f"x{rng.integers(0, 6)}"
            out.append(" ".join(words[: length - rng.integers(0, length // 8)]))
    return out


ODD = [None, "", " \t\n", "Two words", "two WORDS", "two", "é É é", "a " * 4000, "a " * 4001, "ab cd ef gh " * 2000]


@pytest.mark.parametrize("words, p, leaf", [(5, 85, 1024), (5, 80, 3), (1, 85, 2)])
def test_groups_are_brute_force(spark, words, p, leaf, monkeypatch):
    monkeypatch.setattr(chosen_path, "BLOCK", 5)  # many pairs of blocks
    rows = list(enumerate(ODD + near_copies(p, 4, 14, 60) + near_copies(p + 1, 2, 3, 300)))
    # repeated rows, a doc_id with two texts that belong to two groups, rows without doc_id in a group and alone
    rows += [rows[12], rows[12], (14, rows[40][1]), (None, rows[13][1]), (None, "no id of its own here at all"), (None, None)]
    df = spark.createDataFrame([(d, t, 1, "c") for d, t in rows], "doc_id long, text string, node int, path string")
    got = sorted((tuple(r) for r in chosen_path.groups(spark, df, words, p, 100, leaf).collect()), key=str)
    assert got == brute(rows, words, p)


def test_the_query_is_brute_force(spark, small_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    out = chosen_path.op12_minhash_paths(spark, small_dir)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows, 5, 85)


def test_similar_is_exact():
    rng = np.random.default_rng(7)
    for _ in range(300):
        a, b = (" ".join(rng.choice(list("abCD"), rng.integers(0, 30))) for _ in range(2))
        for words in (1, 2, 5):
            x, y = shingles(a, words), shingles(b, words)
            assert chosen_path.similar(a.encode(), b.encode(), words, 30, 100) == (bool(x) and 100 * len(x & y) >= 30 * len(x | y))
    long = [" ".join(map(str, rng.integers(0, 60000, 60000))) for _ in range(2)]  # windows do not fit into 63 bits
    assert chosen_path.similar(long[0].encode(), (long[0] + " end").encode(), 5, 99, 100)
    assert not chosen_path.similar(long[0].encode(), long[1].encode(), 5, 1, 100)


def test_empty_and_blank_tables(spark):
    kind = "doc_id long, text string"
    assert chosen_path.groups(spark, spark.createDataFrame([], kind)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (2, " "), (None, "\n")], kind)
    assert sorted(map(str, (tuple(r) for r in chosen_path.groups(spark, blank).collect()))) == [
        "(1, 0, 1, True)", "(2, 0, 2, True)", "(2, 0, 2, True)", "(None, 0, None, True)"]


def test_trees_reach_the_recall():
    for similarity in (0.5, 0.8, 0.85, 0.95):
        missed = (1 - chosen_path.reach(similarity)) ** chosen_path.trees(similarity)
        assert missed <= 1 - chosen_path.RECALL + 1e-12
        k = chosen_path.least_agreement(similarity)
        draws = np.random.default_rng(1).binomial(chosen_path.COORDINATES, similarity, 200_000)
        assert (draws < k).mean() < 1e-4
    with pytest.raises(ValueError):
        chosen_path.trees(0.05)


def test_texts_that_are_not_read_stay_out_of_the_shuffle(spark):
    rows = [(k, f"word{k} and some words more") for k in range(2000)] + [(None, "a row without doc_id, with words"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    of = chosen_path.sketched(docs, 5).where("doc_id % 100 = 0 AND n > 0 OR doc_id IS NULL")
    sets = of.selectExpr("coalesce(doc_id, -1) AS node", "d", "doc_id AS first").localCheckpoint()
    packed = chosen_path._packed(docs, 5, chosen_path._filter_of(sets))
    assert 21 <= packed.count() < 400  # 21 sets; before, all 2,001 rows with words
    texts = {r.node: zstandard.ZstdDecompressor().decompress(r.packed).decode() for r in chosen_path._texts_of(sets, docs, 5).collect()}
    assert texts == {-1 if d is None else d: t for d, t in rows if d is None or d % 100 == 0}
