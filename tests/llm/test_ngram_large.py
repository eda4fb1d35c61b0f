"""The n-gram join against brute force on sets of several hundred shingles, and the cost of its index."""

import numpy as np
import pytest

from dossier.llm import ngram_join
from tests.llm.test_chosen_path import brute


def edited(seed, length, copies):
    """Copies of two texts of ``length`` words, with up to ``length`` / 25 words changed."""
    rng, out = np.random.default_rng(seed), []
    for g in range(2):
        base = [f"v{g}_{k}" for k in range(length)]
        for _ in range(copies):
            words = list(base)
            for at in rng.integers(0, length, rng.integers(0, length // 25)):
                words[at] = f"x{rng.integers(0, 400)}"
            out.append(" ".join(words))
    return out


@pytest.mark.parametrize("words, p, length", [(4, 85, 260), (5, 80, 420)])
def test_large_sets_are_brute_force(spark, words, p, length):
    rows = list(enumerate(edited(p, length, 12) + edited(p + 1, length // 2, 6)))
    want = [(d, n, root) for d, n, root, _ in brute(rows, words, p)]
    assert len({root for _, _, root in want}) < len(rows) - 6 and max(n for _, n, _ in want) > 250
    got = ngram_join.groups(spark, spark.createDataFrame(rows, "doc_id long, text string"), words, p, 100)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("p", [80, 85])
def test_a_band_takes_the_scheme_with_fewer_rows(p):
    bands = ngram_join.Bands(p, 100)
    for lo, plain, near in list(zip(bands.lo.tolist(), bands.plain, bands.near))[8:60]:
        assert 0 < plain < lo + near and plain < 0.9 * lo  # fewer index rows than shingles


def test_buckets_of_some_hundreds_need_no_further_index(spark, monkeypatch):
    """Sets that share a passage meet in buckets of over 64; their index rows must not jump at that size."""
    rng, made, index = np.random.default_rng(3), [], ngram_join._signatures
    monkeypatch.setattr(ngram_join, "_signatures", lambda *a: made.append(a[3]) or index(*a))
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [f"{passage} " + " ".join(f"o{x}" for x in rng.integers(0, 10**6, 8)) for _ in range(300)]
    rows = list(enumerate(texts + [t + " end" for t in texts[:6]]))
    want = [(d, n, root) for d, n, root, _ in brute(rows, 4, 85)]
    assert len({root for _, _, root in want}) == 300
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for many, schemes in ((ngram_join.MANY, [False]), (16, [False, True])):
        made.clear()
        got = ngram_join.groups(spark, df, 4, 85, 100, many)
        assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == sorted(want, key=str)
        assert made == schemes
