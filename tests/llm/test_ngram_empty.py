"""Empty sets take part in no band of the n-gram join and have no index rows."""

import numpy as np
import pytest

from dossier.llm import ngram_join


@pytest.mark.parametrize("words, p", [(4, 85), (5, 80)])
def test_empty_texts_have_no_index_rows(words, p):
    bands, shingler = ngram_join.Bands(p, 100), ngram_join.Shingler(words)
    assert bands.of(0) == []
    sets = [shingler(t) for t in (b"", b" \n\t ", " ".join(f"w{k}" for k in range(60)).encode(), b"")]
    assert [len(s) for s in sets[:2]] == [0, 0] and bands.of(len(sets[2]))
    for neighbourhoods in (False, True):
        bucket, which = ngram_join._buckets(sets, bands, neighbourhoods)
        assert len(bucket) and set(which.tolist()) == {2}
        bucket, which = ngram_join._buckets([sets[0], sets[1]], bands, neighbourhoods)
        assert len(bucket) == len(which) == 0
        assert np.array_equal(*(ngram_join._buckets(x, bands, neighbourhoods)[0] for x in (sets, sets[2:3])))
