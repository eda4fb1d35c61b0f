"""Texts are cut as columns by Arrow: as one by one, and each distinct piece is looked up once."""

from __future__ import annotations

from dossier.llm import pieces
from dossier.llm.pieces import ColumnPieceEncoder, EachPieceEncoder


def test_a_column_looks_a_piece_up_once():
    made = []
    encoder = ColumnPieceEncoder(lambda x: made.append(x) or x.encode().hex().encode() + b",", ("<s>", b"!"), cache_size=3)
    one_by_one = EachPieceEncoder(lambda x: x.encode().hex().encode() + b",", ("<s>", b"!"), cache_size=3)
    texts = [None, "", "a b a b", " a\nb", "a  b", "a \n b ", "<s>a b<s>", "a\x1fb c", "a\tb\r\nc", "\n\n"]
    assert encoder.encode(texts[:4]) == one_by_one.encode(texts[:4])
    assert made.count(" b") == 1 and made.count(" a") == 1
    assert encoder.encode(texts) == one_by_one.encode(texts)
    assert encoder.encode([]) == []
    pieces.SLICE_BYTES, before = 4, pieces.SLICE_BYTES  # a text on its own, then several
    try:
        assert encoder.encode(texts) == one_by_one.encode(texts)
    finally:
        pieces.SLICE_BYTES = before
