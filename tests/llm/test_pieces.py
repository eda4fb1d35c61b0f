"""The caches of the BPE encoders (1, 6): every piece is encoded as the library does, and once while it is remembered."""

from __future__ import annotations

import random
from itertools import product

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from dossier.llm import bpe, token_store
from dossier.llm.pieces import EachPieceEncoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_words_stay_known_beyond_200_000():
    b = bpe.Bpe(VOCABULARY)
    made, inner = [], b.encode_words
    b.encode_words = lambda words: made.extend(words) or inner(words)
    words = [" " + "".join(x) for x in product("abcdefghijklmnopqrstuvwxyz", repeat=4)][:260_000]
    for _ in range(2):
        for at in range(0, len(words), 20_000):
            b.encode_parts(words[at:at + 20_000])
    assert len(made) == len(words)


def test_pieces_are_encoded_as_they_are_met():
    made = []
    encoder = EachPieceEncoder(lambda x: made.append(x) or x.encode().hex().encode() + b",", ("<s>", b"!"), cache_size=3)
    assert encoder.encode([None, "", "a b a", "<s>a b<s>"]) == [b"", b"", b"61,2062,2061,", b"!61,2062,!"]
    assert made == ["a", " b", " a"]
    # a full cache becomes the old one, whose pieces move over; those of the one before are let go
    assert encoder.encode([" c d", "a b", " e f g", " c"]) == [b"2063,2064,", b"61,2062,", b"2065,2066,2067,", b"2063,"]
    assert made.count(" b") == 1
    made.clear()
    # a text with white space that pieces do not know is encoded uncut, each time
    assert encoder.encode(["a\x0bb c"] * 2) == ["a\x0bb c".encode().hex().encode() + b","] * 2
    assert made.count("a\x0bb c") == 2


def test_both_encoders_agree_with_the_library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(5)
    parts = ["the", " ", "  ", "\n", "\t", "\x0b", "\x1c", "　", "\xa0", "naïve", "Привет", "a'b", "it's", "...", "!?", "12345", "日本",
             "<|endoftext|>", "\x00", "\x7f", "x" * 70, "erinreheingble", "😀", "é", ",", "_"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(2000)] + [None]
    want = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert token_store._encoder(VOCABULARY).encode(texts) == want
    assert bpe._loaded(VOCABULARY)[1].encode(texts) == want
