"""Cutting texts into pieces that a byte-level BPE tokenizer encodes independently.

The pre-tokenizer's pattern never crosses from a non-space to a space character, so a text may
be cut before every run of white space.  Pieces repeat far more often than texts; each worker
keeps the ids of pieces it has met in a bounded cache.  Ids are kept as bytes (little-endian
unsigned 32-bit integers), so a text's ids are one join.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A run of plain white space with the word after it.
PIECE = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: White space outside PIECE's: a text with any of it is encoded uncut.
ODD_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
#: Stands before every run of plain white space while texts are cut; it is one of ODD_SPACE's.
MARK = "\x1f"
#: Bytes of text that are cut in one go.
SLICE_BYTES = 1 << 24
#: Pieces longer than this are encoded each time they are met.
LONGEST_CACHED = 64


class PieceEncoder:
    """Encodes texts by their pieces.

    ``encode_parts`` gives the id bytes of strings that are encoded on their own; ``special``
    is an added token, recognised anywhere in a text, with its id bytes.  When the cache is full
    it becomes the old one, from which pieces that are met again move over.
    """

    def __init__(self, encode_parts: Callable[[list[str]], list[bytes]], special: tuple[str, bytes],
                 cache_size: int = 250_000):
        self._encode_parts = encode_parts
        self._special, self._special_ids = special
        self._cache: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._cache_size = cache_size

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Id bytes of each text; a null text has none."""
        if len(self._cache) > self._cache_size:
            self._old, self._cache = self._cache, {}
        cache, old = self._cache, self._old
        # per text, its runs between special tokens, each as pieces
        cut = [[PIECE.findall(run) for run in (text or "").split(self._special)] for text in texts]
        met = set().union(*(run for runs in cut for run in runs)).difference(cache)
        if any(map(ODD_SPACE.search, met)):
            cut = [[["".join(run)] if any(map(ODD_SPACE.search, run)) else run for run in runs] for runs in cut]
            met = set().union(*(run for runs in cut for run in runs)).difference(cache)
        new = []
        for p in met:
            if p in old:
                cache[p] = old[p]
            else:
                new.append(p)
        found = dict(zip(new, self._encode_parts(new)))
        long = {p: ids for p, ids in found.items() if len(p) > LONGEST_CACHED}
        cache.update((p, ids) for p, ids in found.items() if len(p) <= LONGEST_CACHED)
        if not long:
            get = cache.__getitem__
        else:
            def get(p):
                return long[p] if len(p) > LONGEST_CACHED else cache[p]
        return [self._special_ids.join([b"".join(map(get, run)) for run in runs]) for runs in cut]


class _OddSpace(Exception):
    pass


class _Pieces(dict):
    """Id bytes of pieces, made as they are asked for; ``old`` holds pieces of before."""

    def __init__(self, encode_part: Callable[[str], bytes], old: dict[str, bytes]):
        super().__init__()
        self._encode_part, self._old = encode_part, old

    def __missing__(self, piece: str) -> bytes:
        ids = self._old.get(piece)
        if ids is None:
            if ODD_SPACE.search(piece):
                raise _OddSpace
            ids = self._encode_part(piece)
        if len(piece) <= LONGEST_CACHED:
            self[piece] = ids
        return ids

    def renewed(self) -> "_Pieces":
        """An empty one with this one as its old one; this one's own old pieces are let go."""
        self._old = {}
        return _Pieces(self._encode_part, self)


class EachPieceEncoder:
    """As PieceEncoder, for an ``encode_part`` that takes one string at a time: no batch of new pieces is gathered first."""

    def __init__(self, encode_part: Callable[[str], bytes], special: tuple[str, bytes], cache_size: int = 250_000):
        self._encode_part = encode_part
        self._special, self._special_ids = special
        self._cache = _Pieces(encode_part, {})
        self._cache_size = cache_size

    def _run(self, run: str) -> bytes:
        try:
            return b"".join(map(self._cache.__getitem__, PIECE.findall(run)))
        except _OddSpace:
            return self._encode_part(run)

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Id bytes of each text; a null text has none."""
        out = []
        for text in texts:
            if len(self._cache) > self._cache_size:
                self._cache = self._cache.renewed()
            out.append(self._special_ids.join(map(self._run, (text or "").split(self._special))))
        return out


class ColumnPieceEncoder:
    """As EachPieceEncoder, for columns of texts: Arrow cuts them, and each distinct piece of a column is looked up once.

    Texts with white space that pieces do not know, or with the special token, are encoded one by one.
    """

    def __init__(self, encode_part: Callable[[str], bytes], special: tuple[str, bytes], cache_size: int = 250_000):
        self._each = EachPieceEncoder(encode_part, special, cache_size)
        self._special = special[0]
        self._cache = _Pieces(encode_part, {})
        self._cache_size = cache_size

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Id bytes of each text; a null text has none."""
        return self.encode_column(pa.array(texts, pa.string()))

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of an Arrow array of strings."""
        texts, out, start = texts.fill_null(""), [], 0
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        while start < len(texts):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            out += self._slice(texts.slice(start, end - start))
            start = end
        return out

    def _slice(self, texts: pa.Array) -> list[bytes]:
        if len(self._cache) > self._cache_size:
            self._cache = self._cache.renewed()
        if pc.any(pc.match_substring_regex(texts, r"[ \t\n\r]{2}|[\t\r]")).as_py():
            marked = pc.replace_substring_regex(texts, r"([ \t\n\r]+)", MARK + r"\1")
        else:  # takes less than a pattern does
            marked = texts
            for one in " \n":
                marked = pc.replace_substring(marked, one, MARK + one)
        cut = pc.split_pattern(marked, MARK)
        first = cut.offsets.to_numpy()
        pieces = cut.flatten().dictionary_encode()
        cache, special, found, odd = self._cache, self._special, [], []
        # one string for all is made sooner than one for each
        named = pa.ListArray.from_arrays(pa.array([0, len(pieces.dictionary)], pa.int32()), pieces.dictionary)
        for k, piece in enumerate(pc.binary_join(named, MARK)[0].as_py().split(MARK)):
            try:
                if special in piece:
                    raise _OddSpace
                found.append(cache[piece] if piece else b"")
            except _OddSpace:
                odd.append(k)
                found.append(b"")
        joined = pa.array(found, pa.large_binary()).take(pieces.indices)
        data = joined.buffers()[2]
        at = np.frombuffer(joined.buffers()[1], np.int64)[first].tolist()
        out = [data[a:b].to_pybytes() for a, b in zip(at, at[1:])]
        alone = pc.match_substring(texts, MARK).to_numpy(zero_copy_only=False)
        if odd:
            places = np.flatnonzero(np.isin(pieces.indices.to_numpy(), odd))
            alone[np.searchsorted(first, places, side="right") - 1] = True
        for k in np.flatnonzero(alone).tolist():
            out[k], = self._each.encode([texts[k].as_py()])
        return out
