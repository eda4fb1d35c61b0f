"""BPE encoding and decoding (6): speculate, verify, repair.

Greedy longest match proposes the tokens of a word.  A proposal is the true encoding if every
adjacent pair of its tokens is compatible, that is, merging the two tokens' bytes together
gives just these two tokens.  All pairs of a batch are tested at once with numpy; only words
with a failing pair go through exact merging.

Why pairs suffice: merges are applied in order of rank, and a merge's rank is higher than that
of its parts.  While a token grows, its last part runs up its right spine and its first part up
its left spine; a part lives until its parent's rank.  A merge across a border between tokens
a and b would need a part x of a's right spine and y of b's left spine with a merge (x, y) that
comes before x's and y's parents (at equal rank the leftmost pair merges first).

Defined results: null and empty texts have no ids and decode to the empty text.  Input columns
are carried along; the columns ``ids`` and ``decoded`` replace input columns of that name.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.common import documents, small_batches
from dossier.llm.pieces import PieceEncoder

#: Texts that one numpy round takes together.
TEXTS_A_ROUND = 256
NEVER = 1 << 40
#: Bytes of a word beyond which merging uses a heap.
LONG_WORD = 48
#: Words that a worker remembers.
KNOWN_WORDS = 600_000
#: A plain piece: letters, then marks; the pattern parts them just there.
SIMPLE = re.compile(r"( ?[A-Za-z]+)([.,;:!?]*)\Z")


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Bpe:
    """The merges of a byte-level BPE vocabulary as numpy tables."""

    def __init__(self, path: str):
        import public_tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_of_char()
        vocab = {bytes(chars[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        added = spec["added_tokens"][0]
        self.special = added["content"]
        self.special_id = added["id"]
        self.word = regex.compile(public_tokenizers.PATTERN)
        size = max([*vocab.values(), self.special_id]) + 1
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = token
        self.bytes_of[self.special_id] = self.special.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []  # token by the rank of its merge
        left, right = np.full(size, -1), np.full(size, -1)
        made_at = np.full(size, -1, dtype=np.int64)
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = (vocab[bytes(chars[c] for c in part)] for part in
                    (merge.split(" ") if isinstance(merge, str) else merge))
            token = vocab[self.bytes_of[a] + self.bytes_of[b]]
            self.rank[a, b] = rank
            self.made.append(token)
            left[token], right[token], made_at[token] = a, b, rank
        self._shift = np.int64(size.bit_length())
        keys = np.array([(a << int(self._shift)) | b for a, b in self.rank], dtype=np.int64)
        order = np.argsort(keys)
        self._keys = keys[order]
        self._ranks = np.array(list(self.rank.values()), dtype=np.int64)[order]
        self._right_spine, self._left_spine = self._spine(right, made_at), self._spine(left, made_at)
        whole = self._whole(left, right, made_at)
        self.vocab = {t: i for t, i in vocab.items() if whole[i]}
        # longest token by its first two bytes
        self.reach: dict[bytes, int] = {}
        for t in self.vocab:
            self.reach[t[:2]] = max(len(t), self.reach.get(t[:2], 0))
        self._known: dict[str, bytes] = {}

    @staticmethod
    def _spine(child: np.ndarray, made_at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per depth: the part of each token on its spine (-1: none), and the rank at which it ends."""
        part, ends = np.arange(len(child)), np.full(len(child), NEVER, dtype=np.int64)
        out = []
        while (part >= 0).any():
            out.append((part, ends))
            ends = np.where(part >= 0, made_at[part], NEVER)
            part = np.where(part >= 0, child[part], -1)
        return out

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << self._shift) | b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | int = NEVER) -> np.ndarray:
        """Whether merging the bytes of a and b leaves a and b, up to the rank ``until``."""
        good = np.ones(len(a), dtype=bool)
        until = np.broadcast_to(until, len(a))
        for parts, ends in self._right_spine:
            for firsts, stops in self._left_spine:
                rows = np.flatnonzero(good & (parts[a] >= 0) & (firsts[b] >= 0))
                if not len(rows):
                    break
                x, y, most = a[rows], b[rows], until[rows]
                rank = self._merge_rank(parts[x], firsts[y])
                crossed = (rank < np.minimum(ends[x], most)) & (rank <= stops[y]) & (rank < most)
                good[rows[crossed]] = False
        return good

    def _whole(self, left: np.ndarray, right: np.ndarray, made_at: np.ndarray) -> np.ndarray:
        """Tokens whose own bytes encode to themselves; others are never proposed."""
        whole = np.ones(len(left), dtype=bool)
        made = np.flatnonzero(made_at >= 0)
        whole[made] = self.compatible(left[made], right[made], made_at[made])
        for i in made[np.argsort(made_at[made])]:
            whole[i] &= whole[left[i]] and whole[right[i]]
        whole[self.special_id] = False
        return whole

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, vocab, reach = [], 0, self.vocab, self.reach
        while at < len(word):
            for end in range(min(len(word), at + reach.get(word[at:at + 2], 1)), at, -1):
                token = vocab.get(word[at:end])
                if token is not None:
                    out.append(token)
                    at = end
                    break
        return out

    def merge(self, word: bytes) -> list[int]:
        """Exact merging, for words whose proposal failed: always the leftmost pair of least rank."""
        token = [self.vocab[bytes([b])] for b in word]
        return self._merge_long(token) if len(token) > LONG_WORD else self._merge_short(token)

    def _merge_short(self, token: list[int]) -> list[int]:
        """Only the two pairs beside a merge are looked up again; equal ranks are equal pairs."""
        get, made = self.rank.get, self.made
        pairs = [get(p, NEVER) for p in zip(token, token[1:])]
        while pairs and (best := min(pairs)) != NEVER:
            i = pairs.index(best)
            token[i:i + 2] = [made[best]]
            del pairs[i]
            if i:
                pairs[i - 1] = get((token[i - 1], token[i]), NEVER)
            if i < len(pairs):
                pairs[i] = get((token[i], token[i + 1]), NEVER)
        return token

    def _merge_long(self, token: list[int]) -> list[int]:
        """Pairs wait in a heap, parts are a linked list, so n bytes take n log n steps."""
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.rank[p], i, p) for i in range(n - 1) if (p := (token[i], token[i + 1])) in self.rank]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if token[i] != pair[0] or j >= n or token[j] != pair[1]:
                continue  # one of the two has merged meanwhile
            token[i], token[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (p := (token[k], token[after[k]])) in self.rank:
                    heapq.heappush(heap, (self.rank[p], k, p))
        return [t for t in token if t >= 0]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Id bytes of each word: propose, verify all adjacent pairs at once, repair."""
        proposed = [self.propose(w) for w in words]
        flat = np.fromiter((t for p in proposed for t in p), dtype=np.int64)
        of = np.repeat(np.arange(len(words)), [len(p) for p in proposed])
        inner = np.flatnonzero(of[1:] == of[:-1])
        pairs, which = np.unique((flat[inner] << self._shift) | flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs >> self._shift, pairs & ((1 << int(self._shift)) - 1))
        for k in np.unique(of[inner[~good[which]]]):
            proposed[k] = self.merge(words[k])
        return [array("I", p).tobytes() for p in proposed]

    def _words(self, part: str) -> list[str]:
        simple = SIMPLE.match(part)
        if simple:
            return [x for x in simple.groups() if x]
        return self.word.findall(part)

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """Id bytes of strings that are encoded on their own."""
        cut = [self._words(p) for p in parts]
        if len(self._known) > KNOWN_WORDS:
            self._known.clear()
        new = list(set().union(*cut).difference(self._known))
        self._known.update(zip(new, self.encode_words([w.encode() for w in new])))
        return [b"".join(map(self._known.__getitem__, ws)) for ws in cut]

    def decode(self, ids: bytes) -> str:
        """The text of id bytes; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple[Bpe, PieceEncoder]:
    """Once per worker."""
    bpe = Bpe(path)
    special = (bpe.special, np.array([bpe.special_id], dtype="<u4").tobytes())
    return bpe, PieceEncoder(bpe.encode_parts, special)


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` with ids (binary: little-endian unsigned 32-bit) and decoded (text of these ids)."""
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c not in ("ids", "decoded")]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("ids"))  # the text to encode, last
    schema = docs.select(*keep, F.lit(b"").alias("ids"), F.lit("").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = _loaded(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_A_ROUND):
                part = batch.slice(at, TEXTS_A_ROUND)
                ids = encoder.encode(part.column(part.num_columns - 1).to_pylist())
                columns = [*part.columns[:-1], pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids", "decoded"])

    return docs.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return digests(encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json")))
