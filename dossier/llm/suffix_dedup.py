"""Suffix-array dedup (3) by a run-length index of the repetitive part of a corpus.

Which bytes go: every byte covered by a string of ``span`` bytes that also starts anywhere else,
in the same document or another.  Matches never cross documents.

1. Anchors.  Among the k-byte substrings inside a window of ``span`` bytes, the one with the
   least hash (leftmost if equal) is the window's anchor.  It depends on the window's bytes
   alone, so equal windows have equal anchors.  Neighbouring windows with one anchor form a
   context, the bytes they cover.  About 140 new windows share a context.
2. Contexts with an anchor that occurs once are dropped.  Equal contexts are counted, not
   compared; all windows of a context that occurs twice repeat.  What is left, one copy of
   each context whose anchor has several, is the repetitive part of the corpus.
3. Index.  Contexts are dealt out by anchor in shards of a bounded size.  A shard sorts the
   suffixes of its contexts and keeps, of their Burrows-Wheeler transform, the runs: sampled at
   the head and the end of each run are the suffix's place and its longest common prefix with
   the suffix before and after it.
4. Matching statistics are streamed over the text.  At a sampled place they are known; at any
   other place they are one less than at the place before, since equal letters before
   neighbouring suffixes keep them neighbours.  Windows with at least ``span`` are marked.
5. Marks go back to all occurrences of the context and are joined into runs per document.

Hot anchors: a key whose contexts exceed HOT_BYTES is split by what stands left or right of
what all its windows share, until groups are small or equal; equal parts are counted again.

Defined results: null counts as the empty text.  Texts shorter than ``span`` bytes lose nothing.
Repeated rows are occurrences like any others.  Rows are told apart by doc_id and a hash of the
text, so a repeated or null doc_id is no problem.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.common import documents, small_batches, written
from dossier.llm.ngram_join import _mix

SPAN = 400
#: Bytes of an anchor: a third of the span keeps anchors selective and contexts short.
ANCHOR_SHARE = 3
#: Bytes of contexts in one shard, about, and beyond which a key is split.
SHARD_BYTES, HOT_BYTES = 1 << 20, 16 << 20
#: Windows that anchors are sought in at a time; bounds memory for very long texts.
STEP = 1 << 22
PLACE_BITS = np.uint64(24)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


class Anchors:
    """Finds anchors with tables of powers that grow with the longest text met."""

    def __init__(self, span: int):
        self.span, self.k = span, max(1, span // ANCHOR_SHARE)
        self._power = np.ones(1, np.uint64)
        self._inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._power) >= n:
            return
        n = max(n, 2 * len(self._power))
        steps = np.full(n, BASE)
        steps[0] = 1
        self._power = np.multiply.accumulate(steps)
        back = np.uint64(pow(int(BASE), -1, 1 << 64))
        steps[1:] = back
        self._inverse = np.multiply.accumulate(steps)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """Of every k-byte substring."""
        n = len(data)
        self._grow(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._power[:n], out=sums[1:])
        return _mix((sums[self.k:] - sums[:-self.k]) * self._inverse[:n - self.k + 1])

    def __call__(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, place, first window, last window) of the anchors, by window."""
        found = [self._within(data[at:at + STEP + self.span - 1], at)
                 for at in range(0, max(0, len(data) - self.span + 1), STEP)]
        if not found:
            return (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)
        return tuple(np.concatenate(x) for x in zip(*found))

    def _within(self, data: np.ndarray, at: int):
        h = self._hashes(data)
        w = self.span - self.k + 1
        windows = len(data) - self.span + 1
        key = np.full(-(-len(h) // w) * w, ~np.uint64(0))
        key[:len(h)] = (h >> PLACE_BITS << PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
        blocks = key.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:windows], ahead[w - 1:w - 1 + windows])
        place = (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        last = np.concatenate([first[1:] - 1, [windows - 1]])
        return h[place[first]], place[first] + at, first + at, last + at


def _ranked(key: np.ndarray, limit: int) -> np.ndarray:
    """Dense ranks of keys below ``limit``; where key and place fit into 64 bits they are sorted as one."""
    n = len(key)
    bits = n.bit_length()
    if limit << bits <= 1 << 63:
        both = np.sort((key << bits) | np.arange(n))
        order, held = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(key)
        held = key[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(held[1:] != held[:-1])])
    return rank


class RunIndex:
    """The run-length index of some contexts."""

    def __init__(self, contexts: list[bytes]):
        self._data = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int64)
        lengths = np.array([len(c) for c in contexts])
        self.starts = np.cumsum(lengths) - lengths
        n = len(self._data)
        here = np.arange(n)
        context = np.repeat(np.arange(len(contexts)), lengths)
        self._end = np.repeat(self.starts + lengths, lengths)
        self._ranks = self._sorted(here, int(lengths.max()))
        order = np.argsort(self._ranks[-1][1], kind="stable")
        # the letter before each suffix; contexts begin with a letter of their own
        before = np.where(here == self.starts[context], 256 + context, np.roll(self._data, 1))[order]
        changes = before[1:] != before[:-1]
        heads, ends = np.flatnonzero(changes) + 1, np.flatnonzero(changes)
        self._samples = []  # of run heads with the suffix before, of run ends with the one after
        for rows, other, border in ((heads, heads - 1, order[:1]), (ends, ends + 1, order[-1:])):
            at = np.concatenate([border, order[rows]])
            self._samples.append((at, np.concatenate([[0], self._common(order[rows], order[other])])))

    def _sorted(self, here: np.ndarray, longest: int) -> list[tuple[int, np.ndarray]]:
        """Ranks of all suffixes by their first 7, 14, 28, ... bytes; what ends first is less."""
        n = len(here)
        key = np.zeros(n, np.int64)
        for j in range(7):
            inside = here + j < self._end
            key = (key << 9) | np.where(inside, self._data[np.minimum(here + j, n - 1)] + 1, 0)
        depth, rank = 7, _ranked(key, 1 << 63)
        ranks = [(depth, rank)]
        while depth < longest and int(rank.max()) < n - 1:
            after = np.where(here + depth < self._end, rank[np.minimum(here + depth, n - 1)] + 1, 0)
            rank = _ranked(rank * np.int64(n + 1) + after, (n + 1) ** 2)
            depth *= 2
            ranks.append((depth, rank))
        return ranks

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefix of the suffixes at a and at b."""
        n, most = len(self._data), np.minimum(self._end[a] - a, self._end[b] - b)
        found = np.zeros(len(a), np.int64)
        for depth, rank in reversed(self._ranks):
            x, y = np.minimum(a + found, n - 1), np.minimum(b + found, n - 1)
            same = (found < most) & (rank[x] == rank[y])
            found = np.minimum(found + np.where(same, depth, 0), most)
        for _ in range(6):
            x, y = np.minimum(a + found, n - 1), np.minimum(b + found, n - 1)
            found += (found < most) & (self._data[x] == self._data[y])
        return found

    def matching_statistics(self) -> np.ndarray:
        """At every place, the longest string from there that also starts elsewhere."""
        here, best = np.arange(len(self._data)), None
        for at, common in self._samples:
            known = np.full(len(here), -1)
            known[at] = common
            source = np.maximum.accumulate(np.where(known >= 0, here, 0))
            streamed = known[source] - (here - source)
            best = streamed if best is None else np.maximum(best, streamed)
        return best


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]


def _occurrences(docs: DataFrame, span: int) -> DataFrame:
    """anchor, c (hash of the context), d and t (the row), first (window) and windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(span)
        for batch in batches:
            out = [[] for _ in range(6)]
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = text.encode()
                h, _, first, last = anchors(np.frombuffer(data, np.uint8))
                t = _signed(data)
                out[0].append(h.view(np.int64))
                out[1].append(np.array([_signed(data[a:b + span]) for a, b in zip(first, last)], np.int64))
                out[2].append(np.full(len(h), d, np.int64))
                out[3].append(np.full(len(h), t, np.int64))
                out[4].append(first)
                out[5].append(last - first + 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out],
                                             names=["anchor", "c", "d", "t", "first", "windows"])

    return docs.mapInArrow(run, "anchor long, c long, d long, t long, first long, windows long")


def _signed(data: bytes, seed: int = 0) -> int:
    h = xxhash.xxh3_64_intdigest(data, seed)
    return h - (1 << 64) if h >> 63 else h


def _packed(docs: DataFrame) -> DataFrame:
    """The rows with their bytes compressed, for the shuffles that bring ranges to texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            data = [t.encode() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(_signed, data), pa.int64()), pa.array(map(pack, data), pa.binary())],
                names=["d", "t", "packed"])

    return docs.mapInArrow(run, "d long, t long, packed binary")


PIECE = "anchor long, c long, off long, key long, a long, b long, data binary"


def _contexts(wanted: DataFrame, packed: DataFrame, span: int) -> DataFrame:
    """One piece (see ``_marks``) for each wanted context, cut from the document that holds it."""
    of_doc = wanted.groupBy("d", "t").agg(F.collect_list(F.struct("anchor", "c", "first", "windows")).alias("cuts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for one in (batch.slice(k, 1) for batch in batches for k in range(batch.num_rows)):
            data = unpack(one.column(1)[0].as_py())
            rows = []
            for cut in one.column(0)[0].as_py():
                piece = data[cut["first"]:cut["first"] + cut["windows"] - 1 + span]
                rows.append((cut["anchor"], cut["c"], 0, cut["anchor"], -1, -1, piece))
            yield _batch(rows)

    return (packed.join(of_doc, ["d", "t"]).select("cuts", "packed").mapInArrow(run, PIECE)
            .dropDuplicates(["anchor", "c"]))  # repeated rows cut the same


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 6 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                      names=[x.split(" ")[0] for x in PIECE.split(", ")])


def _split(pieces: DataFrame, span: int) -> DataFrame:
    """Two smaller pieces for each: windows that reach far to the left, or else to the right, of [a, b).

    All windows of a piece hold its bytes [a, b); those of a part also hold what its new key
    hashes, so equal windows stay together.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(span)
        for batch in batches:
            rows = []
            for key, h, a, b, data in zip(*(batch.column(x).to_pylist() for x in ("key", "h", "a", "b", "data"))):
                if a < 0:  # a whole context: its windows share the anchor
                    a = int(anchors(np.frombuffer(data, np.uint8))[1][0])
                    b = a + anchors.k
                windows, slack = len(data) - span + 1, span - (b - a)
                q = (slack + 1) // 2
                left, right = min(windows - 1, a - q), max(0, a - q + 1)
                if left >= 0:
                    rows.append((key, h, 0, _signed(data[a - q:b], key & 0xFFFFFFFF), a - q, b, data[:left + span]))
                if right < windows:
                    to = min(b + slack - q + 1, a + span)
                    rows.append((key, h, right, _signed(data[a:to], ~key & 0xFFFFFFFF), a - right, to - right, data[right:]))
            if rows:
                yield _batch(rows)

    return pieces.select("key", "h", "a", "b", "data").mapInArrow(run, PIECE)


def _indexed(pieces: DataFrame, span: int, shards: int) -> DataFrame:
    """(key, h, start, stop): the repeated windows of pieces that lie in one shard."""
    def run(held: pa.Table) -> pa.Table:
        keys, hashes, data = (held.column(x).to_pylist() for x in ("key", "h", "data"))
        index = RunIndex(data)
        repeats = index.matching_statistics() >= span
        rows = [(k, h, a, b) for k, h, x, at in zip(keys, hashes, data, index.starts.tolist())
                for a, b in _runs(repeats[at:at + len(x) - span + 1])]
        return pa.table([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["key", "h", "start", "stop"])

    return (pieces.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "key", "h", "data")
            .groupBy("shard").applyInArrow(run, "key long, h long, start long, stop long"))


def _marks(spark: SparkSession, pieces: DataFrame, span: int, shard_bytes: int, hot_bytes: int) -> DataFrame:
    """(anchor, c, start, stop): windows of a context that repeat.

    A piece is a part ``data`` of context (anchor, c) from its window ``off`` on; equal windows of
    two pieces only occur under one ``key``; all windows of a piece hold its bytes [a, b); of a
    whole context, where a is -1, these are the anchor's.
    """
    pieces = written(spark, pieces.withColumn("h", F.xxhash64("data")), "suffix-pieces")
    same = pieces.groupBy("key", "h").agg(F.count(F.lit(1)).alias("n"), F.max("a").alias("a"), F.max("b").alias("b"),
                                          F.max("data").alias("data"))
    of_key = same.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.sum(F.octet_length("data")).alias("bytes"))
    same = written(spark, same.join(of_key, "key"), "suffix-distinct")
    windows = F.octet_length("data").cast("long") - span
    found = same.where("n > 1").select("key", "h", F.lit(0).cast("long").alias("start"), windows.alias("stop"))
    several = same.where("k > 1")
    cold, hot = several.where(F.col("bytes") <= hot_bytes), several.where(F.col("bytes") > hot_bytes)
    total = cold.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    if total:
        found = found.unionByName(_indexed(cold, span, -(-total // shard_bytes)))
    if not hot.isEmpty():
        found = found.unionByName(_marks(spark, _split(hot, span), span, shard_bytes, hot_bytes)
                                  .withColumnsRenamed({"anchor": "key", "c": "h"}))
    found = written(spark, found.distinct(), "suffix-found")
    return pieces.join(found, ["key", "h"]).select(
        "anchor", "c", (F.col("off") + F.col("start")).alias("start"), (F.col("off") + F.col("stop")).alias("stop"))


def cleaned(spark: SparkSession, docs: DataFrame, span: int = SPAN, shard_bytes: int = SHARD_BYTES,
            hot_bytes: int = HOT_BYTES) -> DataFrame:
    """doc_id, n_bytes, spans (start and end bytes of what goes) and kept (the bytes that stay)."""
    small_batches(spark)
    none = F.lit(-(1 << 63)).cast("long")  # stands for a null doc_id inside
    rows = docs.select(F.coalesce("doc_id", none).alias("d"), F.coalesce("text", F.lit("")).alias("text"))
    seen = _occurrences(rows, span)
    twice = (seen.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
             .where("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("several")))
    twice = written(spark, twice, "suffix-anchors")  # so that the join may split a hot anchor
    seen = written(spark, seen.join(twice, "anchor"), "suffix-occurrences")
    distinct = written(spark, seen.groupBy("anchor", "c").agg(
        F.count(F.lit(1)).alias("copies"), F.max("several").alias("several"), F.max("windows").alias("windows"),
        F.min(F.struct("d", "t", "first")).alias("at")), "suffix-contexts")
    packed = _packed(rows)
    wanted = distinct.where("several").select("anchor", "c", "windows", "at.*")
    marks = _marks(spark, _contexts(wanted, packed, span), span, shard_bytes, hot_bytes)
    marks = marks.unionByName(distinct.where("copies > 1").select(
        "anchor", "c", F.lit(0).cast("long").alias("start"), (F.col("windows") - 1).alias("stop")))
    ranges = (seen.join(marks, ["anchor", "c"]).groupBy("d", "t").agg(F.collect_set(F.struct(
        (F.col("first") + F.col("start")).alias("a"), (F.col("first") + F.col("stop") + span).alias("b"))).alias("ranges")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for d, data, found in zip(*(c.to_pylist() for c in batch.columns)):
                data = unpack(data)
                spans: list[list[int]] = []
                for r in sorted(found or [], key=lambda r: r["a"]):
                    if spans and r["a"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r["b"])
                    else:
                        spans.append([r["a"], r["b"]])
                edges = [0, *(x for s in spans for x in s), len(data)]
                out.append((d, len(data), [{"start": a, "end": b} for a, b in spans],
                            b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))))
            types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                                             names=["d", "n_bytes", "spans", "kept"])

    done = packed.join(ranges, ["d", "t"], "left").select("d", "packed", "ranges").mapInArrow(
        run, "d long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return done.select(F.when(F.col("d") != none, F.col("d")).alias("doc_id"), "n_bytes", "spans", "kept")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
