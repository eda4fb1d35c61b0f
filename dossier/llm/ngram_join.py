"""N-gram Jaccard join (9) by universe partition and pigeonhole.

A document is the set of its distinct word shingles.  Two sets r and s with Jaccard similarity
of at least p / q differ in at most H = (|r| + |s|)(q - p) / (q + p) shingles.

* Sizes fall into bands [lo, lo * q / p]; partners of a set lie in its own band or the next, so
  a set takes part in both.  H is fixed per band.
* Segments.  A band hashes the universe of shingles into m segments.  With m = H + 1 + g, at
  least 1 + g segments are equal in both sets, so the hash of each segment's subset is indexed.
  Empty subsets are left out; a set with more than g of them indexes these too, so no pair is
  lost.
* One-deletion neighbourhoods.  A segment pair that differs in one shingle meets if both index
  the subset and all subsets with one shingle less.  Then H can be spread two per segment, and
  m = (H + 1) / 2 segments, twice as long, are enough.
* Allocation by cost.  A band takes the scheme with fewer index rows for a set: plain segments
  have one row each, neighbourhoods one for each shingle and segment.  What small segments cost
  by being shared by chance is measured: in a bucket of up to MANY members a bound on their
  difference is computed for a member with all others, which costs less than the member's
  neighbourhoods; documents in a larger bucket whose members are not all in one component get
  neighbourhoods besides, and pairs that meet in such buckets only are found by these.
  A band also has a few segments more than needed, and every set leaves out as many of its
  costliest buckets, those with the most members.
* Verification is exact: every candidate pair compares whole shingle sets.

Documents with equal sets are one node.  Every bucket is first compared with its leader, the
member that shares most buckets, and links are contracted; only members that are still in
different components meet as pairs, and of these only pairs that a bound on their difference
does not rule out become rows.  So a group of n near copies costs n comparisons, and no link
between components is lost.

Defined results: words are runs of ``[^\\x20\\x09-\\x0D]`` of the text with A-Z lower-cased.  With
fewer words than a shingle has, the whole sequence is the one shingle.  Null and blank texts
have an empty set, are linked with nothing and stay on their own.  Rows with one doc_id must
have one text to be told apart; repeated rows are one node.  Rows without doc_id are linked with
nothing and have no component.  Shingles are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.llm.common import documents, settled, small_batches, written
from dossier.llm.components import components

#: Members of a bucket beyond which its documents get neighbourhoods: several hundred index rows each, which
#: cost about as much as a bound for this many others.
MANY = 2048
#: Members of a bucket beyond which they meet a third leader before they are compared with each other.
SEVERAL = 64
#: Parts of the universe whose counts are compared before a pair is made, and the largest count told apart.
CELLS, MOST_IN_CELL = 256, 127
#: Members of a bucket that are compared with each other in one go.
BLOCK = 2048
CACHED_WORDS = 200_000
SEED = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers (the splitmix64 finaliser; its constants are fixed values)."""
    x = x.astype(np.uint64, copy=True)
    x += SEED
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Bands:
    """Size bands and their segments for the similarity p / q."""

    def __init__(self, p: int, q: int, longest: int = 1 << 28):
        self.p, self.q = p, q
        lo, self.lo, self.differ, self.plain, self.spare, self.skipped, self.near = 1, [], [], [], [], [], []
        while lo < longest:
            hi = max(lo, lo * q // p)
            most = 2 * hi * (q - p) // (q + p)
            skipped = 1 + most // 6  # costly buckets that a set may leave out
            spare = 1 + math.ceil(3 * (most + skipped) * math.exp(-lo / (most + skipped + 1)))
            m = most + 1 + spare + skipped
            self.lo.append(lo)
            self.differ.append(most)
            self.spare.append(spare)
            near = (most + 2) // 2 + (1 if most > 3 else 0)
            self.plain.append(m if m < lo + near else 0)  # 0: neighbourhoods
            self.skipped.append(skipped)
            self.near.append(near)
            lo = hi + 1
        self.lo = np.array(self.lo)

    def skip(self, scheme: int) -> int:
        """Costly buckets of a set that may be left out in this scheme (band, +128: neighbourhoods).

        A similar pair shares at least one bucket more than that.  If both sets leave out their
        costliest ones by one order, the cheapest that they share stays.
        """
        band = scheme % 128
        if band >= len(self.differ):
            return 0
        if scheme < 128 and self.plain[band]:
            return self.skipped[band]
        return 1 if self.differ[band] > 3 else 0

    def of(self, size: int) -> list[int]:
        """The bands that a set takes part in; none if it is empty or only equal sets can be similar to it."""
        if size == 0:
            return []
        k = int(np.searchsorted(self.lo, size, side="right")) - 1
        both = [k, k + 1] if size * self.q // self.p >= self.lo[k + 1] else [k]
        return [b for b in both if self.differ[b] > 0]


class _Hashes(dict):
    """Hashes of words, made as they are asked for."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


class Shingler:
    """Shingle hashes of texts, with a bounded cache of word hashes."""

    def __init__(self, words: int):
        self.words = words
        self._factors = _mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
        self._cache = _Hashes()

    def __call__(self, text: bytes) -> np.ndarray:
        """The sorted distinct shingle hashes of a text."""
        words = text.lower().split()  # of bytes: lower-cases A-Z and splits at ASCII white space only
        cache, n = self._cache, len(words)
        if len(cache) > CACHED_WORDS:
            cache.clear()
        ids = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=n)
        if n < self.words:
            whole = (ids * self._factors[:n]).sum(dtype=np.uint64) + np.uint64(n)
            return _mix(np.array([whole], dtype=np.uint64))[:min(n, 1)]
        total = np.zeros(n - self.words + 1, dtype=np.uint64)
        for j, factor in enumerate(self._factors):
            total += ids[j:n - self.words + 1 + j] * factor
        total = _mix(total)
        total.sort()
        return total[np.concatenate([[True], total[1:] != total[:-1]])]


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set, as two signed numbers."""
    whole = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(whole[8:], "little", signed=True)


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (set size), d1 and d2 (digest of the set) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler((t or "").encode()) for t in batch.column(1).to_pylist()]
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([a for a, _ in digests], pa.int64()), pa.array([b for _, b in digests], pa.int64())],
                names=["doc_id", "n", "d1", "d2"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, d1 long, d2 long")


def _buckets(sets: list[np.ndarray], bands: Bands, neighbourhoods: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every indexed subset, and which of ``sets`` it comes from."""
    jobs = [(i, b) for i, s in enumerate(sets) for b in bands.of(len(s))] if sets else []
    if not jobs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    of = np.array([i for i, _ in jobs])
    band = np.array([b for _, b in jobs])
    plain = np.array([0 if neighbourhoods else bands.plain[b] for b in band])
    m = np.where(plain > 0, plain, np.array([bands.near[b] for b in band]))
    first = np.cumsum(m) - m
    job = np.repeat(np.arange(len(jobs)), [len(sets[i]) for i in of])
    shingles = np.concatenate([sets[i] for i in of])
    segment = first[job] + (_mix(shingles + _mix(band.astype(np.uint64))[job]) % m[job].astype(np.uint64)).astype(np.int64)
    value = _mix(shingles)
    subset = np.zeros(int(m.sum()), dtype=np.uint64)
    np.add.at(subset, segment, value)
    held = np.bincount(segment, minlength=len(subset))
    job_of = np.repeat(np.arange(len(jobs)), m)
    # a segment's place: scheme, band and number; equal in both documents of a pair
    place = _mix((np.arange(len(subset)) - first[job_of]).astype(np.uint64)
                 + (band[job_of].astype(np.uint64) << np.uint64(40))
                 + (np.where(plain > 0, 0, 1)[job_of].astype(np.uint64) << np.uint64(60)))
    empty = np.bincount(job_of, weights=held == 0)
    shown = (held > 0) | (plain[job_of] == 0) | (empty > np.array([bands.spare[b] for b in band]))[job_of]
    less = plain[job] == 0  # subsets with one shingle less
    out = _mix(np.concatenate([(subset + place)[shown], (subset[segment] - value + place[segment])[less]]))
    # the scheme in the lowest byte
    scheme = np.concatenate([job_of[shown], job[less]])
    scheme = (band + np.where(neighbourhoods, 128, 0))[scheme].astype(np.uint64)
    out = (out & ~np.uint64(255)) | scheme
    return out.view(np.int64), np.concatenate([of[job_of[shown]], of[job[less]]])


def _signatures(rows: DataFrame, shingled, bands: tuple[int, int], neighbourhoods: bool) -> DataFrame:
    """(bucket, doc_id) of the rows' sets; ``shingled(columns)`` gives the sets of a batch.

    Of equal sets in one batch only the first is indexed; it stands for its class anyway.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, sets_of = Bands(*bands), shingled()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            sets = sets_of(batch.column(1).to_pylist())
            fresh = list({_digest(s): i for i, s in reversed(list(enumerate(sets)))}.values())
            bucket, which = _buckets([sets[i] for i in fresh], b, neighbourhoods)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array(ids[np.array(fresh, dtype=np.int64)][which].astype(np.int64))],
                names=["bucket", "doc_id"])

    return rows.mapInArrow(run, "bucket long, doc_id long")


def _shared(spark: SparkSession, signatures: DataFrame, members: DataFrame, bands: Bands) -> DataFrame:
    """(bucket, node, n, k): buckets with k nodes, two or more, without each node's costliest."""
    here = Window.partitionBy("bucket")
    met = (signatures.withColumns({"low": F.min("doc_id").over(here), "high": F.max("doc_id").over(here)})
           .where("low <> high").select("bucket", "doc_id"))
    nodes = written(spark, written(spark, met, "ngram-met").join(members, "doc_id")
                    .select("bucket", "node", "n").distinct(), "ngram-nodes")
    held = nodes.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    scheme = F.col("bucket").bitwiseAND(F.lit(255))
    skip = F.element_at(F.array(*[F.lit(bands.skip(s)) for s in range(256)]), scheme.cast("int") + 1)
    costly = Window.partitionBy("node", scheme).orderBy(F.desc("k"), "bucket")
    kept = (nodes.join(held, "bucket").withColumn("nth", F.row_number().over(costly))
            .where(F.col("nth") > skip).drop("nth"))
    return written(spark, kept, "ngram-shared")


def _pairs(df: DataFrame, bands: tuple[int, int]) -> DataFrame:
    """Distinct pairs (a, b), a < b, of nodes x and y whose sizes nx and ny allow the similarity."""
    p, q = bands
    sizes = F.least("nx", "ny") * q >= F.greatest("nx", "ny") * p
    return df.where(sizes & (F.col("x") != F.col("y"))).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _leaders(shared: DataFrame, bands: tuple[int, int]) -> DataFrame:
    """Every member of a bucket with its leader: the member that shares most.

    Where roots are known, the leader is the best member outside the component of the least
    root, and it meets the members of other components.
    """
    score = shared.groupBy("node").agg(F.sum("k").alias("score"))
    rooted = "root" in shared.columns
    scored = shared.join(score, "node")
    if rooted:
        least = shared.groupBy("bucket").agg(F.min("root").alias("least"))
        scored = scored.join(least, "bucket").where("root <> least")
    else:
        scored, shared = scored.withColumn("root", F.col("node")), shared.withColumn("root", F.col("node"))
    top = scored.groupBy("bucket").agg(F.max(F.struct("score", "node", "n", "root")).alias("top"))
    met = shared.join(top, "bucket").where(F.col("root") != F.col("top.root"))
    return _pairs(met.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("top.node").alias("y"),
                             F.col("top.n").alias("ny")), bands)


def _apart(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (with root and k) of the buckets whose members are not all in one component."""
    rooted = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_buckets = (rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                    .where("low <> high").select("bucket"))
    return rooted.join(open_buckets, "bucket", "left_semi")


def _cells(packed: DataFrame, words: int) -> DataFrame:
    """node and how many of its shingles fall into each of CELLS parts of the universe."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, unpack = Shingler(words), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            parts = [np.bincount((shingler(unpack(x)) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
                     for x in batch.column(1).to_pylist()]
            data = [np.minimum(c, MOST_IN_CELL).astype(np.int8).tobytes() for c in parts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["node", "cells"])

    return packed.mapInArrow(run, "node long, cells binary")


def _across(apart: DataFrame, cells: DataFrame, bands: tuple[int, int]) -> DataFrame:
    """Pairs of members of one bucket, in different components, that may be similar.

    The counts of two sets in a cell differ by no more than the sets do there, so a pair whose
    counts differ by more than H in all is left out before it becomes a row.  A large bucket is
    dealt out as pairs of blocks of its members.
    """
    p, q = bands
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    rows = (apart.select("bucket", "node", "n", "root", "k").join(cells, "node")
            .withColumn("mine", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("bucket", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                    "mine", "node", "n", "root", "cells"))

    def compare(held: pa.Table) -> pa.RecordBatch:
        node, n, root, mine = (held.column(x).to_numpy() for x in ("node", "n", "root", "mine"))
        counts = np.frombuffer(b"".join(held.column("cells").to_pylist()), np.int8).reshape(-1, CELLS).astype(np.int16)
        lo, hi = held.column("lo")[0].as_py(), held.column("hi")[0].as_py()
        out_a, out_b = [], []
        for at in range(0, len(node), 64):
            x = np.arange(at, min(at + 64, len(node)))
            x = x[mine[x] == lo]
            y = np.arange(len(node)) if lo == hi else np.flatnonzero(mine == hi)
            total = n[x][:, None] + n[y]
            good = ((root[x][:, None] != root[y]) & (q * np.minimum(n[x][:, None], n[y]) >= p * np.maximum(n[x][:, None], n[y]))
                    & ((lo != hi) | (x[:, None] < y)))
            i, j = np.nonzero(good)
            for k in range(0, len(i), 1 << 14):  # bounds the memory of the differences
                a, b = i[k:k + (1 << 14)], j[k:k + (1 << 14)]
                near = np.abs(counts[x[a]] - counts[y[b]]).sum(axis=1, dtype=np.int64) <= total[a, b] * (q - p) // (q + p)
                out_a.append(node[x[a[near]]])
                out_b.append(node[y[b[near]]])
        u, v = (np.concatenate([*z, np.empty(0, np.int64)]).astype(np.int64) for z in (out_a, out_b))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the last group, which the next batch may continue
        for batch in batches:
            held = pa.Table.from_batches([batch])
            held = held if rest is None else pa.concat_tables([rest, held])
            keys = np.stack([held.column(x).to_numpy().astype(np.int64) for x in ("bucket", "lo", "hi")])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
            for a, b in zip(edges, edges[1:]):
                yield compare(held.slice(a, b - a).combine_chunks())
            rest = held.slice(edges[-1])
        if rest is not None and rest.num_rows:
            yield compare(rest.combine_chunks())

    return (rows.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
            .mapInArrow(run, "a long, b long").distinct())


def _verified(pairs: DataFrame, packed: DataFrame, words: int, bands: tuple[int, int]) -> DataFrame:
    """The pairs whose sets have the similarity, compared as wholes."""
    p, q = bands
    x = packed.select(F.col("node").alias("a"), F.col("packed").alias("pa"))
    y = packed.select(F.col("node").alias("b"), F.col("packed").alias("pb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, unpack, kept = Shingler(words), zstandard.ZstdDecompressor().decompress, {}

        def shingles(node: int, data: bytes) -> np.ndarray:
            if node not in kept:
                if len(kept) > 64:
                    kept.clear()
                kept[node] = shingler(unpack(data))
            return kept[node]

        for batch in batches:
            good = []
            for a, b, pa_, pb in zip(*(c.to_pylist() for c in batch.columns)):
                r, s = shingles(a, pa_), shingles(b, pb)
                common = len(np.intersect1d(r, s, assume_unique=True))
                good.append(q * common >= p * (len(r) + len(s) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(x, "a").join(y, "b").select("a", "b", "pa", "pb").mapInArrow(run, "a long, b long")


def _pack(docs: DataFrame) -> DataFrame:
    """doc_id and its text, compressed, so that a shuffle of texts stays small."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            data = [pack((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["node", "packed"])

    return docs.select("doc_id", "text").mapInArrow(run, "node long, packed binary")


def groups(spark: SparkSession, docs: DataFrame, words: int = 5, p: int = 80, q: int = 100,
           many: int = MANY) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text)."""
    small_batches(spark)
    bands = (p, q)
    docs = docs.select("doc_id", "text")
    sets = written(spark, sketch(docs, words), "ngram-sets")
    named = sets.where("doc_id IS NOT NULL AND n > 0")
    # written, so that the join below may split a hot class
    classes = written(spark, named.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("node")), "ngram-classes")
    members = written(spark, named.join(classes, ["d1", "d2", "n"]).select("doc_id", "n", "node")
                      .groupBy("doc_id").agg(F.min("node").alias("node"), F.max("n").alias("n")), "ngram-members")

    def of_texts():
        shingler = Shingler(words)
        return lambda texts: [shingler((t or "").encode()) for t in texts]

    def of_packed():
        shingler, unpack = Shingler(words), zstandard.ZstdDecompressor().decompress
        return lambda data: [shingler(unpack(x)) for x in data]

    shared = _shared(spark, _signatures(docs.where("doc_id IS NOT NULL"), of_texts, bands, False), members, Bands(p, q))
    packed = written(spark, _pack(docs).join(shared.select("node").distinct(), "node", "left_semi")
                     .dropDuplicates(["node"]), "ngram-packed")

    def verified(pairs: DataFrame) -> DataFrame:
        return written(spark, _verified(pairs, packed, words, bands), "ngram-links")

    roots = components(spark, verified(_leaders(shared, bands)))

    def joined(links: DataFrame) -> bool:
        """Takes further links into ``roots``; whether there are any."""
        nonlocal roots
        if links.isEmpty():
            return False
        # the components so far are stars, so few rounds are left
        roots = components(spark, links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        return True

    apart = written(spark, _apart(shared, roots), "ngram-apart")
    if joined(verified(_leaders(apart, bands))):
        apart = written(spark, _apart(apart.drop("root"), roots), "ngram-apart")
    several = apart.where(F.col("k") > SEVERAL)
    if not several.isEmpty() and joined(verified(_leaders(several, bands))):
        apart = written(spark, _apart(apart.drop("root"), roots), "ngram-apart")
    cells = written(spark, _cells(packed.join(apart.select("node").distinct(), "node", "left_semi"), words), "ngram-cells")
    last = verified(_across(apart.where(F.col("k") <= many), cells, bands))
    costly = apart.where(F.col("k") > many).select("node").distinct()
    if not costly.isEmpty():
        near = _signatures(packed.join(costly, "node", "left_semi"), of_packed, bands, True)
        near = _shared(spark, near, members, Bands(p, q))
        joined(verified(_leaders(near, bands)))
        near = _apart(near, roots)
        last = last.unionByName(verified(_across(near, cells, bands)))
    joined(last)
    found = (members.join(roots, "node", "left")
             .select("doc_id", F.coalesce("root", "node").alias("root")))
    return (sets.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id")))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, lambda: groups(spark, documents(spark, sf_dir), words=4, p=85, q=100), "ngram-groups")
