"""MinHash near-dedup (12) by a chosen-path set similarity join.

Linked documents have shingle sets with a Jaccard similarity of at least p / q.

* Sketch.  A set keeps COORDINATES minwise hashes; two sets agree in each with the probability of
  their similarity.  Equal sets (128-bit digests) are one node of the join, with one sketch.
* Trees.  At its root a tree chooses BRANCHES coordinates and deals every set to one child per
  coordinate, named by the token that is minwise there.  A child with more than ``leaf`` sets
  chooses BRANCHES further coordinates by a hash of its path, and so on down to DEPTH.  A similar
  pair is together in a child unless all coordinates chosen at the node tell it apart; so it
  reaches a common leaf with a probability that ``reach`` gives, and trees with coordinates of
  their own at the root are repeated until a pair just at the threshold is missed with the
  probability 1 - RECALL at most.  A child with one set ends at once, which most do.
* Leaves are compared exhaustively, by sketches first: a pair whose sketches agree in fewer
  coordinates than a similar pair's would in all but FILTER_MISS of cases is left out.  A set
  that has no other pair in a leaf leaves it before any text is read.  Then an
  exact bound: sets that are counted in CELLS parts of the universe differ by as much as their
  counts do at least, so a pair whose counts differ by more than a link allows is left out too.
* Links are confirmed on the full sets: the words of both texts are numbered by an exact
  dictionary, and their windows are compared as wholes.

A group of near copies must not give all its pairs.  Every member first meets the member that
shares most nodes; links are contracted, twice; only pairs of different components in one leaf
are left to compare.  Nodes that stay large down to DEPTH are such groups.  Their rest is compared
in blocks of BLOCK sets, so the work on many sets that stay together and are yet not connected
(similarity just below the threshold throughout) grows with the square of their number, in
bounded memory; no pair is skipped.

Defined results: words are runs of ``[^\\x20\\x09-\\x0D]`` of the text with A-Z lower-cased.  With
fewer words than a shingle has, the whole sequence is the one shingle.  Null and blank texts have
an empty set and are linked with nothing.  Repeated rows, and rows that share a doc_id but not the
text, take part each with its own text.  Rows without doc_id take part too; a component has the
least doc_id of its rows, null if none has one.  A row is kept if its doc_id is its component's;
so is a row without doc_id in a component without any.  Sets are counted and sketched by 64-bit
hashes of their shingles.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.common import documents, small_batches, written
from dossier.llm.components import components
from dossier.llm.ngram_join import Shingler

#: Minwise hashes of a sketch, four bytes each.
COORDINATES = 64
#: Coordinates chosen at a node, levels of a tree, sets of a leaf.
BRANCHES, DEPTH, LEAF = 2, 4, 4096
#: Probability that a pair at the threshold is together in a leaf of some tree; that its sketches hide it.
RECALL, FILTER_MISS = 0.9999, 1e-6
#: Sets that are compared with each other in one go.
BLOCK = 512
#: Parts of the universe of shingles that a set is counted in, and the largest count told apart.
CELLS, MOST_IN_CELL = 1024, 127
#: Bits per set, and in all, of the filter that tells most rows whose text is not read.
FILTER_BITS, MOST_FILTER_BITS = 8, 1 << 26
SEED = 12


def reach(similarity: float, branches: int = BRANCHES, depth: int = DEPTH) -> float:
    """The probability that a pair of this similarity is together in a node at ``depth`` of one tree."""
    found = 1.0
    for _ in range(depth):
        found = 1 - (1 - similarity * found) ** branches
    return found


def trees(similarity: float, recall: float = RECALL) -> int:
    """Trees that find a pair of this similarity with the probability ``recall``."""
    missed = 1 - reach(similarity)
    n = 1 if missed < 1e-12 else math.ceil(math.log(1 - recall) / math.log(missed))
    if n * BRANCHES > COORDINATES:
        raise ValueError("the similarity is too low for sketches of this size")
    return n


def least_agreement(similarity: float, miss: float = FILTER_MISS) -> int:
    """Coordinates in which two sketches agree at least, but for ``miss`` of the pairs of this similarity."""
    below = 0.0
    for k in range(COORDINATES + 1):
        below += math.comb(COORDINATES, k) * similarity ** k * (1 - similarity) ** (COORDINATES - k)
        if below > miss:
            return k
    return COORDINATES


def minwise(shingles: np.ndarray, factors: np.ndarray) -> bytes:
    """The sketch of a set: per coordinate the least of its shingles' hashes."""
    best = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        np.minimum(best, (shingles[at:at + 4096, None] * factors).min(axis=0), out=best)
    return (best >> np.uint64(32)).astype("<u4").tobytes()


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (set size), d (digest of the set) and sketch of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d", pa.binary()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        factors = np.random.default_rng(SEED).integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            sets = [shingler((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(_digest, sets), pa.binary()),
                 pa.array([minwise(s, factors) for s in sets], pa.binary())], schema=schema)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n long, d binary, sketch binary"))


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _places(doc_ids: pa.Array, digests: list[bytes], bits: int) -> np.ndarray:
    """The bit of a filter of ``bits`` bits that a row with this doc_id and digest has."""
    ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    low = np.frombuffer(b"".join(digests), "<u8")[::2]
    return (low + ids * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(bits - 1)


def _filter_of(sets: DataFrame) -> np.ndarray:
    """A bit for every one of ``sets`` (d, first), packed in bytes; its size is bounded, other rows may share a bit."""
    bits = min(MOST_FILTER_BITS, 1 << max(10, (FILTER_BITS * sets.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _places(batch.column(0), batch.column(1).to_pylist(), bits)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(
                (np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["word", "held"])

    held = sets.select("first", "d").mapInArrow(run, "word long, held long").groupBy("word").agg(F.bit_or("held").alias("held")).toArrow()
    words = np.zeros(bits // 64, dtype="<i8")
    words[held.column("word").to_numpy()] = held.column("held").to_numpy()
    return words.view(np.uint8)


def _packed(docs: DataFrame, words: int, wanted: np.ndarray) -> DataFrame:
    """doc_id, d (digest of the set) and packed (the compressed text) of every row that has words and a bit in ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, pack = Shingler(words), zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            sets = [shingler(t) for t in texts]
            digests = [_digest(s) for s in sets]
            at = _places(batch.column(0), digests, len(wanted) * 8)
            found = (wanted[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
            kept = [k for k, s in enumerate(sets) if found[k] and len(s) > 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int64())), pa.array([digests[k] for k in kept], pa.binary()),
                 pa.array([pack(texts[k]) for k in kept], pa.binary())], names=["doc_id", "d", "packed"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, d binary, packed binary"))


def _texts_of(sets: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """node and packed of ``sets`` (node, d, first): the text of a row with the set and its first doc_id.

    Texts are read from ``docs`` again: a copy of all of them is written nowhere, and a filter keeps most
    that belong to none of ``sets`` out of the shuffle; the join is exact.  Repeated rows meet where the
    join has dealt them.
    """
    def keyed(df: DataFrame, doc_id: str) -> DataFrame:
        return df.withColumns({"key": F.coalesce(doc_id, F.lit(0)), "unnamed": F.col(doc_id).isNull()})

    keys = ["d", "key", "unnamed"]
    texts = keyed(_packed(docs, words, _filter_of(sets)), "doc_id").select(*keys, "packed")
    return texts.join(keyed(sets, "first").select(*keys, "node"), keys).dropDuplicates(keys).select("node", "packed")


def _partnered(members: DataFrame, sets: DataFrame, leaf: int, least: int, p: int, q: int) -> DataFrame:
    """(path, node, size) of ``members`` with d, n, sketch and first, without those that no set of their leaf may be linked with.

    Sizes and sketches decide, as for every pair that is compared later.  A set that has met one near set is
    compared with no further one for its own sake.  Leaves of more than ``leaf`` sets are kept whole.
    """
    columns = ["path", "node", "size", "d", "n", "sketch", "first"]

    def near_some(held: pa.Table) -> np.ndarray:
        n = held.column("n").to_numpy()
        sketch = np.frombuffer(b"".join(held.column("sketch").to_pylist()), "<u4").reshape(-1, COORDINATES)
        found = np.zeros(len(n), dtype=bool)
        at, step = 0, max(1, (1 << 13) // len(n))  # bounds the memory of the comparison
        while at < len(n):
            x = at + np.flatnonzero(~found[at:])[:step]
            if not len(x):
                break
            good = (sketch[x][:, None] == sketch).sum(axis=2) >= least
            good &= q * np.minimum(n[x][:, None], n) >= p * np.maximum(n[x][:, None], n)
            good[np.arange(len(x)), x] = False
            found[x] |= good.any(axis=1)
            found |= good.any(axis=0)
            at = int(x[-1]) + 1
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the last leaf, which the next batch may continue
        for batch in batches:
            large = np.asarray(batch.column(2).to_numpy(zero_copy_only=False) > leaf)
            if large.any():
                yield batch.filter(pa.array(large))
                batch = batch.filter(pa.array(~large))
            held = pa.Table.from_batches([batch])
            held = held if rest is None else pa.concat_tables([rest, held])
            path = held.column("path").to_numpy()
            edges = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist()]
            kept = [near_some(held.slice(a, b - a)) for a, b in zip(edges, edges[1:])]
            if kept:
                yield from held.slice(0, edges[-1]).filter(pa.array(np.concatenate(kept))).to_batches()
            rest = held.slice(edges[-1])
        if rest is not None and rest.num_rows:
            yield from rest.filter(pa.array(near_some(rest))).to_batches()

    # a large leaf is dealt out, since it is not compared here
    rows = members.join(sets, "node").select(*columns)
    return (rows.repartition("path", F.when(F.col("size") > leaf, F.col("node")).otherwise(F.lit(0))).sortWithinPartitions("path")
            .mapInArrow(run, "path long, node long, size long, d binary, n long, sketch binary, first long"))


def _child(path: Column, coordinate: Column) -> Column:
    return F.xxhash64(path, coordinate, F.substring("sketch", coordinate * 4 + 1, F.lit(4)))


def grown(spark: SparkSession, sets: DataFrame, n_trees: int, leaf: int) -> DataFrame:
    """(path, node, size): the members of every leaf with two sets or more, from sets (node, sketch).

    Leaves have ``leaf`` sets at most, but for nodes at DEPTH, which have any number.
    """
    roots = F.array(*[_child(F.lit(t), F.lit(t * BRANCHES + j)) for t in range(n_trees) for j in range(BRANCHES)])
    rows, found = sets.select("node", F.explode(roots).alias("path")), None
    # coordinates of a path: odd steps from a place of its own never meet in a power of two
    place = F.pmod(F.xxhash64("path", F.lit(SEED)), F.lit(COORDINATES)).cast("int")
    step = F.pmod(F.xxhash64("path", F.lit(SEED + 1)), F.lit(COORDINATES // 2)).cast("int") * 2 + 1
    further = F.array(*[_child(F.col("path"), F.pmod(place + step * j, F.lit(COORDINATES))) for j in range(BRANCHES)])
    for level in range(1, DEPTH + 1):
        # written, so that the join below may split a hot child
        shared = written(spark, rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "paths-shared")
        held = written(spark, rows.join(shared, "path").select("path", "node", "size"), "paths-held")
        large = held.where(F.col("size") > leaf)
        done = held if level == DEPTH else held.where(F.col("size") <= leaf)
        found = done if found is None else found.unionByName(done)
        if level == DEPTH or large.isEmpty():
            return found
        rows = large.join(sets, "node").select("node", F.explode(further).alias("path"))
    raise AssertionError


def _open(spark: SparkSession, members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with their roots, of the leaves whose members are not all in one component."""
    rooted = members.drop("root").join(components(spark, links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = written(spark, rooted.groupBy("path").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                      .where("low <> high").select("path"), "paths-open")
    return written(spark, rooted.join(several, "path").select("path", "node", "size", "root"), "paths-apart")


def _leaders(members: DataFrame) -> DataFrame:
    """(x, y): members with the leader of their leaf, the set that shares most nodes.

    The leader is taken outside the component of the least root, and meets other components only.
    """
    score = members.groupBy("node").agg(F.sum("size").alias("score"))
    least = members.groupBy("path").agg(F.min("root").alias("least"))
    top = (members.join(score, "node").join(least, "path").where("root <> least").groupBy("path")
           .agg(F.max(F.struct("score", "node", "root")).alias("top")))
    return (members.join(top, "path").where("root <> top.root")
            .select(F.col("node").alias("x"), F.col("top.node").alias("y")).distinct())


def _agreement(a: list[bytes], b: list[bytes]) -> np.ndarray:
    x, y = (np.frombuffer(b"".join(z), "<u4").reshape(-1, COORDINATES) for z in (a, b))
    return (x == y).sum(axis=1)


def _near(pairs: DataFrame, sets: DataFrame, least: int, p: int, q: int) -> DataFrame:
    """(x, y, agreement) of the pairs whose sketches agree in ``least`` coordinates and whose sizes allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _agreement(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], names=["x", "y", "agreement"])
            yield out.filter(pa.array(found >= least))

    of = {s: sets.select(F.col("node").alias(s), F.col("sketch").alias(f"s{s}"), F.col("n").alias(f"n{s}")) for s in "xy"}
    sized = pairs.join(of["x"], "x").join(of["y"], "y").where(F.least("nx", "ny") * q >= F.greatest("nx", "ny") * p)
    return sized.select("x", "y", "sx", "sy").mapInArrow(run, "x long, y long, agreement long")


def _counted(packed: DataFrame, words: int) -> DataFrame:
    """node and the number of its shingles in each of CELLS parts of the universe, a byte each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, unpack = Shingler(words), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            counts = [np.bincount((shingler(unpack(x)) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
                      for x in batch.column(1).to_pylist()]
            data = [np.minimum(c, MOST_IN_CELL).astype(np.int8).tobytes() for c in counts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["node", "cells"])

    return packed.select("node", "packed").mapInArrow(run, "node long, cells binary")


def _across(members: DataFrame, sets: DataFrame, cells: DataFrame, least: int, p: int, q: int) -> DataFrame:
    """(x, y): pairs of different components in one leaf that sizes, sketches and counts allow.

    A leaf of more than BLOCK sets is dealt out as pairs of blocks.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = (members.join(sets.select("node", "sketch", "n"), "node").join(cells, "node")
            .withColumn("mine", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("path", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                    "mine", "node", "root", "n", "sketch", "cells"))

    def compare(held: pa.Table) -> pa.RecordBatch:
        node, root, n, mine = (held.column(c).to_numpy() for c in ("node", "root", "n", "mine"))
        sketch = np.frombuffer(b"".join(held.column("sketch").to_pylist()), "<u4").reshape(-1, COORDINATES)
        counts = np.frombuffer(b"".join(held.column("cells").to_pylist()), np.int8).reshape(-1, CELLS)
        lo, hi = held.column("lo")[0].as_py(), held.column("hi")[0].as_py()
        left = np.flatnonzero(mine == lo)
        right = np.arange(len(node)) if lo == hi else np.flatnonzero(mine == hi)
        out = []
        for at in range(0, len(left), 64):
            a = left[at:at + 64]
            good = ((root[a][:, None] != root[right]) & ((lo != hi) | (a[:, None] < right))
                    & (q * np.minimum(n[a][:, None], n[right]) >= p * np.maximum(n[a][:, None], n[right])))
            i, j = np.nonzero(good)
            for k in range(0, len(i), 1 << 13):  # bounds the memory of the comparison
                u, v = a[i[k:k + (1 << 13)]], right[j[k:k + (1 << 13)]]
                near = (sketch[u] == sketch[v]).sum(axis=1) >= least
                u, v = u[near], v[near]
                apart = np.abs(counts[u].astype(np.int16) - counts[v]).sum(axis=1, dtype=np.int64)
                near = apart * (q + p) <= (n[u] + n[v]) * (q - p)
                out.append((node[u[near]], node[v[near]]))
        u, v = (np.concatenate([np.empty(0, np.int64), *z]) for z in zip(*out)) if out else (np.empty(0, np.int64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the last group, which the next batch may continue
        for batch in batches:
            held = pa.Table.from_batches([batch])
            held = held if rest is None else pa.concat_tables([rest, held])
            keys = np.stack([held.column(c).to_numpy().astype(np.int64) for c in ("path", "lo", "hi")])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
            for a, b in zip(edges, edges[1:]):
                yield compare(held.slice(a, b - a).combine_chunks())
            rest = held.slice(edges[-1])
        if rest is not None and rest.num_rows:
            yield compare(rest.combine_chunks())

    return (rows.repartition("path", "lo", "hi").sortWithinPartitions("path", "lo", "hi")
            .mapInArrow(run, "x long, y long").distinct())


def similar(a: bytes, b: bytes, words: int, p: int, q: int) -> bool:
    """Whether two texts are linked, by their whole sets: no hash decides."""
    x, y = a.lower().split(), b.lower().split()  # of bytes: lower-cases A-Z and splits at ASCII white space only
    if len(x) < words or len(y) < words:
        return bool(x) and x == y
    number: dict[bytes, int] = {}
    for w in x + y:
        number.setdefault(w, len(number))
    ids = np.fromiter(map(number.__getitem__, x + y), dtype=np.int64, count=len(x) + len(y))
    code, span = ids, len(number)
    for j in range(1, words):  # windows as numbers: exact while they fit, else numbered anew
        if span >= 1 << 31:
            code, span = np.unique(code, return_inverse=True)[1], len(code)
        code, span = code[:-1] * len(number) + ids[j:], span * len(number)
    one, two = (np.unique(z) for z in (code[:len(x) - words + 1], code[len(x):]))
    common = len(np.intersect1d(one, two, assume_unique=True))
    return q * common >= p * (len(one) + len(two) - common)


def _confirmed(pairs: DataFrame, packed: DataFrame, words: int, p: int, q: int) -> DataFrame:
    """(a, b) of the pairs whose texts are similar, compared as wholes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            good = [similar(unpack(x), unpack(y), words, p, q) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    of = {s: packed.select(F.col("node").alias(s), F.col("packed").alias(f"p{s}")) for s in "xy"}
    return (pairs.join(of["x"], "x").join(of["y"], "y").select(F.col("x").alias("a"), F.col("y").alias("b"), "px", "py")
            .mapInArrow(run, "a long, b long"))


def groups(spark: SparkSession, docs: DataFrame, words: int = 5, p: int = 80, q: int = 100, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text)."""
    small_batches(spark)
    least = least_agreement(p / q)
    rows = written(spark, sketched(docs, words), "paths-rows")
    # the sketch follows from the digest; the ids are fixed by being written
    sets = written(spark, rows.where("n > 0").groupBy("d", "n", "sketch").agg(F.min("doc_id").alias("first"))
                   .withColumn("node", F.monotonically_increasing_id()), "paths-sets")
    # from here on only the sets that share a leaf with one that they may be linked with are read
    partnered = written(spark, _partnered(grown(spark, sets, trees(p / q), leaf), sets, leaf, least, p, q), "paths-partnered")
    members = partnered.select("path", "node", "size", F.col("node").alias("root"))
    met = written(spark, partnered.select("node", "d", "n", "sketch", "first").dropDuplicates(["node"]), "paths-met")
    packed = written(spark, _texts_of(met, docs, words), "paths-packed")
    links = None
    for _ in range(2):  # every member meets its nearest leader
        near = _near(_leaders(members), met, least, p, q)
        best = near.groupBy("x").agg(F.max(F.struct("agreement", "y")).alias("best")).select("x", "best.y")
        more = written(spark, _confirmed(best, packed, words, p, q), "paths-links")
        links = more if links is None else links.unionByName(more)
        members = _open(spark, members, links)
    alone = written(spark, members.select("node").distinct(), "paths-alone")
    cells = written(spark, _counted(packed.join(alone, "node", "left_semi"), words), "paths-cells")
    rest = _across(members, met, cells, least, p, q)
    links = links.unionByName(written(spark, _confirmed(rest, packed, words, p, q), "paths-links"))
    roots = written(spark, components(spark, links), "paths-roots")
    linked = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    least_id = (linked.join(sets.select("node", "first"), "node").groupBy("root").agg(F.min("first").alias("component_id")))
    named = linked.join(least_id, "root").select("node", "component_id", F.lit(True).alias("linked"))
    of_set = written(spark, sets.join(named, "node", "left").select(
        "d", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first")).alias("component_id")), "paths-components")
    # empty sets have no component but their own
    out = rows.select("doc_id", "n", "d").join(of_set, "d", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op12_minhash_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(spark, documents(spark, sf_dir), words=5, p=85, q=100)
