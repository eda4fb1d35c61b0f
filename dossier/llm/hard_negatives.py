"""Hard-negative mining (13) by Four-Russians scoring.

Vectors of integers are compared with every anchor by table lookups in place of products:

* Index.  Candidates are dealt by a hash into blocks.  A block is kept as bit planes: plane b of a
  candidate holds bit b of its components (two's complement), eight dimensions to a byte.
* Tables.  For each group of eight dimensions an anchor block has a table of all 256 subset sums of
  the anchors' components there, built by doubling.
* Scores.  A candidate's byte looks up the sum of the components that its bits select; a plane's sums
  are added in the narrowest integers that hold them, then the planes, from the top one (which counts
  negative) down, each time doubling what is there.  Candidates are scored a few at a time, so that
  sums stay in the processor's cache.  The scores are the full, exact inner products.

Anchors are dealt into blocks of ANCHORS as well.  Every anchor block meets every candidate block in a
grid of tiles, one task each: a task holds the candidate blocks of its tile, up to HELD bytes of them,
while the tile's anchor blocks pass by one at a time.  Blocks are copied once per tile, not once per
block pair, and are shuffled, never broadcast: Spark plans by a table's size before its rows are
copied, and the copies would all go through the driver.  The first pass scores candidates of the anchors'
own labels and keeps each anchor's positives; the second scores the others and keeps, for each anchor and
positive, the first few in its window of scores.  A tile gives a few rows per anchor, and windows with a
partial limit join the tiles' finds.

Defined results: rows with a null vec_id, label or vector, or with a null or non-finite component, take
no part.  Repeated rows (equal vec_id, label and vector) are one row; rows that share a vec_id alone are
different rows, and none of them is another's positive.  Shorter vectors, empty ones too, count as
filled up with zeros.  Ties go to the smaller vec_id.  An anchor without another row of its label has
no rows, nor has a positive whose window is empty (of a negative score it always is).  Vectors whose
scores could leave 62 bits raise an error.  An empty table gives an empty result.  Other columns, of
any name, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.llm.common import small_batches, written
from dossier.sources.tables import table

#: Vectors of a block.
ANCHORS, CANDIDATES = 512, 4096
#: Bytes of candidate blocks that a task holds (one block at least).
HELD = 32 << 20
#: Candidates scored at a time, and groups of dimensions whose tables are held at a time.
SCORED, GROUPS = 512, 16
#: Positives of an anchor, negatives of a positive, and the window of a negative's score in percent of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100

BLOCK = "block int, vec_id binary, label binary, most long, planes int, groups int, bits binary"
POSITIVE = "anchor_id long, key long, positive_id long, score long"
NEGATIVE = "anchor_id long, key long, nth int, positive_id long, positive_score long, negative_id long, negative_score long"


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct vec_id, label, x (integers) and key (a hash of all) of the rows that take part."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * 256).cast("long"))
    return (vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"))
            .distinct().withColumn("key", F.xxhash64("vec_id", "label", "x")))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """A list array of integers as a matrix, short rows filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), int(sizes.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def _most(x: np.ndarray) -> int:
    return max(-int(x.min(initial=0)), int(x.max(initial=0)))


def bit_planes(x: np.ndarray) -> np.ndarray:
    """(planes, groups, rows): bit b of eight neighbouring components in one byte, the first in the lowest bit."""
    planes = _most(x).bit_length() + 1
    return np.stack([np.packbits((x >> b & 1).astype(bool), axis=1, bitorder="little").T for b in range(planes)])


def subset_sums(group: np.ndarray, dtype: type) -> np.ndarray:
    """(256, anchors): for every byte the sum of the components (anchors, up to 8) at its bits."""
    sums = np.zeros((1, len(group)), dtype=dtype)
    for j in range(8):
        more = group[:, j] if j < group.shape[1] else 0
        sums = np.concatenate([sums, sums + more]).astype(dtype)
    return sums


def scores(anchors: np.ndarray, bits: np.ndarray, most: int) -> np.ndarray:
    """(candidates, anchors): exact inner products; ``most`` bounds the candidates' components."""
    bound = max(1, anchors.shape[1]) * max(1, _most(anchors)) * max(1, 2 * most)
    if bound >= 1 << 62:
        raise ValueError("the components are too large for exact 64-bit scores")
    dtype = np.int32 if bound < 1 << 30 else np.int64
    planes, groups, rows = bits.shape
    both = min(groups, -(-anchors.shape[1] // 8))  # beyond the shorter vectors all is zero
    narrow = np.int16 if 8 * min(both, GROUPS) * _most(anchors) < 1 << 15 else dtype
    total = np.zeros((rows, len(anchors)), dtype=dtype)
    for first in range(0, both, GROUPS):
        tables = [subset_sums(anchors[:, 8 * g:8 * g + 8], narrow) for g in range(first, min(both, first + GROUPS))]
        for at in range(0, rows, SCORED):
            part = np.zeros((len(total[at:at + SCORED]), len(anchors)), dtype=dtype)
            for b in reversed(range(planes)):
                plane = np.zeros(part.shape, dtype=narrow)
                for sums, byte in zip(tables, bits[b, first:, at:at + SCORED]):
                    plane += sums[byte]
                part *= 2
                if b < planes - 1:
                    part += plane
                else:
                    part -= plane
            total[at:at + SCORED] += part
    return total


def _blocks(spark: SparkSession, rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """(block, held): blocks of about ``size`` rows each as an array of structs; and how many blocks there are."""
    n = max(1, -(-rows.count() // size))
    columns = F.struct(*rows.columns).alias("row")
    dealt = rows.select(F.pmod("key", F.lit(n)).cast("int").alias("block"), columns)
    return written(spark, dealt.groupBy("block").agg(F.collect_list("row").alias("held")), name), n


def index(spark: SparkSession, rows: DataFrame, size: int = CANDIDATES) -> tuple[DataFrame, int]:
    """The candidate blocks (columns of BLOCK), rows in order of vec_id, and their number."""
    blocks, n = _blocks(spark, rows, size, "negatives-dealt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, held in zip(batch.column(0).to_pylist(), _held(batch.column(1))):
                ids, x = held.field("vec_id").to_numpy(), _matrix(held.field("x"))
                order = np.argsort(ids, kind="stable")
                bits = bit_planes(x[order])
                yield pa.RecordBatch.from_pylist([{
                    "block": block, "vec_id": ids[order].tobytes(), "label": held.field("label").to_numpy()[order].tobytes(),
                    "most": _most(x), "planes": bits.shape[0], "groups": bits.shape[1], "bits": bits.tobytes()}],
                    schema=pa.schema([("block", pa.int32()), ("vec_id", pa.binary()), ("label", pa.binary()), ("most", pa.int64()),
                                      ("planes", pa.int32()), ("groups", pa.int32()), ("bits", pa.binary())]))

    return written(spark, blocks.mapInArrow(run, BLOCK), "negatives-index"), n


def _held(column: pa.Array) -> Iterator[pa.StructArray]:
    """The struct array of every row of a list column."""
    for i in range(len(column)):
        yield column[i].values


Find = Callable[[pa.StructArray, np.ndarray, np.ndarray, np.ndarray, int], "list[np.ndarray]"]


def _first(found: list[np.ndarray], keys: int, most: int) -> list[np.ndarray]:
    """The first ``most`` of the rows that agree in the first ``keys`` columns: by falling score (the last column), then by vec_id (the one before)."""
    order = np.lexsort((found[-2], -found[-1], *found[keys - 1::-1]))
    found = [x[order] for x in found]
    begins = np.ones(len(order), dtype=bool)
    begins[1:] = np.any([x[1:] != x[:-1] for x in found[:keys]], axis=0)
    place = np.arange(len(order))
    kept = place - np.maximum.accumulate(np.where(begins, place, 0)) < most
    return [x[kept] for x in found]


def _tiles(spark: SparkSession, anchors: DataFrame, n_anchors: int, candidates: DataFrame, n_candidates: int) -> tuple[int, int]:
    """How many tiles the anchor and the candidate blocks are dealt into.

    There are about as many tiles as shuffle partitions, as long as there are block pairs, cut so that
    few bytes are copied, and into more where a tile's candidate blocks would pass HELD.
    """
    rows, width = F.octet_length("vec_id") / 8, F.col("planes") * F.col("groups") + 16
    block, groups = candidates.agg(F.max(rows * width), F.max("groups")).first()
    block = max(1, int(block or 0))
    anchor = max(1, (anchors.agg(F.max(F.size("held"))).first()[0] or 0) * (64 * (groups or 0) + 40))
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    even = round((wanted * (n_candidates * block) / (n_anchors * anchor)) ** 0.5)
    across = min(n_candidates, max(even, -(-wanted // n_anchors), -(-n_candidates // max(1, HELD // block))))
    return min(n_anchors, -(-wanted // across)), across


def _meet(spark: SparkSession, anchors: DataFrame, n_anchors: int, candidates: DataFrame, n_candidates: int, find: Find, schema: str,
          keys: int, most: int) -> DataFrame:
    """``find(anchors, vec_ids, labels, bits, most)`` of every anchor block with every candidate block, the ``_first`` of each tile."""
    down, across = _tiles(spark, anchors, n_anchors, candidates, n_candidates)
    block = F.struct("vec_id", "label", "most", "planes", "groups", "bits").alias("candidates")
    a = anchors.select("held", (F.col("block") % down).alias("a"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("c"))
    c = candidates.select(block, (F.col("block") % across).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("a"))
    tile = (F.col("c") * down + F.col("a")).alias("tile")
    both = (c.select(tile, F.lit(0).alias("turn"), "candidates", F.lit(None).cast(a.schema["held"].dataType).alias("held"))
            .union(a.select(tile, F.lit(1), F.lit(None).cast(c.schema["candidates"].dataType), "held")))
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int32() if x.endswith(" int") else pa.int64() for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, blocks = None, []
        for batch in batches:
            for number, block, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if number != of:
                    of, blocks = number, []
                if block.is_valid:
                    b = block.as_py()
                    ids, labels = (np.frombuffer(b[k], np.int64) for k in ("vec_id", "label"))
                    blocks.append((ids, labels, np.frombuffer(b["bits"], np.uint8).reshape(b["planes"], b["groups"], len(ids)), b["most"]))
                    continue
                found = [np.empty(0, np.int64)] * len(names)
                for b in blocks:
                    found = _first([np.concatenate(x) for x in zip(found, find(held.values, *b))], keys, most)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, types)], names=names)

    dealt = both.repartitionById(down * across, F.col("tile")).sortWithinPartitions("tile", "turn")
    return dealt.select("tile", "candidates", "held").mapInArrow(run, schema)


def _own_label(positives: int) -> Find:
    """The first ``positives`` rows of each anchor's label in a candidate block."""
    def find(held, ids, labels, bits, most):
        anchor, key, label = (held.field(x).to_numpy() for x in ("vec_id", "key", "label"))
        x, out = _matrix(held.field("x")), []
        for own in np.intersect1d(label, labels):
            a, c = np.flatnonzero(label == own), np.flatnonzero(labels == own)
            s = scores(x[a], bits[:, :, c], most).T.astype(np.int64)
            same = anchor[a][:, None] == ids[c]
            none = -(1 << 62)  # below every score
            s[same] = none
            best = min(positives, len(c))
            least = np.partition(s, len(c) - best, axis=1)[:, len(c) - best]
            i, j = np.nonzero((s >= least[:, None]) & (s > none))
            order = np.lexsort((j, -s[i, j], i))  # candidates stand in order of vec_id
            i, j = i[order], j[order]
            good = np.arange(len(i)) - np.searchsorted(i, i) < positives
            i, j = i[good], j[good]
            out.append((anchor[a][i], key[a][i], ids[c][j], s[i, j]))
        return [np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 4

    return find


def _in_windows(negatives: int, low: int, high: int) -> Find:
    """For each anchor and positive, the first ``negatives`` rows of other labels in the score's window."""
    def find(held, ids, labels, bits, most):
        anchor, key, label = (held.field(x).to_numpy() for x in ("vec_id", "key", "label"))
        lists = held.field("positives")
        owner = np.repeat(np.arange(len(anchor)), np.diff(lists.offsets.to_numpy()))
        nth, positive, wanted = (lists.flatten().field(x).to_numpy() for x in ("nth", "positive_id", "score"))
        least, top = -(-low * wanted // 100), high * wanted // 100
        # scores outside of all windows of an anchor are left out at once
        lowest, highest = np.full(len(anchor), np.iinfo(np.int64).max), np.full(len(anchor), np.iinfo(np.int64).min)
        np.minimum.at(lowest, owner, least)
        np.maximum.at(highest, owner, top)
        s = scores(_matrix(held.field("x")), bits, most)
        c, a = np.nonzero((s >= lowest) & (s <= highest) & (labels[:, None] != label))
        found = s[c, a].astype(np.int64)
        order = np.lexsort((c, -found, a))
        c, a, found = c[order], a[order], found[order]
        # places by anchor, then by falling score: one number per entry, searched for each window's upper end
        ceiling = max(int(found.max(initial=0)), int(top.max(initial=0)))
        width = ceiling - min(int(found.min(initial=0)), int(top.min(initial=0))) + 1
        if (len(anchor) + 1) * width >= 1 << 63:
            raise ValueError("the components are too large for exact 64-bit scores")
        first = np.searchsorted(a * width + (ceiling - found), owner * width + (ceiling - top))
        place = first[:, None] + np.arange(negatives)
        inside = place < len(a)
        place = np.minimum(place, max(len(a) - 1, 0))
        if len(a):
            inside &= (a[place] == owner[:, None]) & (found[place] >= least[:, None])
        w, k = np.nonzero(inside)
        at = place[w, k]
        return [anchor[owner[w]], key[owner[w]], nth[w], positive[w], wanted[w], ids[c[at]], found[at]]

    return find


def mine(spark: SparkSession, rows: DataFrame, is_anchor: str, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, anchors_held: int = ANCHORS, candidates_held: int = CANDIDATES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``rows`` as of ``usable``."""
    small_batches(spark)
    rows = written(spark, rows, "negatives-rows")
    candidates, n = index(spark, rows, candidates_held)
    asked = rows.where(is_anchor)
    held, m = _blocks(spark, asked, anchors_held, "negatives-anchors")
    of_anchor = Window.partitionBy("anchor_id", "key")
    near = written(spark, _meet(spark, held, m, candidates, n, _own_label(positives), POSITIVE, 2, positives), "negatives-near")
    first = (near.withColumn("nth", F.row_number().over(of_anchor.orderBy(F.desc("score"), "positive_id")))
             .where(F.col("nth") <= positives).groupBy("anchor_id", "key")
             .agg(F.sort_array(F.collect_list(F.struct("nth", "positive_id", "score"))).alias("positives")))
    given = asked.join(first.withColumnRenamed("anchor_id", "vec_id").hint("merge"), ["vec_id", "key"])  # not broadcast, as above
    held, m = _blocks(spark, written(spark, given, "negatives-given"), anchors_held, "negatives-windows")
    found = written(spark, _meet(spark, held, m, candidates, n, _in_windows(negatives, low, high), NEGATIVE, 3, negatives), "negatives-found")
    of_positive = Window.partitionBy("anchor_id", "key", "nth").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(of_positive)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return mine(spark, usable(vectors), "vec_id % 100 = 0")


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id AS other,
         CAST(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * v.x[i])) AS BIGINT) AS score
  FROM v a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 5
"""
