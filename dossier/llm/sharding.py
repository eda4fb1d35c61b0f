"""Sharding (8) by a two-pass external shuffle.

Pass 1 scatters records uniformly into buckets that fit in memory, by a seeded hash.  Pass 2
shuffles every bucket by Fisher-Yates with a seed of its own.  Buckets one after the other are
the shuffled corpus; shard s holds the places from s * n / shards up to (s + 1) * n / shards, so
row counts differ by one at most (law ``rows``), and most buckets lie within one shard.

A record's bucket depends on seed, doc_id and text only, so reruns and lost tasks give the same
shards.  The number of buckets follows the input's bytes; only the row count of each bucket (one
number for BUCKET_BYTES of input) is gathered.

Defined results: a null text has no bytes; its crc32 is that of the empty text.  Rows with the
same doc_id are spread by their texts; equal rows lie in one bucket in any order, which cannot
be told apart.  An empty table gives empty shards.  Input columns are carried along unchanged,
but for columns named ``shard`` and ``slot``, which are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.llm.common import documents, small_batches
from dossier.session import scratch_path

SHARDS, SEED = 40, 8
#: Bytes of text that one bucket holds, about; it is shuffled in memory.
BUCKET_BYTES = 8 << 20
#: Bytes that a record counts besides its text (fixed value of the contract).
RECORD_BYTES = 16


def size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + RECORD_BYTES


def _scattered(docs: DataFrame, seed: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(buckets)).cast("int")


def fisher_yates(n: int, seed: tuple[int, ...]) -> np.ndarray:
    """A uniform permutation of range(n)."""
    draw = np.random.default_rng(seed)
    order = np.arange(n)
    swaps = draw.integers(0, np.arange(n, 0, -1))  # for place n - 1 - k, one of the n - k first
    for k, j in enumerate(swaps.tolist()):
        last = n - 1 - k
        order[last], order[j] = order[j], order[last]
    return order


def shuffled(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``docs`` with shard and slot (place in the shard, gapless from 0)."""
    small_batches(spark)
    docs = docs.drop("shard", "slot")
    names = docs.columns
    total = docs.agg(F.sum(size()).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    rows, buckets = total.rows, max(1, -(-(total.bytes or 0) // BUCKET_BYTES))
    # internal columns stand first, so names of the input cannot clash with them
    keyed = docs.select(_scattered(docs, seed, buckets).alias("shard"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    counts = keyed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))  # a row per bucket
    starts = counts.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("slot"))
    out = keyed.join(starts, "shard").select("shard", "slot", "row.*")
    schema = out.schema

    def shuffle(bucket: pa.Table) -> pa.Table:
        start, key = bucket.column(1)[0].as_py(), bucket.column(0)[0].as_py()
        # an order of the bucket's rows that does not rest on how they came in
        held = pa.table([bucket.column("doc_id"), bucket.column("text")], names=["doc_id", "text"])
        fixed = pc.sort_indices(held, sort_keys=[("doc_id", "ascending"), ("text", "ascending")]).to_numpy()
        order = fixed[fisher_yates(len(fixed), (seed, key))]
        place = start + np.arange(len(order), dtype=np.int64)
        shard = place * shards // rows
        slot = place - -(-shard * rows // shards)
        done = bucket.take(pa.array(order))
        return pa.table([pa.array(shard, pa.int32()), pa.array(slot, pa.int64()), *done.columns[2:]], names=schema.names)

    return out.groupBy("shard").applyInArrow(shuffle, schema).select(*[f"`{c}`" for c in names], "shard", "slot")


def write(spark: SparkSession, docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write the shards of ``docs`` as folders shard=0, shard=1, ...; rows carry their slot."""
    shuffled(spark, docs, shards, seed).write.partitionBy("shard").parquet(path)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = documents(spark, sf_dir), scratch_path(spark, "shards")
    write(spark, docs, path)
    text = F.coalesce("text", F.lit(""))
    stored = spark.read.schema("doc_id long, text string, slot long, shard int").parquet(path)
    return stored.select(
        "doc_id", size().alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
