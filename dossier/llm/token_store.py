"""Token-ID / binary output (1): documents compressed one by one with a shared dictionary.

Store layout, below one folder, all written through Spark's file commit:

* ``dictionary``: the shared zstandard dictionary (bytes, sha256), trained on the serialised id
  arrays of a bounded sample of documents;
* ``blocks``: files in ascending doc_id order; a row is a block of consecutive documents with
  first_doc_id, last_doc_id, doc_ids, n_tokens, offsets and frames.  Each document is one
  zstandard frame inside ``frames``; its offset is in ``offsets``.  ``dictionary_sha256`` names
  the dictionary, and reading with another one fails.  A single document is found by the
  statistics of first_doc_id and last_doc_id and takes one frame to decode;
* ``shards``: per block file, the number of ids in all files before.

Ids are little-endian unsigned 32-bit integers; every document ends with ``END_ID``.

Defined results: null and empty texts have the end id alone.  A null doc_id sorts first.
Repeated rows are stored as often as they come.  An empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.llm.bpe import byte_of_char
from dossier.llm.common import documents, small_batches, written
from dossier.llm.pieces import ColumnPieceEncoder
from dossier.session import scratch_path

END_ID = 2
#: The dictionary is trained on this many documents (those with the least doc_id hashes), the
#: first ids of each, and has at most this many bytes.
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 512, 4096, 1 << 16
#: A block ends at this many documents or compressed bytes.
BLOCK_DOCS, BLOCK_BYTES = 256, 1 << 20
LEVEL = 3
#: Words and pieces that a worker remembers.
KNOWN_WORDS, KNOWN_PIECES = 600_000, 250_000
#: A plain piece: letters of Latin or Cyrillic, then marks; the pre-tokenizer parts them just there.
SIMPLE = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ԯ]+)([!-/:-@\[-`{-~]*)\Z")
BLOCK_SCHEMA = ("shard int, start_in_shard long, first_doc_id long, last_doc_id long, n_ids long, "
                "dictionary_sha256 string, doc_ids array<long>, n_tokens array<long>, offsets array<long>, frames binary")


@lru_cache(maxsize=2)
def _encoder(path: str) -> ColumnPieceEncoder:
    """Piece by piece through the tokenizers library; once per worker."""
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    added = next(iter(tokenizer.get_added_tokens_decoder().items()))
    model, cut = tokenizer.model.tokenize, regex.compile(public_tokenizers.PATTERN).findall
    shown = {byte: char for char, byte in byte_of_char().items()}  # how the model's vocabulary writes bytes
    known: dict[str, bytes] = {}  # words of pieces: a word with a comma is a new piece, not a new word

    space, id_of = shown[32], attrgetter("id")

    def of_word(word: str) -> bytes:
        ids = known.get(word)
        if ids is None:
            if len(known) > KNOWN_WORDS:
                known.clear()
            # of printable ASCII only the space is written as another character
            written_out = (word.replace(" ", space) if word.isascii() and word.isprintable()
                           else word.encode().decode("latin-1").translate(shown))
            ids = known[word] = array("I", map(id_of, model(written_out))).tobytes()
        return ids

    def of_piece(piece: str) -> bytes:
        simple = SIMPLE.match(piece)
        if not simple:
            return b"".join(map(of_word, cut(piece)))
        word, marks = simple.groups()
        return of_word(word) + of_word(marks) if marks else of_word(word)

    return ColumnPieceEncoder(of_piece, (added[1].content, np.array([added[0]], dtype="<u4").tobytes()), KNOWN_PIECES)


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """doc_id and the id bytes of batches of (doc_id, text), the end id included."""
    encoder, end = _encoder(vocabulary), np.array([END_ID], dtype="<u4").tobytes()
    for batch in batches:
        yield batch.column(0), [x + end for x in encoder.encode_column(batch.column(1))]


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and the id bytes of its whole text, the end id included."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, ids in _encoded(batches, vocabulary):
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def train_dictionary(docs: DataFrame, vocabulary: str) -> bytes:
    """The shared dictionary, from a bounded sample; empty if the sample is too small to train on."""
    least = docs.select("doc_id", "text").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    ids = encode(least, vocabulary).select(F.expr(f"substring(ids, 1, {4 * SAMPLE_IDS})").alias("ids"))
    samples = [bytes(r.ids) for r in ids.collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}


def write(spark: SparkSession, docs: DataFrame, path: str, vocabulary: str) -> None:
    """Write the store of ``docs`` (doc_id, text) to the folder ``path``."""
    data = train_dictionary(docs, vocabulary)
    digest = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(digest, bytearray(data))], "sha256 string, data binary").coalesce(1) \
        .write.parquet(f"{path}/dictionary")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL, **_dictionary(data)).compress
        for doc_id, ids in _encoded(batches, vocabulary):
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(pack, ids), pa.binary())],
                names=["doc_id", "n_tokens", "frame"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, start = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            nonlocal start
            ids, counts, frames = zip(*held)
            row = (shard, start, ids[0], ids[-1], sum(counts), digest, ids, counts,
                   np.cumsum([0, *map(len, frames)]).tolist(), b"".join(frames))
            start += sum(counts)
            held.clear()
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                     *[pa.list_(pa.int64())] * 3, pa.binary()]
            names = [x.split(" ")[0] for x in BLOCK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)

        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                size += len(row[2])
                if len(held) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield block()
                    size = 0
        if held:
            yield block()

    # compressed documents are written before they are dealt out by range, which reads them twice
    small_batches(spark)
    frames = written(spark, docs.select("doc_id", "text").mapInArrow(compress, "doc_id long, n_tokens long, frame binary"),
                     "token-frames")
    size = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    shards = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), size >> 20), size >> 28)
    (frames.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(f"{path}/blocks"))
    # one row per block file
    ends = (spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").groupBy("shard")
            .agg(F.sum("n_ids").alias("n_ids")))
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    ends.withColumn("start", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{path}/shards")


def read(spark: SparkSession, path: str, doc_id: int | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it) and its id bytes; of one document or all."""
    digest, data = spark.read.schema("sha256 string, data binary").parquet(f"{path}/dictionary").first()
    data = bytes(data)
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError(f"the dictionary below {path} is damaged")
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    if doc_id is not None:
        blocks = blocks.where((F.col("first_doc_id").isNull() | (F.col("first_doc_id") <= doc_id)) & (F.col("last_doc_id") >= doc_id))
    # one row per block file: the number of files is bounded by the shuffle partitions or by size
    shards = spark.read.schema("shard int, n_ids long, start long").parquet(f"{path}/shards").select("shard", "start")
    rows = blocks.join(shards, "shard").select(
        (F.col("start") + F.col("start_in_shard")).alias("start"), "dictionary_sha256",
        "doc_ids", "n_tokens", "offsets", "frames")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_frame = zstandard.ZstdDecompressor(**_dictionary(data)).decompress
        for one in (batch.slice(k, 1) for batch in batches for k in range(batch.num_rows)):
            for start, named, ids, counts, offsets, frames in zip(*(c.to_pylist() for c in one.columns)):
                if named != digest:
                    raise ValueError(f"a block needs the dictionary {named}")
                starts = np.cumsum([start, *counts])[:-1]
                rows = [k for k, x in enumerate(ids) if doc_id is None or x == doc_id]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[k] for k in rows], pa.int64()), pa.array(starts[rows], pa.int64()),
                     pa.array([open_frame(frames[offsets[k]:offsets[k + 1]]) for k in rows], pa.binary())],
                    names=["doc_id", "start", "ids"])

    return rows.mapInArrow(unpack, "doc_id long, start long, ids binary")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = scratch_path(spark, "token-store")
    write(spark, documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, path).select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
