"""Exact dedup (4) by an extendible-hash index kept in shared files. DataFrame functions only.

1. Entries.  Rows are pre-aggregated on (fingerprint, digest, text): copies meet inside each
   map task first, so a group with a third of all rows sends one row per task, and grouping on
   the text itself compares bytes.  Entries are written without their text.
2. Directory.  Fingerprints are counted in cells of their first ``LEVEL_BITS`` bits.  A bucket
   starts at depth 0 and splits by one more bit (its directory doubles) until it holds at most
   ``capacity`` entries.  A cell that is still overfull gets the next ``LEVEL_BITS`` bits.  Equal
   fingerprints cannot be split; they form a chain.
3. Index.  Entries are range-partitioned by (bucket, fingerprint), so each owner task writes a
   run of key ranges and gives every entry its place in the chain of its fingerprint.
4. Lookup.  A row looks up (fingerprint, digest).  Where several texts share both, rows of
   those keys are compared with the entries' whole texts, so no digest is trusted.

Defined results: null counts as the empty text.  Of rows with equal texts the one with the
largest doc_id stays; a null doc_id is smaller than any other.  Of repeated rows with that
doc_id exactly one stays.  An empty table gives an empty result.  Other columns, of any name,
are carried in a struct and cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.llm.common import documents, written

#: Bits of the fingerprint that one directory level reads: at most 65,536 cells at the first.
LEVEL_BITS = 16
#: Entries that a bucket holds before it splits.
CAPACITY = 100_000

Key = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _keyed(docs: DataFrame, fingerprint: Key, digest: Key) -> DataFrame:
    """row (the input row without its text), text, no_text (it was null), doc_id, fp, digest."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    return (docs.select(row, F.coalesce("text", F.lit("")).alias("text"), F.isnull("text").alias("no_text"))
            .withColumns({"doc_id": F.col("row.doc_id"), "fp": fingerprint(F.col("text")),
                          "digest": digest(F.col("text"))}))


def _unkeyed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The input rows of ``_keyed`` again."""
    text = F.when(~F.col("no_text"), F.col("text")).alias("text")
    return rows.select(*[text if c == "text" else F.col(f"row.`{c}`") for c in columns])


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned("fp", 64 - bits) if bits else F.lit(0).cast("long")


def directory(spark: SparkSession, entries: DataFrame, capacity: int) -> list[DataFrame]:
    """Per level: (cell, depth, bucket); depth is null where the next level splits further."""
    levels, pending = [], entries.select("fp")
    for low in range(0, 64, LEVEL_BITS):
        high = low + LEVEL_BITS
        cells = written(spark, pending.groupBy(_prefix(high).alias("cell"))
                        .agg(F.count(F.lit(1)).alias("n")), "dedup-cells")
        # each cell at every depth: the bucket it would share, and how many entries that holds
        at = (cells.select("cell", "n", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
              .withColumn("bucket", F.expr(f"shiftrightunsigned(cell, {high} - depth)")))
        fits = at.groupBy("depth", "bucket").agg(F.sum("n").alias("held")).where(F.col("held") <= capacity)
        placed = at.join(fits, ["depth", "bucket"]).groupBy("cell").agg(F.min("depth").alias("depth"))
        last = F.lit(high) if high == 64 else F.lit(None).cast("int")
        level = (cells.join(placed, "cell", "left").withColumn("depth", F.coalesce("depth", last))
                 .withColumn("bucket", F.expr(f"shiftrightunsigned(cell, {high} - depth)"))
                 .select("cell", "depth", "bucket"))
        levels.append(written(spark, level, "dedup-directory"))
        over = levels[-1].where(F.col("depth").isNull()).select("cell")
        if over.isEmpty():
            break
        pending = pending.withColumn("cell", _prefix(high)).join(over, "cell", "left_semi").select("fp")
    return levels


def build_index(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY,
                fingerprint: Key = F.xxhash64, digest: Key = sha256) -> tuple[DataFrame, DataFrame]:
    """(entries with their texts, index); the index is in shared files, the entries are a plan.

    Only texts that share fp and digest with another are ever asked of the entries.

    The index has one row per distinct text: bucket, depth, fp, chain, digest, same_digest (how
    many texts share fp and digest), keep_id, group_size.
    """
    entries = (_keyed(docs, fingerprint, digest).groupBy("fp", "digest", "text")
               .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    narrow, placed = written(spark, entries.drop("text"), "dedup-entries"), None
    for k, level in enumerate(directory(spark, narrow, capacity)):
        here = level.where(F.col("depth").isNotNull())
        here = F.broadcast(here) if k == 0 else here  # the first level has 65,536 cells at most
        rows = narrow.withColumn("cell", _prefix((k + 1) * LEVEL_BITS)).join(here, "cell").drop("cell")
        placed = rows if placed is None else placed.unionByName(rows)
    chain = Window.partitionBy("bucket", "depth", "fp")
    index = (placed.repartitionByRange("bucket", "depth", "fp")
             .withColumn("chain", F.row_number().over(chain.orderBy("digest", "keep_id")))
             .withColumn("same_digest", F.count(F.lit(1)).over(
                 Window.partitionBy("bucket", "depth", "fp", "digest"))))
    return entries, written(spark, index, "dedup-index")


def _by_id(id_column: str, prefix: str = "") -> dict[str, Column]:
    """A doc_id as two columns without nulls, for a join that its rows stay dealt by."""
    return {f"{prefix}id": F.coalesce(F.col(id_column).cast("string"), F.lit("")),
            f"{prefix}no_id": F.isnull(id_column)}


def _lookup(rows: DataFrame, entries: DataFrame, index: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` joined to their entry; ``more`` names columns of ``_by_id`` that must be the kept row's."""
    def on(a: DataFrame, b: DataFrame, keys) -> DataFrame:
        b = b.select(*keys, "keep_id", "group_size").withColumnsRenamed({k: f"_{k}" for k in keys})
        b, keys = b.withColumns(_by_id("keep_id", "_")), [*keys, *more]
        return a.join(b, [a[k] == b[f"_{k}"] for k in keys]).drop("_id", "_no_id", *[f"_{k}" for k in keys])

    shared = index.where("same_digest > 1").select("fp", "digest").distinct()
    if shared.isEmpty():
        return on(rows, index, ["fp", "digest"])
    alone = on(rows, index.where("same_digest = 1"), ["fp", "digest"])
    compared = on(rows.join(shared, ["fp", "digest"], "left_semi").select(rows.columns),
                  entries.join(shared, ["fp", "digest"], "left_semi"), ["fp", "digest", "text"])
    return alone.unionByName(compared)


def membership(docs: DataFrame, entries: DataFrame, index: DataFrame,
               fingerprint: Key = F.xxhash64, digest: Key = sha256) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = _keyed(docs, fingerprint, digest)
    rows = rows.select("doc_id", "fp", "digest", "text", sha256(F.col("text")).alias("text_sha256"))
    # numbered before the lookup: rows are dealt by doc_id too, and the lookup's join can be split
    same = Window.partitionBy("fp", "digest", "doc_id", "text_sha256")
    hit = _lookup(rows.withColumn("nth", F.row_number().over(same.orderBy("doc_id"))), entries, index)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return hit.withColumn("kept", kept).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def survivors(docs: DataFrame, entries: DataFrame, index: DataFrame,
              fingerprint: Key = F.xxhash64, digest: Key = sha256) -> DataFrame:
    """The input rows that stay, with all their columns.

    The lookup includes doc_id = keep_id, so a hot group's rows are spread by their doc_id.
    """
    rows = _keyed(docs, fingerprint, digest).withColumns(_by_id("doc_id"))
    hit = _lookup(rows, entries, index, ("id", "no_id"))
    # the join is dealt by these columns, so the texts need no second shuffle here
    same = Window.partitionBy("fp", "digest", "id", "no_id", "text")
    hit = hit.withColumn("nth", F.row_number().over(same.orderBy("doc_id"))).where("nth = 1")
    return _unkeyed(hit, docs.columns)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return membership(docs, *build_index(spark, docs))


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
