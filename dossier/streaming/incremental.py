"""Incremental snapshot load on Structured Streaming (S-17 + K-02 as a stream).

The reference polls for dated snapshots newer than the target's high-water
mark and upserts them in date order.  Here the file source tracks which
snapshot files were already consumed (its checkpoint is the high-water
mark), ``trigger(availableNow=True)`` processes everything new and stops,
and ``foreachBatch`` adds each micro-batch to the load's pending rows.  When
the stream has stopped, all pending rows are upserted into the target at once.

The target is partitioned by a hash bucket of the key
(``<target>/bucket=<b>/``), and so are the pending rows of every micro-batch
(``<target>.pending/micro_batch=<id>/bucket=<b>/``).  The upsert reads only
the buckets that have pending rows (partition pruning), merges both (per key the
row with the newest ``load_date``, then the full row), materialises the
result with ``checkpoint()`` where it replaces files that it reads,
rewrites just those buckets with dynamic partition overwrite, and deletes
the pending rows.  So a row is written a fixed number of times, however many
micro-batches a load has, and the state is rewritten once per load.
A micro-batch that runs again (after an executor or driver loss) replaces its
own folder, and pending rows that a broken load left are merged by the next
one; merging rows again yields the same state, so the load is idempotent.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dossier.operators.pick import dedupe_latest
from dossier.sources.snapshots import delete_dir, list_dirs

BUCKET, BATCH = "bucket", "micro_batch"
STATE_BUCKETS = 256
#: Tasks that one bucket's rows are dealt into when they are merged.
SPREAD = 4


def _bucket(keys: Sequence[str], n: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def _has_buckets(spark: SparkSession, path: str) -> bool:
    return any(d.startswith(f"{BUCKET}=") for d in list_dirs(spark, path))


def latest_state(spark: SparkSession, target: str) -> DataFrame | None:
    """The target state after the last load (without the bucket column), or None before the first."""
    if not _has_buckets(spark, target):
        return None
    return spark.read.parquet(target).drop(BUCKET)


def _pending(target: str) -> str:
    return f"{target.rstrip('/')}.pending"


def _add_batch(target: str, keys: Sequence[str], buckets: int):
    def run(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn(BUCKET, _bucket(keys, buckets)).repartition(BUCKET)
         .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{_pending(target)}/{BATCH}={batch_id}"))
    return run


def _merge_pending(spark: SparkSession, target: str, keys: Sequence[str], date_col: str) -> None:
    """Upsert all pending rows into the target, and delete them."""
    path = _pending(target)
    if any(_has_buckets(spark, f"{path}/{d}") for d in list_dirs(spark, path)):
        both = added = spark.read.parquet(path).drop(BATCH)
        based = _has_buckets(spark, target)
        if based:
            # the touched bucket ids: at most ``buckets`` small integers
            touched = [r[0] for r in added.select(BUCKET).distinct().collect()]
            both = spark.read.parquet(target).where(F.col(BUCKET).isin(touched)).unionByName(added)
        spread = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(1)), F.lit(SPREAD))
        dealt = both.withColumn("__spread", spread).repartition(BUCKET, "__spread")
        merged = dedupe_latest(dealt, [BUCKET, "__spread", *keys], [F.col(date_col).desc()]).drop("__spread")
        if based:
            merged = merged.checkpoint(eager=True)  # the overwrite must not read the files it replaces
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(target))
    delete_dir(spark, path)


def incremental_snapshot_load(spark: SparkSession, source: str, schema: StructType, target: str,
                              checkpoint: str, keys: Sequence[str], date_col: str = "load_date",
                              max_files_per_trigger: int | None = None,
                              buckets: int = STATE_BUCKETS) -> DataFrame:
    """Consume every new snapshot file under ``source`` and return the merged target state.

    ``source`` is a version folder with ``load_date=...`` partitions; the
    streaming file source needs the schema up front (partition column
    included).  Blocks until all currently available files are processed.
    """
    reader = spark.readStream.schema(schema).option("basePath", source)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source)
    _merge_pending(spark, target, keys, date_col)  # of a load that broke off
    q = (stream.writeStream.foreachBatch(_add_batch(target, keys, buckets))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    _merge_pending(spark, target, keys, date_col)
    state = latest_state(spark, target)
    if state is None:
        raise RuntimeError("no snapshot files found")
    return state
