"""Mixing sources to target weights (7) by weighted fair queueing.

Every source is a queue of shuffled documents that is read up to ``COPIES`` times.  A copy's
virtual finish time is the number of its source's words up to and including it, divided by the
source's target.  The mix is all copies in order of finish time, cut at the total budget, so at
any point each source has had its share.

Targets: sources in order of code point (null last) weigh 5, 2, 1, 5, 2, 1, ... and share all
words; a target stops at ``COPIES`` times its source's words and the excess is shared among the
others by weight until none is above.

Scale: a document's place in its queue is a running sum over buckets of its shuffle key, then
within its bucket, so a source with a third of all rows is spread over many tasks.  The cut is
found in a histogram of finish times; the one cell that holds it is divided again until it is small.

Defined results: null and blank texts have size 0; they take no words and come for free at
their place in the queue.  A null source is a source of its own.  Repeated rows are documents of
their own.  The shuffle key depends on doc_id and seed only, so reruns agree.  Documents are
whole: the cut leaves out the first document that would exceed the budget and all after it.
Input columns are carried in a struct and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.llm.common import SPACE_RE, documents, words_of, written

WEIGHTS = (5, 2, 1)
COPIES = 3
SEED = "mix-1"
#: Documents of a source that one bucket of its queue holds, about.
BUCKET_DOCS = 20_000
#: Cells of a histogram of finish times.  The cell of the cut is divided again until it holds at
#: most CELL_ROWS copies, or copies of one finish time.
CELLS, CELL_ROWS = 4096, 50_000


def targets(sources: list[tuple[str | None, int]], weights=WEIGHTS, copies: int = COPIES) -> dict[str | None, float]:
    """Target words of each source from (source, words), by water filling."""
    order = sorted(sources, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    weight = {s: weights[k % len(weights)] for k, (s, _) in enumerate(order)}
    words = dict(order)
    left, open_sources, out = float(sum(words.values())), list(words), {}
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        share = {s: left * weight[s] / total for s in open_sources}
        full = [s for s in open_sources if share[s] > copies * words[s]]
        if not full:
            return out | share
        for s in full:
            out[s] = float(copies * words[s])
            left -= out[s]
            open_sources.remove(s)
    return out


def _rows(docs: DataFrame, size: Column, digits: int) -> DataFrame:
    key = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null"))))
    return (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), size.alias("size"))
            .select("row", "size", F.col("row.source").alias("source"), key.alias("key"))
            .withColumn("bucket", F.substring("key", 1, digits)))


def queued(spark: SparkSession, docs: DataFrame, size: Column) -> tuple[DataFrame, int]:
    """Every row with its place in its source's queue (``upto``), source_size and target; the budget."""
    counts = docs.agg(F.count(F.lit(1))).first()[0]
    digits = 1
    while 16 ** digits * BUCKET_DOCS < counts:
        digits += 1
    rows = _rows(docs, size, digits)
    sums = written(spark, rows.groupBy("source", "bucket").agg(F.sum("size").alias("n")), "mix-buckets")
    by_source = [(r.source, r.n) for r in sums.groupBy("source").agg(F.sum("n").alias("n")).collect()]
    goal = targets(by_source)
    weighed = spark.createDataFrame([(s, n, goal[s]) for s, n in by_source],
                                    "source string, source_size long, target double")
    earlier = F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = (sums.withColumn("before", F.coalesce(earlier, F.lit(0)))
              .join(F.broadcast(weighed), sums["source"].eqNullSafe(weighed["source"]))  # a row per source
              .select(sums["source"].alias("s"), F.col("bucket").alias("b"), "before", "source_size", "target"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", F.col("row.doc_id"), "size") \
        .rowsBetween(Window.unboundedPreceding, 0)
    out = (rows.withColumn("upto", F.sum("size").over(inside))
           .join(starts, rows["source"].eqNullSafe(starts["s"]) & (F.col("bucket") == F.col("b")))
           .select("row", "source", "key", "size", "source_size", "target", (F.col("before") + F.col("upto")).alias("upto")))
    return written(spark, out, "mix-queue"), sum(n for _, n in by_source)


def _finish(copy: int) -> Column:
    return (F.lit(copy) * F.col("source_size") + F.col("upto")) / F.col("target")


def _cut(copies: DataFrame, budget: int):
    """The first copy in finish order that the budget leaves out, and the order; None: none."""
    low, high, before = 0.0, 2.0, 0
    inside = copies
    while True:
        scale = CELLS / (high - low)
        cell = F.least(F.floor((F.col("finish") - low) * scale), F.lit(CELLS))  # the last: all times from high on
        held = inside.groupBy(cell.alias("cell")).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows"),
                                                      F.min("finish").alias("low"), F.max("finish").alias("high"))
        upto = F.sum("n").over(Window.orderBy("cell"))  # at most CELLS + 1 rows
        hit = held.withColumn("upto", upto).where(F.col("upto") > budget - before).orderBy("cell").first()
        if hit is None:
            return None
        before += hit.upto - hit.n
        inside = copies.where(F.col("finish").between(hit.low, hit.high))
        if hit.rows <= CELL_ROWS or hit.low == hit.high:
            break
        low, high = hit.low, hit.high
    run = F.sum("size").over(Window.orderBy(*ORDER))
    return inside.withColumn("run", run).where(F.col("run") > budget - before).orderBy(*ORDER).first()


#: The order of copies; it is total up to equal rows.
ORDER = ["finish", "copy", "key", "doc_id", "size", "source"]


def mix(spark: SparkSession, docs: DataFrame, size: Column) -> DataFrame:
    """Every input row (struct ``row``) with size, source_size, target and copies (0 to COPIES)."""
    rows, budget = queued(spark, docs, size)
    every = F.array(*[F.struct(F.lit(k).alias("copy"), _finish(k).alias("finish")) for k in range(COPIES)])
    copies = rows.where("size > 0 AND target > 0").select(
        "size", "key", F.col("row.doc_id").alias("doc_id"), "source", F.explode(every).alias("c")) \
        .select("size", "key", "doc_id", "source", "c.*")
    cut = _cut(copies, budget)

    def taken(copy: int) -> Column:
        here = (F.col("size") > 0) & (F.col("target") > 0)
        if cut is None:
            return here
        least = -(1 << 63)  # null doc_id
        mine = (_finish(copy), F.lit(copy), F.col("key"), F.coalesce(F.col("row.doc_id"), F.lit(least)),
                F.col("size"), F.coalesce(F.col("source"), F.lit("")))
        first = (cut.finish, cut["copy"], cut.key, least if cut.doc_id is None else cut.doc_id, cut["size"], cut.source or "")
        types = ("double", "int", "string", "long", "long", "string")
        at = F.struct(*[x.cast(t).alias(f"k{i}") for i, (x, t) in enumerate(zip(mine, types))])
        first_left = F.struct(*[F.lit(x).cast(t).alias(f"k{i}") for i, (x, t) in enumerate(zip(first, types))])
        return here & (at < first_left)

    n = sum((taken(k).cast("int") for k in range(1, COPIES)), taken(0).cast("int"))
    free = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.coalesce(n, F.lit(0)))
    return rows.select("row", "source", "key", "size", "source_size", "target", "upto", free.alias("copies"))


def words(text: str = "text") -> Column:
    return F.size(words_of(F.col(text))).cast("long")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", words().alias("size"))
    mixed = mix(spark, docs, F.col("size"))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE_RE}'), lambda x: x <> '')) AS size
  FROM documents),
w AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
         list_extract({list(WEIGHTS)}, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS INT)) AS w
  FROM d GROUP BY source),
-- in order of words per weight, a source is full if its share of what the ones before leave is too much
f AS (
  SELECT *, {COPIES} * n < ((SELECT sum(n) FROM w) - coalesce(sum({COPIES} * n) OVER before, 0))
                           / CAST(sum(w) OVER rest AS DOUBLE) * w AS is_full
  FROM w
  WINDOW before AS (ORDER BY n / CAST(w AS DOUBLE), source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY n / CAST(w AS DOUBLE), source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
t AS (
  SELECT source, n, CASE WHEN is_full THEN CAST({COPIES} * n AS DOUBLE) ELSE
         CAST((SELECT sum(n) FROM w) - (SELECT coalesce(sum({COPIES} * n), 0) FROM f WHERE is_full) AS DOUBLE) * w
         / (SELECT sum(w) FROM f WHERE NOT is_full) END AS target
  FROM f),
q AS (
  SELECT d.*, n, target, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                                              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, (copy * n + upto) / target AS finish
      FROM (SELECT *, unnest(range({COPIES})) AS copy FROM q WHERE size > 0 AND target > 0)),
r AS (SELECT rid, size, sum(size) OVER (ORDER BY finish, copy, key, doc_id, size, source ROWS UNBOUNDED PRECEDING) AS run FROM c),
k AS (SELECT rid, sum(size) AS taken FROM r WHERE run <= (SELECT sum(n) FROM w) GROUP BY rid)
SELECT doc_id, size, n AS source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN k USING (rid)
"""
