"""Filter interaction audit (11) by contractions of contingency tensors.

What a chain of filters removes depends on their order.  Per part of the corpus, documents are
counted once by which filters they fail: 2 x 2 x 2 x 2 x 2 cells for five filters, whatever the
corpus.  Everything else is read off this tensor: along each axis einsum selects documents that
pass the filter, that fail it, or all of them.  With ``before`` the filters ahead of a step's own:

* kept: pass along before and its own, all along the rest; removed: pass along before, fail its own;
* redundant: all that fail its own, less the removed; unique_fails: fail its own, pass the rest;
* good_lost, toxic_lost: removed, in the tensors of good and of toxic documents;
* shapley: its removed, summed over all orders.

Documents are read once, by built-in functions, into narrow rows (doc_id, digest, part, flags).
Rows of one doc_id and text meet in the map tasks first.  A text's digest is its SHA-256; the
least doc_id of each digest is a table of its own, so that the join with it can split a hot group
of copies.  A part has 2 ** filters cells at most, so its tensor is one small row, and parts are
contracted in any task.

Defined results: a null text counts as empty, a null part as the empty string.  Words are runs of
``[^\\x20\\x09-\\x0D]``.  A row without doc_id has no smaller doc_id beside it, so it never fails E,
and it has no label.  Repeated rows count each; none of them makes another fail E, since their
doc_id is the same.  A document is good or toxic if any of its labels says so.  Null flags count as
passing.  An empty table gives an empty result.  Other columns, of any name, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.common import SPACE_RE, documents, let, words_of, written
from dossier.sources.tables import table

FILTERS = "ABCDE"
#: Parts that are contracted together; each gives orders x filters rows.
PARTS = 128
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def flags(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, part, n (rows alike) and the booleans A to E: true where the filter fails."""
    of_words = let(words_of(F.col("text")), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))
    rows = (docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
            .select("doc_id", "part", "text", of_words.alias("w"))
            .select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                    F.expr("w.n < 200").alias("A"), F.expr("100 * w.distinct < 50 * w.n").alias("B"),
                    (100 * F.regexp_count("text", F.lit("[A-Z]")) > 2 * F.length("text")).alias("C"),
                    F.col("text").rlike(r"[#$%&*|]").alias("D")))
    alike = written(spark, rows.groupBy(rows.columns).agg(F.count(F.lit(1)).alias("n")), "audit-rows")
    # written, so that the join below may split a hot digest
    first = written(spark, alike.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                    .where("first < last").drop("last"), "audit-first")
    return (alike.join(first, "digest", "left")
            .withColumn("E", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
            .select("doc_id", "part", "n", *FILTERS))


def labelled(spark: SparkSession, flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """``flagged`` with the booleans good and toxic of the document's labels."""
    says = (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    return flagged.join(written(spark, says, "audit-labels"), "doc_id", "left")


def tensors(flagged: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part: its cells (cell, n, good, toxic); the first filter is the cell's highest bit."""
    cell = sum((F.coalesce(F.col(f), F.lit(False)).cast("int") * (1 << k) for k, f in enumerate(reversed(filters))), F.lit(0))
    held = flagged.groupBy("part", cell.alias("cell")).agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col(x), F.col("n")).otherwise(0)).alias(x) for x in ("good", "toxic")])
    return held.groupBy("part").agg(F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("cells"))


def contracted(tensor: np.ndarray, filters: str) -> Iterator[tuple[str, int, list[np.ndarray]]]:
    """(order, step, counts by part) of a tensor (parts, 3, 2, 2, ...): all, good and toxic documents."""
    choose = {"pass": np.array([1, 0]), "fail": np.array([0, 1]), "all": np.array([1, 1])}
    axes = list(range(2, 2 + len(filters)))

    @cache
    def select(passed: frozenset, failed: str) -> np.ndarray:
        along = ["pass" if f in passed else "fail" if f == failed else "all" for f in filters]
        vectors = [x for axis, how in zip(axes, along) for x in (choose[how], [axis])]
        return np.einsum(tensor, [0, 1, *axes], *vectors, [0, 1])

    orders = ["".join(o) for o in permutations(filters)]
    before = {(o, k): frozenset(o[:k]) for o in orders for k in range(len(filters))}
    shapley = {f: sum(select(before[o, o.index(f)], f)[:, 0] for o in orders) for f in filters}
    for o in orders:
        for k, f in enumerate(o):
            removed = select(before[o, k], f)
            yield o, k + 1, [select(before[o, k] | {f}, "")[:, 0], removed[:, 0],
                             select(frozenset(), f)[:, 0] - removed[:, 0],
                             select(frozenset(filters) - {f}, f)[:, 0], removed[:, 1], removed[:, 2], shapley[f]]


def audit(flagged: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from rows (part, n, one boolean per filter, good, toxic)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, cells = batch.column(0), batch.column(1).to_pylist()
            for at in range(0, len(parts), PARTS):
                some = cells[at:at + PARTS]
                tensor = np.zeros((len(some), 3, 1 << len(filters)), dtype=np.int64)
                for p, held in enumerate(some):
                    for c in held:
                        tensor[p, :, c["cell"]] = c["n"], c["good"], c["toxic"]
                found = list(contracted(tensor.reshape(len(some), 3, *[2] * len(filters)), filters))
                columns = [pa.array(np.concatenate(x)) for x in zip(*(counts for _, _, counts in found))]
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([parts.slice(at, PARTS)] * len(found)),
                     pa.array(np.repeat([o for o, _, _ in found], len(some)), pa.string()),
                     pa.array(np.repeat(np.array([k for _, k, _ in found], np.int32), len(some))), *columns],
                    names=["part", "filter_order", "step", *COUNTS])

    return tensors(flagged, filters).mapInArrow(run, SCHEMA)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(labelled(spark, flags(spark, documents(spark, sf_dir)), table(spark, sf_dir, "labels")))


def _sum(what: str, where: str) -> str:
    return f"CAST(sum(CASE WHEN {where} THEN {what} ELSE 0 END) AS BIGINT)"


SQL = rf"""
WITH l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{SPACE_RE}'), lambda x: x <> '') AS ws FROM d),
f AS (SELECT doc_id, part,
             CASE WHEN len(ws) < 200 THEN 16 ELSE 0 END
             + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 8 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 2 ELSE 0 END
             + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 1 ELSE 0 END AS cell FROM w),
cells AS (SELECT part, cell, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
          FROM f LEFT JOIN l USING (doc_id) GROUP BY part, cell),
letters(name, bit) AS (VALUES ('A', 16), ('B', 8), ('C', 4), ('D', 2), ('E', 1)),
orders AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
           FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, bits[s] AS own, CAST(coalesce(list_sum(bits[1:s - 1]), 0) AS INTEGER) AS ahead
          FROM orders, range(1, 6) t(s)),
counted AS (SELECT part, filter_order, step, own,
    {_sum('n', 'cell & (ahead + own) = 0')} AS kept, {_sum('n', 'cell & ahead = 0 AND cell & own > 0')} AS removed,
    {_sum('n', 'cell & ahead > 0 AND cell & own > 0')} AS redundant, {_sum('n', 'cell = own')} AS unique_fails,
    {_sum('good', 'cell & ahead = 0 AND cell & own > 0')} AS good_lost,
    {_sum('toxic', 'cell & ahead = 0 AND cell & own > 0')} AS toxic_lost
    FROM steps, cells GROUP BY ALL)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM counted
"""
