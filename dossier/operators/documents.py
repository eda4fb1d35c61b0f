"""Nested client documents and text (D-01, D-02, X-06..X-08)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.operators import ordered
from dossier.operators.ordered import CHUNK, add_chunks, chunk_borders, ordered_scan

MAX_DOCUMENT_CHARS = 2_000_000
#: D-01 starts a new part of a client's document (and of an order's lines) every so many JSON characters.
PART_CHARS = 1_000_000
#: Cells of the vector index (X-07), and how many vectors of a cell a query meets in one task.
PIVOTS, SLICE_ROWS = 8, 1_000_000


def nest(child: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """Collect child rows per key as a sorted array of structs (deterministic order).

    ``sort_array`` (no comparator lambda) keeps the plan canonical, so a
    nested frame used twice (size guard and collection) is computed once
    through exchange reuse.
    """
    return child.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))


def document_size_guard(docs: DataFrame, key: str, priority: Column, payload: Sequence[str],
                        max_chars: int = MAX_DOCUMENT_CHARS) -> DataFrame:
    """D-02: JSON length per record, drop records over ``max_chars``, then keep one record
    per key by ``priority`` (smaller first; ties by length then JSON text)."""
    js = F.to_json(F.struct(*[F.col(c) for c in payload]))
    x = docs.withColumn("json_length", F.length(js)).where(F.col("json_length") <= max_chars)
    w = Window.partitionBy(key).orderBy(priority, F.col("json_length"), js)
    return x.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= 1).drop("__rn")


def chunk_text(text: str | Column, max_chars: int, overlap: int) -> Column:
    """X-06: array of (chunk_no, start, chunk) with fixed-size character chunks and overlap.

    Chunks start every ``max_chars - overlap`` characters from 0 while the
    start is inside the text; the whole text is always covered.
    """
    if not 0 <= overlap < max_chars:
        raise ValueError("need 0 <= overlap < max_chars")
    step = max_chars - overlap
    t = F.col(text) if isinstance(text, str) else text
    n = F.length(t)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s, i: F.struct(i.alias("chunk_no"), s.alias("start"),
                                                     F.substring(t, s + 1, max_chars).alias("chunk")))


def l2_distance(a: Column, b: Column) -> Column:
    sq = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v))


def cosine_similarity(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                      lambda acc, v: acc + v)
    na = F.sqrt(F.aggregate(F.transform(a, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0),
                            lambda acc, v: acc + v))
    nb = F.sqrt(F.aggregate(F.transform(b, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0),
                            lambda acc, v: acc + v))
    return F.try_divide(dot, na * nb)


def _finite(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))


def _distance(a: Column, b: Column) -> Column:
    return F.when(F.size(a) == F.size(b), l2_distance(a, b)).otherwise(
        F.raise_error(F.lit("vectors of unequal length")).cast("double"))


def candidate_pairs(vectors: DataFrame, vec_id: str, vec: str, queries: DataFrame, query_id: str, query_vec: str,
                    k: int) -> DataFrame:
    """(qid, qv, id, v): the pairs that may be among the ``k`` nearest of their query.

    Every vector belongs to the cell of its nearest pivot (PIVOTS vectors with the least hashes of
    their ids) and keeps its distance to it.  In each cell k groups of vectors, dealt by hash, name
    their least such distance; with the query's distance to the pivot added, the k-th least of these
    sums bounds the k-th neighbour from above.  By the triangle inequality only vectors whose distance
    to the pivot is within that bound of the query's own are joined.  Cells are dealt out in slices of
    SLICE_ROWS vectors, so a cell may hold any share of them.
    """
    x = vectors.select(F.col(vec_id).alias("id"), F.col(vec).cast("array<double>").alias("v")).where(_finite(F.col("v")))
    pivots = x.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).agg(F.collect_list("v")).scalar()
    # not nullable, or the join's null checks would be pushed down and have all distances computed again
    inf = F.lit(float("inf"))
    near = F.coalesce(F.array_min(F.transform("pivots", lambda p, i: F.struct(
        F.coalesce(_distance(F.col("v"), p), inf).alias("d"), i.alias("cell")))), F.struct(inf.alias("d"), F.lit(-1).alias("cell")))
    placed = x.withColumn("pivots", pivots).withColumn("near", near).select("id", "v", "near.d", "near.cell")
    per_group = placed.groupBy("cell", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(k)).alias("g")).agg(
        F.min("d").alias("lo"), F.max("d").alias("hi"), F.count(F.lit(1)).alias("n"))
    per_cell = per_group.groupBy("cell").agg(
        F.collect_list("lo").alias("los"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.ceil(F.sum("n") / SLICE_ROWS).cast("int").alias("slices"))
    cells = per_cell.agg(F.collect_list(F.struct("cell", "los", "lo", "hi", "slices"))).scalar()

    q = (queries.select(F.col(query_id).alias("qid"), F.col(query_vec).cast("array<double>").alias("qv")).where(_finite(F.col("qv")))
         .withColumns({"pivots": pivots, "cells": cells})
         .withColumn("cells", F.transform("cells", lambda c: c.withField(
             "dq", _distance(F.col("qv"), F.get(F.col("pivots"), c["cell"])))))
         .withColumn("sums", F.flatten(F.transform("cells", lambda c: F.transform(c["los"], lambda lo: lo + c["dq"]))))
         .withColumn("bound", F.coalesce(F.get(F.array_sort("sums"), F.lit(k - 1)), inf))
         .select("qid", "qv", "bound", F.explode("cells").alias("c"))
         # distances are rounded, so the bound has some slack
         .withColumn("bound", F.col("bound") + (F.col("bound") + F.col("c.dq") + F.col("c.hi")) * 1e-9)
         .where("c.dq - c.hi <= bound AND c.lo - c.dq <= bound")
         .select("qid", "qv", F.col("c.cell").alias("q_cell"), F.expr("c.dq - bound").alias("from"),
                 F.expr("c.dq + bound").alias("to"), F.explode(F.sequence(F.lit(0), F.col("c.slices") - 1)).alias("q_slice")))
    mine = F.get(F.filter("cells", lambda c: c["cell"] == F.col("cell")), F.lit(0))
    dealt = (placed.withColumn("cells", cells).withColumn("mine", mine)
             .withColumn("slice", F.coalesce(F.pmod(F.xxhash64("id", F.lit(2)), F.col("mine.slices")).cast("int"), F.lit(0)))
             .select("id", "v", "d", "cell", "slice"))
    return dealt.join(q, (F.col("cell") == F.col("q_cell")) & (F.col("slice") == F.col("q_slice"))
                      & F.col("d").between(F.col("from"), F.col("to"))).select("qid", "qv", "id", "v")


def vector_top_k(vectors: DataFrame, vec_id: str, vec: str, queries: DataFrame, query_id: str, query_vec: str,
                 k: int = 5) -> DataFrame:
    """X-07: the ``k`` nearest vectors (L2) to every query vector, with cosine similarity; exact.

    Any number of queries: they are rows of a join (``candidate_pairs``).  Every task keeps k rows per
    query before the shuffle (partial window-group limit).  Ties go to the smaller id; vectors and
    queries that are null or have a null or non-finite component take no part; vectors of unequal
    length raise an error; a query has fewer rows where there are fewer vectors.
    """
    pairs = candidate_pairs(vectors, vec_id, vec, queries, query_id, query_vec, k)
    s = pairs.withColumn("l2_distance", l2_distance(F.col("qv"), F.col("v")))
    w = Window.partitionBy("qid").orderBy("l2_distance", "id")
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        F.col("qid").alias(query_id), F.col("id").alias(vec_id), "l2_distance",
        cosine_similarity(F.col("v"), F.col("qv")).alias("cosine_similarity"), "rank")


def entity_edges(df: DataFrame, owner: str, text: str, pattern: str = r"[A-Z][a-z]+") -> DataFrame:
    """X-08: one edge per (owner, distinct candidate entity token) over whole texts."""
    ents = df.select(owner, F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), 0)).alias("entity"))
    return ents.distinct()


def _array_json_length(n: Column, total: Column) -> Column:
    """Length of ``[e1,e2,...]`` from the element count and the summed element lengths."""
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.lit(2)).otherwise(total + n + 1)


def build_documents_2(parent: DataFrame, key: str, mid: DataFrame, mid_id: str, mid_fields: Sequence[str],
                      sub: DataFrame, sub_fields: Sequence[str], mid_name: str, sub_name: str,
                      max_chars: int = MAX_DOCUMENT_CHARS) -> tuple[DataFrame, DataFrame]:
    """D-01 over two levels (client -> orders -> lines) with the size guard applied bottom-up.

    Every level's JSON length is predicted from partial aggregates of the
    level below (lines per order, orders per client) before anything is
    collected, so neither a hot order nor a hot client is ever materialised
    unless its whole document stays within ``max_chars``.  The ``mid_name``
    elements are ``struct(*mid_fields, sub_name)``.  Returns (documents, dropped).
    """
    sub_len = sub.groupBy(mid_id).agg(
        F.sum(F.length(F.to_json(F.struct(*[F.col(c) for c in sub_fields])))).alias("__s"),
        F.count(F.lit(1)).alias("__n"))
    empty = F.array().cast("array<string>").alias(sub_name)
    base = F.length(F.to_json(F.struct(*[F.col(c) for c in mid_fields], empty))) - 2
    mid_len = (mid.select(key, *{mid_id, *mid_fields}).join(sub_len, mid_id, "left")
               .select(key, (base + _array_json_length(F.col("__n"), F.col("__s"))).alias("__ml")))
    doc = mid_len.groupBy(key).agg(F.sum("__ml").alias("__s"), F.count(F.lit(1)).alias("__n"))
    head = F.length(F.to_json(F.struct(F.col(key)))) - 1
    p = parent.select(key).join(doc, key, "left").withColumn(
        "json_length", (head + F.lit(len(mid_name) + 5) + _array_json_length(F.col("__n"), F.col("__s")))
        .cast("bigint"))
    keep = p.where(F.col("json_length") <= max_chars).select(key)
    dropped = p.where(F.col("json_length") > max_chars).select(key, "json_length")
    mids = mid.join(keep, key, "left_semi")
    subs = sub.join(mids.select(mid_id), mid_id, "left_semi")
    inner = nest(subs, [mid_id], sub_fields, sub_name)
    full = mids.join(inner, mid_id, "left")
    full = full.withColumn(sub_name, F.coalesce(F.col(sub_name), F.array().cast(inner.schema[sub_name].dataType)))
    outer = nest(full, [key], [*mid_fields, sub_name], mid_name)
    docs = parent.join(keep, key, "left_semi").join(outer, key, "left").withColumn(
        mid_name, F.coalesce(F.col(mid_name), F.array().cast(outer.schema[mid_name].dataType)))
    return docs, dropped


def _present(fields: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in fields])


def nest_siblings(rows: DataFrame, key: str, parent: Sequence[str], sets: dict[str, Sequence[str]],
                  chain: tuple[str, Sequence[str], str, Sequence[str]], part_chars: int = PART_CHARS,
                  unpack: Column | None = None, tasks: int | None = None) -> DataFrame:
    """D-01: nested documents with several sibling arrays and one chain of two levels, in one pass.

    ``rows`` is a typed union: ``key``, ``kind`` and every field of every kind, NULL where it belongs
    to another kind.  Kind '' is the parent itself (one row per key, with the ``parent`` fields); the
    kinds of ``sets`` give arrays of distinct structs; the kind named by ``chain`` (array name,
    fields, inner array name, inner fields) has one row per inner element, or one with NULL inner
    fields for an element without any.

    ``rows`` may also be packed: any rows with the ``key`` from which ``unpack`` makes an array of structs
    (kind, fields).  They are shuffled as they are, into ``tasks`` tasks, and unpacked behind the shuffle;
    only rows of a key that the ordered scan splits are shuffled once for each struct.

    Equal rows meet in their key's (chunk's) task.  One ordered scan per key then carries the parent's
    fields to all rows and sums up JSON lengths; a part ends every ``part_chars`` characters, so a
    document is one row, or several that have every element once.  A part holds about twice
    ``part_chars`` at most, unless a single element is longer; an element of the chain at a border
    is an element of both parts, each with its share of inner elements.  Its own fields count once
    for every inner element when parts are cut.  Nothing is collected before it is cut.

    Result: key, parent fields, ``part`` (1, 2, ...), the sets' arrays and the chain's, all sorted,
    and ``json_length``, the length that ``to_json`` of the key and the arrays has, as predicted from
    the elements' lengths.  Rows whose key is NULL or has no parent are left out.
    """
    name, mid, sub_name, sub = chain
    fields = list(dict.fromkeys([*parent, *[f for fs in sets.values() for f in fs], *mid, *sub]))
    is_chain, has_sub = F.col("kind") == name, _present(sub)
    line = F.length(F.to_json(F.struct(*sub))).cast("bigint")
    empty = F.array().cast("array<string>").alias(sub_name)
    base = (F.length(F.to_json(F.struct(*mid, empty))) - 2).cast("bigint")
    element = reduce(lambda e, k: e.when(F.col("kind") == k, F.length(F.to_json(F.struct(*sets[k]))).cast("bigint")), sets,
                     F.when(is_chain, base)).otherwise(F.lit(0).cast("bigint"))
    # any order does that keeps a kind's equal elements, and the inner elements of one, together
    own = list(dict.fromkeys([*[f for fs in sets.values() for f in fs], *mid]))

    def place(at: str = "") -> dict[str, Column]:
        return {"__child": F.col(f"{at}kind") != "", "__h": F.xxhash64(*[f"{at}{c}" for c in ("kind", *own)]),
                "__hs": F.xxhash64(*[f"{at}{c}" for c in sub])}

    order = list(place())
    n_chunks = ordered.CHUNKS or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.where(F.col(key).isNotNull())
    held = F.array(F.struct("kind", *fields)) if unpack is None else unpack
    # borders from whole packed rows with the least hashes; only their keys' structs get a place of their own
    some = packed.orderBy(F.xxhash64(*rows.columns)).limit(n_chunks * ordered.PER_CHUNK).select(key, F.inline(held))
    known = packed.withColumn("__borders", chunk_borders(some.withColumns(place()), [key], order, n_chunks).scalar())
    split = F.exists("__borders", lambda b: b["k"][key] == F.col(key))
    dealt = (known.withColumn("__nth", F.explode(F.when(split, F.sequence(F.lit(0), F.size(held) - 1)).otherwise(F.array(F.lit(-1)))))
             .withColumn("__one", F.when(F.col("__nth") >= 0, F.get(held, F.col("__nth")))))
    chunked = add_chunks(dealt.withColumns(place("__one.")), [key], order, n_chunks, borders="__borders")
    near = chunked.select(*rows.columns, "__nth", CHUNK).repartition(tasks or n_chunks, key, CHUNK)
    every = near.select(key, CHUNK, F.inline(F.when(F.col("__nth") < 0, held).otherwise(F.array(F.get(held, F.col("__nth"))))))
    alike = (every.groupBy(key, CHUNK, "kind", *fields).agg(F.count(F.lit(1)).alias("__n"))
             .withColumns({"__len": element, "__line": F.when(is_chain & has_sub, line).otherwise(0)}))
    # equal inner elements stay in number, in pieces that fit into a part
    copies = F.when(F.col("__line") > 0, F.greatest(F.lit(1), F.floor(F.lit(part_chars) / F.col("__line")))).otherwise(F.col("__n"))
    pieces = alike.withColumn("__fit", copies).withColumn(
        "__piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__n") - 1) / F.col("__fit")))))
    held = F.when(F.col("__line") > 0, F.least(F.col("__fit"), F.col("__n") - F.col("__piece") * F.col("__fit"))).otherwise(0)
    sized = (pieces.withColumn("__held", held)
             .withColumn("__size", F.least(F.lit(part_chars).cast("bigint"),
                                           F.col("__len") + 1 + F.col("__held") * (F.col("__line") + 1)))
             .withColumn("__parent", F.when(F.col("kind") == "", F.struct(F.lit(True).alias("__is"), *parent)))
             .drop("__n", "__fit"))
    scanned = ordered_scan(sized.withColumns(place()), [key], [*order, "__piece"],
                           {"__sum": ("sum", "__size"), "__of": ("last_nonnull", "__parent")}, chunk_col=CHUNK)
    part = (F.floor((F.col("__sum") - F.col("__size")) / part_chars) + 1).cast("bigint")
    cut = scanned.where(F.col("__of").isNotNull()).withColumns({"part": part, "__chain": is_chain})
    # arrays within the scan's own tasks; then only arrays are shuffled, for parts that lie in several chunks
    in_chunk = cut.groupBy(key, CHUNK, "part", "__chain", *mid).agg(
        F.max("__of").alias("__of"), F.max("__len").alias("__base"),
        F.sum(F.col("__held") * F.col("__line")).alias("__sub_len"), F.sum("__held").alias("__sub_n"),
        F.flatten(F.collect_list(F.when(F.col("__held") > 0, F.array_repeat(
            F.struct(*sub), F.col("__held").cast("int"))))).alias(sub_name),
        *[x for k in sets for x in (F.collect_list(F.when(F.col("kind") == k, F.struct(*sets[k]))).alias(k),
                                    F.sum(F.when(F.col("kind") == k, F.col("__len"))).alias(f"__len_{k}"))])
    inner = in_chunk.repartition(tasks or n_chunks, key, "part").groupBy(key, "part", "__chain", *mid).agg(
        F.max("__of").alias("__of"), F.max("__base").alias("__base"),
        F.sum("__sub_len").alias("__sub_len"), F.sum("__sub_n").alias("__sub_n"),
        F.sort_array(F.flatten(F.collect_list(sub_name))).alias(sub_name),
        *[x for k in sets for x in (F.flatten(F.collect_list(k)).alias(k), F.sum(f"__len_{k}").alias(f"__len_{k}"))])
    ours = F.col("__chain")
    outer = inner.groupBy(key, "part").agg(
        F.max("__of").alias("__of"),
        F.sort_array(F.collect_list(F.when(ours, F.struct(*mid, sub_name)))).alias(name),
        F.sum(F.when(ours, F.col("__base") + _array_json_length(F.col("__sub_n"), F.col("__sub_len")))).alias("__len"),
        *[x for k in sets for x in (F.sort_array(F.flatten(F.collect_list(F.when(~ours, F.col(k))))).alias(k),
                                    F.sum(f"__len_{k}").alias(f"__len_{k}"))])
    length = F.length(F.to_json(F.struct(key)))
    for array, total in [*[(k, f"__len_{k}") for k in sets], (name, "__len")]:
        length = length + F.lit(len(array) + 4) + _array_json_length(F.size(array), F.col(total))
    return outer.select(key, *[F.col("__of")[f].alias(f) for f in parent], "part", *sets, name,
                        length.cast("bigint").alias("json_length"))
