"""Ordered per-key scans that stay parallel when one key holds a large share of the rows.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one task.  Here a key that
holds more than SHARES partitions' shares of the rows is cut into contiguous *chunks* of (key, order), and the scan
is a distributed prefix scan: each chunk computes its running values by itself, every chunk hands
on one carry row (row count, running totals, last and first value), the carries of a key are
combined in order, and the result is joined back to the chunk's rows.

One plan serves every size, and nothing runs while it is built.  The chunk borders come from a
scalar subquery of the plan itself: of the rows with the least hashes of (keys, order), a bounded
and repeatable choice, every such key gives borders at the distance of one partition's share.  A row's chunk is a pure function of its values and these borders (a binary search), so
every branch and every recomputation after a lost executor agrees.  Keys without borders have
chunk 0 and no carries: only rows of split keys take part in the carry branch, whose result has at
most two rows per border and is broadcast.

Supported outputs, all over a caller-supplied *total* order:

* ``("row_number",)``                 1-based position within the key
* ``("lag", col)`` / ``("lead", col)`` previous / next row's value
* ``("sum", col)`` / ``("max", col)`` / ``("min", col)`` running, current row included
* ``("max_before", col)``              running max over the preceding rows only
* ``("last_nonnull", col)``            last non-NULL value at or before the row
* ``("next_nonnull", col)``            first non-NULL value at or after the row
* ``("is_first",)``                    whether the row is the key's first row
* ``("rank",)`` / ``("dense_rank",)``  rank of the row's ``rank_by`` values (peers share
  a chunk, so per-chunk counts add up)

An order is a list of column names or of tuples (name, ascending[, nulls first]); nulls come
first where ascending and last where descending unless said.  NULL keys form a group of their own.
``chunk_col`` lets a second scan reuse the chunks (and the partitioning) of a first one, so chained
scans add no new shuffle.

Limits: rows that are equal in keys and order share a chunk, whatever their number, and a key is cut
along its leading order columns of atomic types only.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "__chunk"
#: Chunks that an input is cut into at most; None: as many as there are shuffle partitions.
CHUNKS: int | None = None
#: Rows of the choice per chunk; a key is split if it holds as many chunks' shares of them.
PER_CHUNK, SHARES = 16, 4

Order = str | tuple[str, bool] | tuple[str, bool, bool]


def _spec(o: Order) -> tuple[str, bool, bool]:
    """(column, ascending, nulls first)."""
    if isinstance(o, str):
        return o, True, True
    name, asc = o[0], o[1]
    return name, asc, (o[2] if len(o) > 2 else asc)


def sort_column(o: Order) -> Column:
    """The sort expression of an order entry."""
    name, asc, nulls_first = _spec(o)
    c = F.col(name)
    if asc:
        return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()
    return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _order_by(order: Sequence[Order]) -> str:
    def one(o: Order) -> str:
        name, asc, nulls_first = _spec(o)
        return f"{_q(name)} {'ASC' if asc else 'DESC'} NULLS {'FIRST' if nulls_first else 'LAST'}"
    return ", ".join(map(one, order))


def _falling(c: str, kind: T.DataType) -> list[str] | None:
    """SQL whose ascending order is the descending order of a non-NULL ``c``; None if there is none."""
    if isinstance(kind, T.BooleanType):
        return [f"NOT {c}"]
    if isinstance(kind, T.IntegralType):
        return [f"~{c}"]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return [f"NOT isnan({c})", f"-{c}"]  # NaN is the greatest
    if isinstance(kind, T.DecimalType):
        return [f"-{c}"]
    if isinstance(kind, T.DateType):
        return [f"~unix_date({c})"]
    if isinstance(kind, T.TimestampNTZType):
        return [f"~timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {c})"]
    if isinstance(kind, T.TimestampType):
        return [f"~unix_micros({c})"]
    if isinstance(kind, (T.StringType, T.BinaryType)):
        # complemented hex digits, with an end that is greater than any digit
        return [f"concat(translate(hex({c}), '0123456789ABCDEF', 'FEDCBA9876543210'), '~')"]
    return None


def _ascending(schema: T.StructType, order: Sequence[Order]) -> str:
    """SQL of a struct whose natural order is ``order``, as far as its leading columns can be said so."""
    fields = ["true"]
    for o in order:
        name, asc, nulls_first = _spec(o)
        kind = schema[name].dataType
        value = None
        if isinstance(kind, T.AtomicType):
            value = [_q(name)] if asc else _falling(_q(name), kind)
        if value is None:
            break
        fields += [f"{_q(name)} IS {'NOT ' if nulls_first else ''}NULL", *value]
    return f"struct({', '.join(fields)})"


def _borders(df: DataFrame, keys: Sequence[str], at: str, order: Sequence[Order], n: int) -> DataFrame:
    """One row, one array: the borders (k, o) of the keys that hold more than SHARES / n of the rows.

    ``at`` is the SQL of a row's (k, o).
    """
    values = ", ".join(map(_q, dict.fromkeys([*keys, *[_spec(o)[0] for o in order]])))
    return (df.selectExpr(f"inline(array({at}))", f"xxhash64({values}) AS h").orderBy("h").limit(n * PER_CHUNK)
            .selectExpr("k", "o", "count(*) OVER (PARTITION BY k) AS held",
                        "row_number() OVER (PARTITION BY k ORDER BY o) AS nth", "count(*) OVER () AS total")
            .where(f"held * {n} > {SHARES} * total AND nth > 1 AND floor(nth * {n} / total) > floor((nth - 1) * {n} / total)")
            .selectExpr("sort_array(collect_set(struct(k, o))) AS borders"))


def _count(df: DataFrame, n: int | None) -> int:
    return n or CHUNKS or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _at(df: DataFrame, keys: Sequence[str], order: Sequence[Order]) -> str:
    """SQL of a row's place (k, o)."""
    return f"named_struct('k', struct({', '.join(map(_q, keys))}), 'o', {_ascending(df.schema, order)})"


def chunk_borders(df: DataFrame, keys: Sequence[str], order: Sequence[Order], n: int | None = None) -> DataFrame:
    """One row, one array: the borders (k, o) that ``add_chunks`` finds in ``df``; only split keys have some."""
    return _borders(df, keys, _at(df, keys, order), order, _count(df, n))


def add_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[Order], n: int | None = None,
               cut: Sequence[Order] | None = None, borders: str | None = None) -> DataFrame:
    """Tag every row with its chunk: 0 where its key is not split, else contiguous ranges of (keys, cut).

    ``cut`` is a prefix of ``order``; rows that are equal in it share a chunk.  ``borders`` names a
    column that holds the result of ``chunk_borders``, for the same ``n``; it is dropped.
    """
    n = _count(df, n)
    if borders:
        columns = [c for c in df.columns if c != borders]
        at = _at(df, keys, order if cut is None else cut)
        known = df.selectExpr(*map(_q, columns), f"{_q(borders)} AS __borders", f"{at} AS __at")
    else:
        columns, at = df.columns, _at(df, keys, order if cut is None else cut)
        known = df.select("*", _borders(df, keys, at, order, n).scalar().alias("__borders"), F.expr(f"{at} AS __at"))
    # how many borders are at or before the row: at most n, so a few halving steps
    steps = ", ".join(str(1 << b) for b in reversed(range(n.bit_length())))
    place = (f"CASE WHEN size(__borders) = 0 THEN 0 ELSE aggregate(array({steps}), 0, (at, s) -> "
             "CASE WHEN get(__borders, at + s - 1) <= __at THEN at + s ELSE at END) END")
    split = "get(__borders, __place - 1).k <=> __at.k OR get(__borders, __place).k <=> __at.k"
    return (known.selectExpr("*", f"{place} AS __place")
            # an array of one: a filter on the chunk stays above it, and does not repeat the search
            .selectExpr(*map(_q, columns), f"explode(array(CASE WHEN {split} THEN __place + 1 ELSE 0 END)) AS {CHUNK}"))


#: kind -> running value within the chunk, what a chunk hands on, how carries combine, and the result of both.
#: w, run, rest and peers stand for windows over the chunk, wk for one over the chunks of a key; c is the
#: column, l the running value, k the combined carry, h what was handed on.
_BEFORE = "(wk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_AFTER = "(wk ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
KINDS = {
    "row_number": (None, None, None, "coalesce(__off, 0) + __nth"),
    "is_first": (None, None, None, "coalesce(__off, 0) = 0 AND __nth = 1"),
    "rank": ("rank() OVER (peers)", None, None, "coalesce(__off, 0) + {l}"),
    "dense_rank": ("dense_rank() OVER (peers)", "max({l})", f"sum({{h}}) OVER {_BEFORE}", "coalesce({k}, 0) + {l}"),
    "lag": ("lag({c}) OVER (w)", "max_by({c}, __nth)", "lag({h}) OVER (wk)", "CASE WHEN __nth = 1 THEN {k} ELSE {l} END"),
    "lead": ("lead({c}) OVER (w)", "min_by({c}, __nth)", "lead({h}) OVER (wk)", "CASE WHEN __end THEN {k} ELSE {l} END"),
    "sum": ("sum({c}) OVER (run)", "sum({c})", f"sum({{h}}) OVER {_BEFORE}",
            "CASE WHEN {k} IS NULL THEN {l} WHEN {l} IS NULL THEN {k} ELSE {k} + {l} END"),
    "max": ("max({c}) OVER (run)", "max({c})", f"max({{h}}) OVER {_BEFORE}", "greatest({k}, {l})"),
    "min": ("min({c}) OVER (run)", "min({c})", f"min({{h}}) OVER {_BEFORE}", "least({k}, {l})"),
    "max_before": ("max({c}) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)", "max({c})",
                   f"max({{h}}) OVER {_BEFORE}", "greatest({k}, {l})"),
    "last_nonnull": ("last({c}, true) OVER (run)", "max_by({c}, CASE WHEN {c} IS NOT NULL THEN __nth END)",
                     f"last({{h}}, true) OVER {_BEFORE}", "coalesce({l}, {k})"),
    "next_nonnull": ("first({c}, true) OVER (rest)", "min_by({c}, CASE WHEN {c} IS NOT NULL THEN __nth END)",
                     f"first({{h}}, true) OVER {_AFTER}", "coalesce({l}, {k})"),
}


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[Order], specs: dict[str, tuple],
                 chunk_col: str | None = None, n_chunks: int | None = None, keep_chunk: bool = False,
                 rank_by: Sequence[Order] | None = None) -> DataFrame:
    """Add the ``specs`` outputs (see module doc) computed over ``order`` within ``keys``.

    ``rank_by`` (a prefix of the ordering, default ``order``) defines peers
    for ``rank`` / ``dense_rank``; chunks are then cut on ``rank_by`` only,
    so peers never straddle a chunk border.
    """
    rb = list(rank_by) if rank_by is not None else list(order)
    has_rank = any(s[0] in ("rank", "dense_rank") for s in specs.values())
    x = df if chunk_col else add_chunks(df, keys, order, n_chunks, cut=rb if has_rank else order)
    ch = chunk_col or CHUNK
    part = [*keys, ch]
    by = f"PARTITION BY {', '.join(map(_q, part))} ORDER BY "
    w = by + _order_by(order)
    windows = {"(w)": f"({w})", "(w ": f"({w} ", "(run)": f"({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
               "(rest)": f"({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)", "(peers)": f"({by}{_order_by(rb)})",
               "wk": f"PARTITION BY {', '.join(f'__g{i}' for i in range(len(keys)))} ORDER BY __g{len(keys)}"}

    def said(step: int) -> list[tuple[str, str]]:
        """(output, SQL) of one step of KINDS for the outputs that have it."""
        found = []
        for out, (kind, *col) in specs.items():
            sql = KINDS[kind][step]
            if sql is not None:
                if step in (0, 2):
                    for name, text in windows.items():
                        sql = sql.replace(name, text)
                found.append((out, sql.format(c=_q(col[0]) if col else "", l=_q(f"__l_{out}"), k=_q(f"__k_{out}"), h=_q(f"__c_{out}"))))
        return found

    x = x.selectExpr("*", f"row_number() OVER ({w}) AS __nth", f"lead(true) OVER ({w}) IS NULL AS __end",
                     *[f"{sql} AS {_q(f'__l_{out}')}" for out, sql in said(0)])
    # one carry row per chunk of a split key, combined over the chunks before (or after) it
    handed = (x.where(f"{_q(ch)} > 0").groupBy(*[F.expr(f"{_q(k)} AS __g{i}") for i, k in enumerate(part)])
              .agg(F.expr("count(*) AS __n"), *[F.expr(f"{sql} AS {_q(f'__c_{out}')}") for out, sql in said(1)])
              .selectExpr(*[f"__g{i}" for i in range(len(part))], f"sum(__n) OVER {_BEFORE} AS __off".replace("wk", windows["wk"]),
                          *[f"{sql} AS {_q(f'__k_{out}')}" for out, sql in said(2)]))
    same = F.expr(" AND ".join(f"{_q(k)} <=> __g{i}" for i, k in enumerate(part)))
    j = x.join(F.broadcast(handed), same, "left")  # two rows per border at most, and n borders
    keep = list(df.columns) + ([ch] if (keep_chunk or chunk_col) and ch not in df.columns else [])
    return j.selectExpr(*map(_q, keep), *[f"{sql} AS {_q(out)}" for out, sql in said(3)])
