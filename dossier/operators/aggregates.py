"""List-building aggregates (A-06..A-09, A-16).

``collect_set`` / ``collect_list`` order is undefined, so every list that
becomes text is sorted first.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def collect_unique_list(col: str, sep: str = ", ") -> Column:
    """A-06: distinct values, sorted, joined to one string."""
    return F.array_join(F.array_sort(F.collect_set(col)), sep)


def collect_sorted_list(col: str, sep: str = ",", tie_break: Sequence[str] = ()) -> Column:
    """A-07: all values (duplicates kept) in sorted order, via a sorted list of structs."""
    s = F.sort_array(F.collect_list(F.struct(F.col(col).alias("v"), *[F.col(c) for c in tie_break])))
    return F.concat_ws(sep, s.getField("v"))


def sorted_set_nonblank(col: str) -> Column:
    """A-08: sorted distinct values ignoring blanks."""
    return F.array_sort(F.collect_set(F.nullif(F.trim(F.col(col)), F.lit(""))))


def merge_lists(*cols: str) -> Column:
    """A-09: distinct union of several collected lists.

    Each list is collected as a set (partial, map-side de-duplication), so a
    hot key's buffer is bounded by its distinct values, not its rows.
    """
    return F.array_distinct(F.flatten(F.array(*[F.collect_set(c) for c in cols])))
