"""String column helpers (P-05, P-07, Q-02, K-13, O-03, F-str families)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accent folding used by the name comparison, as two aligned
# strings (accented letter -> plain letter), in natural order.
ACCENTED = "áàäâãåéèëêíìïîóòöôõúùüûçñÁÀÄÂÃÅÉÈËÊÍÌÏÎÓÒÖÔÕÚÙÜÛÇÑ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnAAAAAAEEEEIIIIOOOOOUUUUCN"

# Legal-form expansions applied before comparison, in order:
# (pattern, replacement, case-insensitive whole word).
ABBREVIATIONS = [
    ("DAC", "Designated Activity Company", False),
    ("Ltda", "Limitada", True),
    ("Ltd", "Limited", True),
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Trimmed empty string or the text 'null' (any case) becomes NULL."""
    c = col_(c)
    t = F.lower(F.trim(c))
    return F.when((t == "") | (t == "null"), F.lit(None).cast("string")).otherwise(c)


def one_line_string(c) -> Column:
    """Value as string with runs of CR/LF collapsed to one space (P-07)."""
    return F.regexp_replace(col_(c).cast("string"), r"[\r\n]+", " ")


def fold_accents(c) -> Column:
    return F.translate(col_(c), ACCENTED, PLAIN)


def normalize_name(c, abbreviations=ABBREVIATIONS) -> Column:
    """Q-02: fold accents, expand abbreviations (legal forms by default), keep only [a-z0-9], lower."""
    s = fold_accents(col_(c))
    for short, long_, word in abbreviations:
        pat = rf"(?i)\b{short}\b\.?" if word else short
        s = F.regexp_replace(s, pat, long_)
    return F.lower(F.trim(F.regexp_replace(s, "[^a-zA-Z0-9]", "")))


def natural_sort_key(c, prefix: str = "") -> Column:
    """O-03: the number inside codes like Q1, Q2, Q10 as a long (NULL if absent)."""
    pat = rf"^{re.escape(prefix)}(\d+)$" if prefix else r"(\d+)"
    digits = F.nullif(F.regexp_extract(col_(c), pat, 1), F.lit(""))
    return digits.try_cast("bigint")


def clean_column_name(name: str) -> str:
    """K-13: lower case, illegal characters to '_', underscores collapsed and trimmed."""
    s = re.sub(r"[^0-9a-zA-Z_]", "_", name.strip().lower())
    s = re.sub(r"_+", "_", s)
    return s.strip("_")


def has_repeated_item(c, sep: str = ",") -> Column:
    """Q-10: a delimited list contains the same (trimmed) value twice."""
    parts = F.transform(F.split(col_(c), re.escape(sep)), lambda x: F.trim(x))
    return F.size(parts) > F.size(F.array_distinct(parts))
