"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.session import scratch_path
from dossier.sources.tables import table

#: White space that separates words, and a word, as Java and RE2 both read them.
SPACE_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda variable is evaluated once; a column repeated inside a higher-order function
    would be evaluated for every element.
    """
    return F.transform(F.array(value), body)[0]


#: Tables written since the innermost ``settled`` began; None outside of it.
_STEPS: ContextVar[list[str] | None] = ContextVar("steps", default=None)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared checkpoint folder and read it again."""
    path = scratch_path(spark, name)
    if _STEPS.get() is not None:
        _STEPS.get().append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """Write what ``build`` gives and delete the tables that were written on the way."""
    steps: list[str] = []
    token = _STEPS.set(steps)
    try:
        result = build()
        _STEPS.reset(token)  # the result itself belongs to the step around this one, if any
        return written(spark, result, name)
    finally:
        if _STEPS.get() is steps:
            _STEPS.reset(token)
        for step in steps:
            folder = spark._jvm.org.apache.hadoop.fs.Path(step)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def words_of(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none.

    Lines are split at single spaces, which needs no pattern; rarer white space is turned into
    spaces first where a text has any.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.when(text.rlike(r"[\x09\x0B-\x0D]"), F.regexp_replace(text, r"[\x09\x0B-\x0D]", " ")).otherwise(text)
    return F.array_remove(F.flatten(F.transform(F.split(plain, "\n"), lambda x: F.split(x, " "))), "")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Few rows per Arrow batch, since texts may be long; a value the session has set stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(rows))
