"""File sources: CSV, framed text, positional columns, inventories, mixed dates (S-11..S-16)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXCEL_EPOCH = "1899-12-30"


def scan_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True) -> DataFrame:
    """S-11: delimited text with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(path)


def scan_framed_text(spark: SparkSession, path: str, n_fields: int, sep: str = "|",
                     header_code: str = "0", trailer_code: str = "9", min_lines: int = 5) -> DataFrame:
    """S-12: text files with a header and a trailer record; body split into ``_c0.._cN``.

    Header and trailer are recognised by their exact record code (first field:
    a body record may be coded 00 or 09), not by line position, so files are read in parallel splits.  A file
    contributes rows only when it has at least ``min_lines`` lines (the
    reference treats files of 4 lines or fewer as empty); that count is a
    per-file aggregate joined back on the file path.
    """
    raw = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("__file"))
    sizes = raw.groupBy("__file").agg(F.count(F.lit(1)).alias("__lines"))
    parts = F.split(F.col("value"), "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep, -1)
    body = raw.withColumn("__p", parts).withColumn("__code", F.trim(F.col("__p")[0]))
    body = body.where(~F.col("__code").isin(header_code, trailer_code))
    body = body.join(sizes.where(F.col("__lines") >= min_lines), "__file", "left_semi")
    return body.select(*[F.col("__p")[i].alias(f"_c{i}") for i in range(n_fields)])


def rename_positional(df: DataFrame, spec: Sequence[tuple[str, str]], code_col: int = 0) -> DataFrame:
    """S-13: ``_c0.._cN`` to named, trimmed, typed columns; record code without leading zeros."""
    cols = []
    for i, (name, typ) in enumerate(spec):
        c = F.trim(F.col(f"_c{i}"))
        if i == code_col:
            c = F.regexp_replace(c, "^0+(?=.)", "")
        cols.append((c if typ == "string" else c.try_cast(typ)).alias(name))
    return df.select(*cols)


def write_framed_fixture(df: DataFrame, path: str) -> None:
    """Write one framed file per supplier nation: header, '01|…' records, trailer with count."""
    key = "s_nationkey"
    rec = df.select(F.col(key).alias("__g"), F.lit(1).alias("__o"),
                    F.concat_ws("|", F.lit("01"), F.col("s_suppkey").cast("string"), "s_name",
                                F.col(key).cast("string"), F.col("s_acctbal").cast("string")).alias("value"))
    cnt = df.groupBy(F.col(key).alias("__g")).agg(F.count(F.lit(1)).alias("__n"))
    head = cnt.select("__g", F.lit(0).alias("__o"),
                      F.concat_ws("|", F.lit("0"), F.lit("SUPPLIERS"), F.col("__g").cast("string")).alias("value"))
    tail = cnt.select("__g", F.lit(2).alias("__o"),
                      F.concat_ws("|", F.lit("9"), F.col("__n").cast("string")).alias("value"))
    allr = head.unionByName(rec).unionByName(tail)
    # one file per nation: the frame belongs to the file
    (allr.repartition("__g").sortWithinPartitions("__g", "__o").select("__g", "value")
     .write.mode("overwrite").partitionBy("__g").text(path))


def file_inventory(spark: SparkSession, pattern: str, name_depth: int = 1) -> DataFrame:
    """S-15: (name, path, size) of files; the binary content column is never read.

    ``name`` is the path element ``name_depth`` levels from the end (1 = file
    name, 2 = its folder, for tables written as folders of part files).
    """
    df = spark.read.format("binaryFile").load(pattern)
    return df.select(F.element_at(F.split("path", "/"), -name_depth).alias("name"), "path",
                     F.col("length").alias("size_bytes"))


def missing_files(source: DataFrame, target: DataFrame, on: str = "name") -> DataFrame:
    """S-15: files in the source inventory without a counterpart in the target."""
    return source.join(target.select(on), on, "left_anti")


def normalize_mixed_date(c: str) -> Column:
    """S-16: spreadsheet serial, dd/MM/yyyy or ISO text to a date; anything else NULL."""
    x = F.trim(F.col(c))
    return (F.when(x.rlike(r"^[0-9]{1,5}$"),
                   F.date_add(F.lit(EXCEL_EPOCH).cast("date"), x.try_cast("int")))
            .when(x.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.try_to_date(x, "dd/MM/yyyy"))
            .when(x.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(x, "yyyy-MM-dd")))
