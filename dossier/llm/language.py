"""Language ID (10), words first, with back-off to shorter character n-grams.

A text is scored by its lower-cased words.  A word that the model knows adds its log frequency in
each language.  Any other word is scored by its longest character n-grams that the model knows:
its 5-grams, or if none of them is known its 4-grams, and so on down to single letters; the mean
log frequency of the known ones counts.  The language with the largest sum wins; the score is its
share among all languages (softmax of the sums).

The model is fitted on at most ``SAMPLE_DOCS`` labelled documents of each language, those with
the least hashes of doc_id, and holds at most ``MODEL_ENTRIES`` words and n-grams, the most
frequent of each language and length.  Both bounds are parameters; every document is predicted
from its whole text.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is every text
when there is no labelled document.  Equal sums go to the smaller language name.  Rows without
doc_id are never learned from.  Repeated rows are predicted one by one.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.llm.common import documents, small_batches

#: Labelled documents of a language that the model is fitted on, at most.
SAMPLE_DOCS = 2_000
#: Words and n-grams that the model holds, at most, over all languages.
MODEL_ENTRIES = 400_000
LONGEST = 5
#: Added to every count.
SMOOTHING = 0.5
UNKNOWN = "und"
WORD = regex.compile(r"\p{L}+")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def counts(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, entries: int = MODEL_ENTRIES) -> DataFrame:
    """n (0: a word, else the n-gram length), gram, lang, count: the model's most frequent entries."""
    labelled = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
    least = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (labelled.select("doc_id", "lang").withColumn("nth", F.row_number().over(least))
              .where(F.col("nth") <= sample_docs).select("doc_id", "lang").distinct())
    # at most sample_docs rows per language
    texts = labelled.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    words = (texts.select("lang", F.explode(F.expr(r"regexp_extract_all(lower(text), '\\p{L}+', 0)")).alias("gram"))
             .groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("count")))
    marked = F.concat(F.lit("^"), F.col("gram"), F.lit("$"))
    grams = words.select("lang", "count", marked.alias("w"), F.explode(F.sequence(F.lit(1), F.lit(LONGEST))).alias("n"))
    grams = (grams.where(F.length("w") >= F.col("n"))
             .select("lang", "count", "n", F.explode(F.expr(
                 "transform(sequence(1, length(w) - n + 1), i -> substring(w, i, n))")).alias("gram"))
             .groupBy("lang", "n", "gram").agg(F.sum("count").alias("count")))
    every = words.select(F.lit(0).alias("n"), "gram", "lang", "count").unionByName(grams)
    langs = max(1, chosen.select("lang").distinct().count())
    # half of the model for words, the rest for the n-gram lengths
    most = F.when(F.col("n") == 0, entries // 2 // langs).otherwise(entries // 2 // langs // LONGEST)
    top = Window.partitionBy("lang", "n").orderBy(F.desc("count"), "gram")
    return every.withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= most).drop("nth")


class Model:
    """Log frequencies of words and n-grams in each language."""

    def __init__(self, rows: list[tuple[int, str, str, int]]):
        self.langs = sorted({lang for _, _, lang, _ in rows})
        at = {lang: k for k, lang in enumerate(self.langs)}
        by_n: dict[int, dict[str, np.ndarray]] = defaultdict(dict)
        for n, gram, lang, count in rows:
            by_n[n].setdefault(gram, np.zeros(len(at)))[at[lang]] = count
        self._index, self._logs = {}, {}
        for n, grams in by_n.items():
            self._index[n] = {g: k for k, g in enumerate(grams)}
            table = np.array(list(grams.values())) + SMOOTHING
            self._logs[n] = np.log(table / table.sum(axis=0)).astype(np.float32)

    def _backed_off(self, word: str) -> np.ndarray:
        marked = f"^{word}$"
        for n in range(LONGEST, 0, -1):
            index = self._index.get(n, {})
            known = [k for i in range(len(marked) - n + 1) if (k := index.get(marked[i:i + n])) is not None]
            if known:
                return self._logs[n][known].mean(axis=0)
        return np.zeros(len(self.langs))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = Counter(WORD.findall((text or "").lower()))
        if not words or not self.langs:
            return UNKNOWN, 0.0
        index = self._index[0]
        rows, times, total = [], [], np.zeros(len(self.langs))
        for word, n in words.items():
            k = index.get(word)
            if k is None:
                total += n * self._backed_off(word)
            else:
                rows.append(k)
                times.append(n)
        if rows:
            total += np.asarray(times, dtype=np.float64) @ self._logs[0][rows]
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # at most MODEL_ENTRIES entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            said = [model.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in said], pa.string()), pa.array([s for _, s in said], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def fit(docs: DataFrame, **bounds: int) -> Model:
    return Model([(r.n, r.gram, r.lang, r["count"]) for r in counts(docs, **bounds).collect()])


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
