"""Quality rules (2) by weak supervision. DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document.  Nobody says which documents
are good: expectation-maximisation alternates between the probability that a document is good
given the votes, and the accuracy of every rule given these probabilities.  A document is kept
if its posterior probability of being good is at least one half and it passes the base rules.  A rule is right to a different degree on good and
on bad documents: most junk trips a few rules only.

Votes are counted by pattern first (at most 3 ** rules patterns, whatever the corpus), so the
corpus is read once for the features and EM runs on the pattern table.  Accuracies have a Beta
prior: a rule that seldom votes stays near it and cannot flip its meaning.

Defined results: null text has no words, lines or symbols and fails the base rules.  Every input
row gives one row; repeated rows give equal rows.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.common import SPACE_RE, documents, let, words_of, written

#: Characters that count as symbols (fixed values of the contract).
SYMBOLS = "#*$%&|<>"

#: name -> vote, in SQL that Spark and DuckDB read alike, over the features of ``features``.
RULES = {
    "length": "CASE WHEN n_words < 10 THEN -1 WHEN n_words >= 30 THEN 1 ELSE 0 END",
    "word_length": "CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN -1"
                   " WHEN word_chars <= 10 * n_words THEN 1 ELSE 0 END",
    "symbols": "CASE WHEN 10 * n_symbols > n_words THEN -1 WHEN 100 * n_symbols <= n_words THEN 1 ELSE 0 END",
    "lines": "CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN -1 WHEN n_dup_lines = 0 THEN 1 ELSE 0 END",
    "repeats": "CASE WHEN 100 * n_repeat_words > 20 * n_words THEN -1"
               " WHEN 100 * n_repeat_words <= 5 * n_words THEN 1 ELSE 0 END",
    "letters": "CASE WHEN n_words < 20 THEN 0 WHEN 100 * n_letters < 80 * word_chars THEN -1"
               " WHEN 100 * n_letters >= 94 * word_chars THEN 1 ELSE 0 END",
    "marks": "CASE WHEN 5 * n_marks > n_words THEN -1 WHEN 50 * n_marks <= n_words THEN 1 ELSE 0 END",
    "decorated": "CASE WHEN 5 * (n_symbols + n_marks) > n_words THEN -1"
                 " WHEN 50 * (n_symbols + n_marks) <= n_words THEN 1 ELSE 0 END",
}
BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
#: Start of EM: how often a rule's vote is right on good and on bad documents, and the share of good ones.
START_GOOD, START_BAD, START_SHARE = 0.95, 0.5, 0.85
#: Beta prior of an accuracy: its weight as a share of all documents, centred on the start.
WEIGHT = 0.05
ROUNDS = 12


def _neighbours_equal(s: Column, key) -> Column:
    """Elements of a sorted array that have the key of the one before or after."""
    return F.filter(s, lambda x, k: (key(F.get(s, k - 1)) == key(x)) | (key(F.get(s, k + 1)) == key(x)))


def _repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more, the first occurrence included.

    A text whose window hashes all differ has none.  Else (hash, place) sorted as one long gives
    candidate places, these are sorted again with their whole windows, equal neighbours are
    repeats, and the union of their intervals is summed over sorted places: n log n per text.
    """
    def window(i: Column) -> Column:
        return F.slice(words, i + 1, F.lit(5))

    def candidates(hashes: Column) -> Column:
        keyed = F.transform(hashes, lambda h, i: F.shiftleft(h.cast("long"), 32).bitwiseOR(i.cast("long")))
        found = let(F.sort_array(keyed), lambda s: _neighbours_equal(s, lambda x: F.shiftright(x, 32)))
        return F.transform(found, lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))

    def places(hashes: Column) -> Column:
        exact = F.transform(candidates(hashes), lambda i: F.struct(window(i).alias("w"), i.alias("i")))
        found = let(F.sort_array(exact), lambda s: _neighbours_equal(s, lambda x: x["w"]))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(p, k + 1) - x, F.lit(5))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    none = F.lit(0).cast("long")
    ends = F.slice(words, F.lit(5), F.greatest(F.size(words) - 4, F.lit(0)))
    hashes = F.transform(ends, lambda last, i: F.hash(*[F.get(words, i + k) for k in range(4)], last))
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none)
               .otherwise(let(places(h), covered)))


def _count(text: Column, keep: str) -> Column:
    """Characters of ``text`` in the class ``keep``, as code points."""
    return F.length(F.regexp_replace(text, f"[^{keep}]+", "")).cast("long")


def features(docs: DataFrame, *carried: str) -> DataFrame:
    """The ``carried`` columns and the numbers that the rules read, one row per document."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(words_of(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words")))
    of_lines = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), F.size(F.array_distinct(x)).alias("distinct")))
    # what is neither letter nor white space: short, and all symbols and marks are in it
    of_rest = let(F.regexp_replace("text", r"[\p{L}\x20\x09-\x0D]+", ""), lambda r: F.struct(
        F.length(r).cast("long").alias("n_rest"), _count(r, SYMBOLS).alias("n_symbols"), _count(r, "!?").alias("n_marks")))
    return (docs.select(*carried, F.coalesce("text", F.lit("")).alias("text"))
            .select(*carried, of_words.alias("w"), of_lines.alias("l"), of_rest.alias("r"))
            .select(*carried, "w.*", "r.*", "l.n_lines",
                    (F.col("l.n_lines") - F.col("l.distinct")).cast("long").alias("n_dup_lines"),
                    (F.col("w.word_chars") - F.col("r.n_rest")).alias("n_letters")))


def _posterior(on_good: list[str], on_bad: list[str], share: str) -> str:
    """SQL of P(good | votes): naive Bayes over the rules that voted."""
    yes = " * ".join([share, *(f"CASE v{j} WHEN 1 THEN {a} WHEN -1 THEN 1.0e0 - {a} ELSE 1.0e0 END"
                               for j, a in enumerate(on_good))])
    no = " * ".join([f"(1.0e0 - {share})", *(f"CASE v{j} WHEN -1 THEN {b} WHEN 1 THEN 1.0e0 - {b} ELSE 1.0e0 END"
                                             for j, b in enumerate(on_bad))])
    return f"({yes}) / (({yes}) + ({no}))"


def _updates(p: str) -> list[str]:
    """SQL of the next accuracies on good, on bad documents, and the share of good ones.

    An accuracy is the expected number of right votes among the votes on that class, with its
    prior.
    """
    def accuracy(j: int, vote: int, of: str, start: float) -> str:
        right = f"sum(CASE WHEN v{j} = {vote} THEN n * {of} ELSE 0.0e0 END)"
        cast = f"sum(CASE WHEN v{j} <> 0 THEN n * {of} ELSE 0.0e0 END)"
        return f"({right} + {WEIGHT * start:.6f}e0 * sum(n)) / ({cast} + {WEIGHT}e0 * sum(n))"

    return [*(accuracy(j, 1, p, START_GOOD) for j in range(len(RULES))),
            *(accuracy(j, -1, f"(1.0e0 - {p})", START_BAD) for j in range(len(RULES))),
            f"(sum(n * {p}) + {WEIGHT * START_SHARE:.6f}e0 * sum(n)) / ({1 + WEIGHT}e0 * sum(n))"]


def fit(patterns: DataFrame) -> str:
    """The fitted posterior as SQL over the votes, by ROUNDS rounds of EM.

    ``patterns`` has one row per vote pattern; each round is one aggregate to one row.
    """
    m = len(RULES)
    found = [START_GOOD] * m + [START_BAD] * m + [START_SHARE]

    def posterior() -> str:
        said = [f"{x!r}D" for x in found]
        return _posterior(said[:m], said[m:-1], said[-1])

    for _ in range(ROUNDS):
        row = patterns.withColumn("p", F.expr(posterior())).agg(*[F.expr(x) for x in _updates("p")]).first()
        if row[0] is None:  # no documents
            break
        found = list(row)
    return posterior()


def _voted(rows: DataFrame) -> DataFrame:
    return rows.select("*", *[F.expr(sql).alias(f"v{j}") for j, sql in enumerate(RULES.values())])


def _judged(voted: DataFrame, posterior: str) -> DataFrame:
    return (voted.withColumns({"posterior": F.expr(posterior), "base_failed": F.expr(BASE_FAILED)})
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)))


def _fitted(spark: SparkSession, voted: DataFrame) -> str:
    patterns = voted.groupBy(*[f"v{j}" for j in range(len(RULES))]).agg(F.count(F.lit(1)).alias("n"))
    return fit(written(spark, patterns.coalesce(1), "quality-patterns"))  # at most 3 ** rules rows


def judge(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, features, votes, posterior, base_failed and kept, one row per document."""
    voted = written(spark, _voted(features(docs, "doc_id")), "quality-votes")
    return _judged(voted, _fitted(spark, voted))


def keep(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The input rows that are kept, with all their columns."""
    posterior = _fitted(spark, _voted(features(docs)))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return _judged(_voted(features(rows, "row")), posterior).where("kept").select("row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    """The DuckDB twin: the features by unnesting words, then the same rounds of EM unrolled."""
    m = len(RULES)
    names = [f"a{j}" for j in range(m)] + [f"b{j}" for j in range(m)] + ["g"]
    start = [START_GOOD] * m + [START_BAD] * m + [START_SHARE]
    posterior = _posterior(names[:m], names[m:-1], "g")
    rounds = [f"e0 AS (SELECT {', '.join(f'{x}e0 AS {k}' for x, k in zip(start, names))})"]
    for k in range(ROUNDS):
        found = ", ".join(f"{x} AS {name}" for x, name in zip(_updates("p"), names))
        rounds.append(f"s{k} AS (SELECT patterns.*, {posterior} AS p FROM patterns, e{k}), "
                      f"e{k + 1} AS (SELECT {found} FROM s{k})")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{SPACE_RE}'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
grams AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS gram
          FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
found AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
gaps AS (SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS gap FROM found),
covered AS (SELECT rid, sum(gap) AS r FROM gaps GROUP BY rid),
f AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(text, '[^{SYMBOLS}]+', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
             length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS n_letters,
             length(regexp_replace(text, '[\p{{L}}\x20\x09-\x0D]+', '', 'g')) AS n_rest,
             length(regexp_replace(text, '[^!?]+', '', 'g')) AS n_marks
      FROM w LEFT JOIN covered USING (rid)),
votes AS (SELECT *, {', '.join(f'{sql} AS v{j}' for j, sql in enumerate(RULES.values()))} FROM f),
patterns AS (SELECT {', '.join(f'v{j}' for j in range(m))}, count(*) AS n FROM votes GROUP BY ALL),
{', '.join(rounds)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {BASE_FAILED} AS base_failed, NOT ({BASE_FAILED}) AND {posterior} >= 0.5 AS kept
FROM votes, e{ROUNDS}
"""


SQL = _sql()
