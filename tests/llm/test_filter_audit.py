"""The filter audit against a plain walk through every order, on rows with nulls, ties and repeated rows."""

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from dossier.llm import filter_audit

LONG = " ".join(f"w{k}" for k in range(250))
TEXTS = [None, "", " \t\n", "AB cd", LONG, LONG, LONG + " #", "a b " * 150, "a b " * 150, "A% " * 400, LONG + " É|", LONG.upper()]
#: doc_id, text, source: a repeated row, a doc_id with two texts, a null doc_id beside an equal text, null and empty source
ROWS = [(k, t, ["x", "y", None, ""][k % 4]) for k, t in enumerate(TEXTS)] + [
    (4, LONG, "x"), (4, "other", "x"), (None, LONG, "x"), (None, None, None), (20, "other", "y")]
LABELS = [(0, 1, 0), (4, 1, None), (5, 1, 1), (5, 0, 0), (8, None, 1), (None, 1, 1), (99, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, s, 1, True, "z") for d, t, s in ROWS],
                                 "doc_id long, text string, source string, n int, A boolean, part string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(*x, "k") for x in LABELS], "doc_id long, quality int, toxic int, good string")


def failed(row):
    doc, text, _ = row
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    least = min((d for d, t, _ in ROWS if d is not None and (t or "") == text), default=None)
    return {f for f, bad in zip("ABCDE", (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        bool(re.search(r"[#$%&*|]", text)), doc is not None and doc > least)) if bad}


def walked():
    """(part, order, step) -> the seven counts, by walking every document through every order."""
    fails = [failed(r) for r in ROWS]
    good = [any(d == r[0] and q == 1 for d, q, _ in LABELS if d is not None) for r in ROWS]
    toxic = [any(d == r[0] and t == 1 for d, _, t in LABELS if d is not None) for r in ROWS]
    out, shapley = {}, {}
    for part in {s or "" for _, _, s in ROWS}:
        for order in permutations("ABCDE"):
            left = [k for k, r in enumerate(ROWS) if (r[2] or "") == part]
            everyone = list(left)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                left = [k for k in left if k not in gone]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in fails[k] for k in everyone) - len(gone),
                    sum(fails[k] == {f} for k in everyone), sum(good[k] for k in gone), sum(toxic[k] for k in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_is_a_walk_through_every_order(spark, docs, labels):
    rows = filter_audit.audit(filter_audit.labelled(spark, filter_audit.flags(spark, docs), labels)).collect()
    got = {tuple(r)[:3]: tuple(r)[3:] for r in rows}
    assert len(rows) == len(got) == 3 * 600 and got == walked()


def test_every_part_gets_its_own_rows(spark):
    flagged = spark.range(300).select(F.col("id").cast("string").alias("part"), F.lit(2).alias("n"), (F.col("id") % 2 == 0).alias("p"),
                                      F.lit(None).cast("boolean").alias("q"), F.lit(True).alias("good"), F.lit(None).cast("boolean").alias("toxic"))
    out = filter_audit.audit(flagged, "pq")
    assert out.count() == 300 * 2 * 2 and out.where("toxic_lost > 0").isEmpty()
    assert out.where("filter_order = 'qp' AND step = 2").agg(F.sum("removed"), F.sum("good_lost"), F.sum("shapley")).first() == (300, 300, 600)


def test_empty_tables(spark, docs, labels):
    none = filter_audit.flags(spark, docs.where("false"))
    assert filter_audit.audit(filter_audit.labelled(spark, none, labels)).count() == 0
    rows = filter_audit.audit(filter_audit.labelled(spark, filter_audit.flags(spark, docs), labels.where("false")))
    assert rows.where("good_lost + toxic_lost > 0").isEmpty() and rows.count() == 1800
