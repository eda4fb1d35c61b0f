"""The training-data operators on small tables: brute force, round trips, edge rows, empty tables."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dossier.llm import (bpe, chat, exact_dedup, language, mixing, ngram_join, quality_rules, sharding, suffix_dedup,
                         token_store)
from dossier.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LONG = "ab cd ef " * 3000
PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
#: nulls, empty, blank, very long, repeated rows, ties, a null doc_id and columns with clashing names
ROWS = [(1, PROSE, "a"), (2, PROSE, "b"), (2, PROSE, "b"), (3, None, "a"), (4, "", None), (5, " \n\t ", "a"), (6, LONG, "c"),
        (7, LONG + "x", "c"), (None, PROSE + " end", "a"), (8, PROSE + " end", "a"), (9, "Ünï  códe  <|endoftext|>\n\n x", "b"),
        (10, "ab cd", "b")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, s, "en" if d and d % 2 else None, 1, True, "k", 0) for d, t, s in ROWS],
                                 "doc_id long, text string, source string, lang string, size int, kept boolean, key string, shard int")


def test_exact_dedup_with_colliding_digests(spark, docs):
    weak = {"fingerprint": lambda t: (F.length(t) % 3).cast("long"), "digest": lambda t: F.substring(t, 1, 1)}
    entries, index = exact_dedup.build_index(spark, docs, capacity=2, **weak)
    got = sorted(exact_dedup.membership(docs, entries, index, **weak).collect(), key=str)
    groups = Counter(t or "" for _, t, _ in ROWS)
    keep = {t: max((-1 if d is None else d) for d, x, _ in ROWS if (x or "") == t) for t in groups}
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(got) == len(ROWS)
    for r in got:
        t = sha[r.text_sha256]
        assert (r.keep_id, r.group_size) == (keep[t], groups[t])
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(groups)  # of repeated rows one stays
    stay = exact_dedup.survivors(docs, entries, index, **weak)
    assert stay.columns == docs.columns and stay.count() == len(groups)


def test_quality_counts(spark, docs):
    got = {(r.doc_id, r.n_words, r.n_repeat_words, r.base_failed, r.kept) for r in quality_rules.judge(spark, docs).collect()}
    assert (3, 0, 0, True, False) in got and (6, 9000, 9000, True, False) in got and (1, 14, 0, False, True) in got
    assert quality_rules.keep(spark, docs).columns == docs.columns


def removed(texts, span):
    seen = Counter(x[i:i + span] for x in texts for i in range(len(x) - span + 1))
    out = []
    for x in texts:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - span + 1):
            if seen[x[i:i + span]] > 1:
                gone[i:i + span] = True
        out.append(bytes(np.frombuffer(x, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("hot", [1 << 24, 200])  # 200: every key is split
def test_suffix_dedup_is_brute_force(spark, hot):
    rng = np.random.default_rng(3)
    passage = "".join(rng.choice(list("abcdef"), 90))
    texts = [None, "", "a" * 200] + ["".join(rng.choice(list("abcd"), 60)) + passage[k:] + "é" * k for k in range(12)] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = removed([(t or "").encode() for t in texts], 40)
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.cleaned(spark, docs, 40, 1 << 20, hot).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_ngram_groups_are_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(60)]
    texts = {0: None, 1: " ", 2: "Two words", 3: "two WORDS"}
    for i in range(4, 40):
        words = list(base)
        for at in rng.integers(0, 60, rng.integers(0, 4)):
            words[at] = f"x{rng.integers(0, 5)}"
        texts[i] = " ".join(words[: rng.integers(20, 61)])
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j:j + 4]) for j in range(max(1, len(w) - 3))} if w else set()
    root = dict.fromkeys(texts)
    root = {i: i for i in texts}
    for _ in texts:
        for a in texts:
            for b in texts:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    docs = spark.createDataFrame([*texts.items(), (None, texts[4])], "doc_id long, text string")
    for many in (64, 2):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.groups(spark, docs, 4, 85, 100, many).collect()}
        assert got.pop(None)[1] is None
        assert got == {i: (len(sets[i]), root[i]) for i in texts}


ODD = ["", " ", "  a", "a  b\n\n c", "it's we'll 12ab", "\x1c a\x1c\x1cb", "   x", "a  b", "日本語 テキスト", "é Å", "a" * 300,
       "<|endoftext|> x<|endoftext|>", "\r\n\t x \r", "don't.,;stop!?? 3.14", "\U0001f600 ‍", "word,word;  -- =="]


def test_both_encoders_are_the_library():
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(VOCABULARY)
    own, encoder = bpe._loaded(VOCABULARY)
    for texts in (ODD, ODD):  # the second time from the cache
        want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert encoder.encode(texts) == want
        assert token_store._encoder(VOCABULARY).encode(texts) == want
        assert [own.decode(x) for x in want] == [library.decode(np.frombuffer(x, "<u4").tolist(), skip_special_tokens=False)
                                                 for x in want]


def test_token_store_round_trip(spark, docs):
    path = scratch_path(spark, "store-test")
    token_store.write(spark, docs, path, VOCABULARY)
    rows = sorted(token_store.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((d for d, _, _ in ROWS), key=lambda d: -1 if d is None else d)
    start = 0
    for r in rows:
        assert r.start == start and bytes(r.ids).endswith((2).to_bytes(4, "little"))
        start += len(r.ids) // 4
    one = token_store.read(spark, path, 6).collect()
    assert [zlib.crc32(x.ids) for x in one] == [zlib.crc32(r.ids) for r in rows if r.doc_id == 6]


def test_chat_survives_hostile_turns(spark):
    turns = [(1, 0, "user", "~0 <|x ~1"), (1, 1, "assistant", "a<|im_end|>\n"), (2, 0, "odd\nrole", "<|im_start|>"), (2, 0, None, None),
             (3, None, "assistant", "x"), (3, 1, "assistant", "y"), (4, 0, "user esc", "t")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = chat.formatted(df)
    assert out.where(chat.parse(F.col("formatted")) != F.col("turns")).count() == 0
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    assert got[3].loss_chars == 2 and got[3].loss_sha256 == hashlib.sha256(b"xy").hexdigest() and got[2].n_turns == 2
    spans = {r.conv_id: [r.formatted[s.start:s.end] for s in r.spans] for r in chat.loss_spans(out).collect()}
    assert spans[3] == ["x", "y"] and spans[1] == ["a~1im_end|>\n"]


def test_mixing(spark, docs):
    goal = mixing.targets([("a", 100), ("b", 10), (None, 50)])
    assert goal["b"] == 30.0 and abs(sum(goal.values()) - 160) < 1e-9
    rows = [mixing.mix(spark, docs, mixing.words()).select("row.doc_id", "size", "copies").collect() for _ in range(2)]
    assert sorted(rows[0], key=str) == sorted(rows[1], key=str) and len(rows[0]) == len(ROWS)
    assert sum(r.copies * r["size"] for r in rows[0]) <= sum(r["size"] for r in rows[0])


def test_sharding(spark, docs):
    path = scratch_path(spark, "shards-test")
    sharding.write(spark, docs, path, shards=5)
    got = spark.read.parquet(path).collect()
    per = Counter(r.shard for r in got)
    assert max(per.values()) - min(per.values()) <= 1 and len(got) == len(ROWS)
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in per.items())
    assert sorted(sharding.fisher_yates(100, (1, 2))) == list(range(100))


def test_language(spark, docs, small_dir):
    model = language.Model([(0, "ab", "x", 5), (0, "cd", "y", 1), (1, "q", "y", 3), (2, "^q", "y", 2), (2, "ab", "x", 2)])
    assert model.predict("ab ab") == ("x", model.predict("ab ab")[1]) and model.predict("qq")[0] == "y"
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[5].lang_pred == "und" and len(got) == len({d for d, _, _ in ROWS})
    r = language.op10_language_id(spark, small_dir).join(spark.read.parquet(f"{small_dir}/documents.parquet"), "doc_id") \
        .where("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert r[0] > 0.95


def test_empty_tables(spark, docs):
    none = docs.where("false")
    assert exact_dedup.membership(none, *exact_dedup.build_index(spark, none)).count() == 0
    assert quality_rules.judge(spark, none).count() == 0
    assert suffix_dedup.cleaned(spark, none).count() == 0
    assert ngram_join.groups(spark, none).count() == 0
    assert bpe.encode_decode(none, VOCABULARY).count() == 0
    assert mixing.mix(spark, none, mixing.words()).count() == 0
    assert sharding.shuffled(spark, none).count() == 0
    assert language.predict(none, language.fit(none)).count() == 0
    path = scratch_path(spark, "store-empty")
    token_store.write(spark, none, path, VOCABULARY)
    assert token_store.read(spark, path).count() == 0


def test_pipeline(spark, small_dir):
    out = corpus_pipeline.run(spark, small_dir).collect()
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    good = {r.doc_id for r in quality_rules.judge(spark, docs).where("kept").collect()}
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    last = {t: d for d, t in sorted(text.items())}
    sets = {}
    for d in last.values():
        w = text[d].encode().lower().split()
        sets[d] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))}
    root = {d: d for d in sets}
    for a in sorted(sets):  # brute force over all pairs, to the fixed point
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((root[a], root[b]))
                root = {d: lo if r == hi else r for d, r in root.items()}
    stay = {d for d, r in root.items() if d == r}
    assert {r.doc_id for r in out} <= stay and all(r.round_trip for r in out)
    assert max(Counter(r.doc_id for r in out).values()) <= mixing.COPIES
    words = {d: len(text[d].encode().split()) for d in stay}
    assert sum(words[r.doc_id] for r in out) <= sum(words.values())
