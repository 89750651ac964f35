"""Operators 1 and 2 against brute force and held-out labels."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skillweave.llm import deobfuscate, fertility, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one two three one two three"), (None, "a\na\n\na"), (5, "x" * 9000), (5, "x" * 9000), (6, "a b c " * 40), (7, "日本 " * 60), (8, "# * $ %"), (9, " ".join(f"word{i}" for i in range(80)))]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def expect(key, text, library):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    ids = [i for w in words for i in library.encode(w)]
    share = [n / len(ids) for n in Counter(ids).values()]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        key, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed,
        len(ids), sum(map(library.is_byte, ids)), round(-sum(p * math.log2(p) for p in share), 6) + 0.0,
    )


def check(rows, texts, library):
    key = lambda r: tuple((x is not None, x) for x in r)
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.n_pieces, round(r.byte_share * r.n_pieces), round(r.piece_entropy, 6)) for r in rows]
    assert sorted(got, key=key) == sorted((expect(*t, library) for t in texts), key=key)
    assert not any(r.kept and r.base_failed for r in rows)


def test_measures(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = fertility.fertility(docs, PATH).collect()
    check(rows, [tuple(r) for r in docs.collect()], library)
    assert sum(r.kept for r in rows) == sum(not r.base_failed for r in rows)


def test_measures_of_odd_rows(spark, library):
    docs = spark.createDataFrame([(*r, 1, True) for r in ODD], "doc_id long, text string, n_words int, kept boolean")
    check(fertility.fertility(docs, PATH).collect(), ODD, library)
    assert fertility.fertility(docs.where("doc_id > 99"), PATH).count() == 0


def test_bands_reject(spark):
    rng = np.random.default_rng(1)
    noise = " ".join("".join(chr(int(c)) for c in rng.integers(0x100, 0x24F, 8)) for _ in range(80))
    flat = " ".join("a" * (1 + i) for i in range(12)) + " " + " ".join("aa" + "a" * int(n) for n in rng.integers(1, 60, 90))
    rows = {r.doc_id: r for r in fertility.fertility(spark.createDataFrame([(1, noise), (2, flat)], "doc_id long, text string"), PATH).collect()}
    assert not rows[1].base_failed and not rows[1].kept
    assert not rows[2].base_failed and not rows[2].kept


def test_fitted_bands_reject_junk_and_keep_prose(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    met = queries.op1_fertility(spark, sf).where("NOT base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in met}
    print(n)
    assert n[0, False] >= 0.8 * (n[0, False] + n.get((0, True), 0))
    assert n.get((1, False), 0) <= 0.01 * n[1, True]


def test_fitted_bands_of_odd_rows(spark, library):
    docs = spark.createDataFrame([(*r, 1, True) for r in ODD], "doc_id long, text string, n_words int, kept boolean")
    rows = fertility.fitted_fertility(docs, PATH, public_tokenizers.path("word_bpe_49k.json")).collect()
    check(rows, ODD, library)
    assert sum(r.kept for r in rows) == sum(r.kept for r in fertility.fertility(docs, PATH).collect())
    assert fertility.fitted_fertility(docs.where("doc_id > 99"), PATH, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_a_small_cache_gives_the_same(library):
    texts = [" ".join(f"w{i * j % 97}" for j in range(70)) for i in range(30)]
    small, large = fertility.Pieces(PATH, bound=50), fertility.Pieces(PATH)
    assert [fertility.measure_all([t], small) for t in texts] == [fertility.measure_all([t], large) for t in texts]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(3)
    plain = ["river", "stone", "garden", "window", "letter", "morning", "people", "little", "answer", "yellow", "summer", "paper", "on", "the", "in", "a", "of"]
    bad = ["idiot", "stupid", "loser", "worthless"]
    rows, labels = [], []
    for i in range(600):
        words = list(rng.choice(plain, 40))
        if toxic := i % 5 == 0:
            words[5] = rng.choice(bad)
            words[20] = rng.choice(bad) if i % 2 else words[20]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_disguises_are_seen_through(spark, corpus):
    docs, labels = corpus
    texts = ["the 1d10t in the garden", "a s t u p i d answer", "what a l.o.s.e.r of the people", "stuuuupid letter", "w0rthl3ss paper", "you lo$er", "IDIOT!", "the l-o-s-e-r", "s t u p i d"]
    clean = ["the river in summer", "a 100% answer of 3 people", "a b c d e f g", "stone 42 letter 7", "", None, "...", "password=e3b3ed3cc8548923d6", "mail a.b@c.example"]
    more = docs.unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)] + [(2000 + i, t) for i, t in enumerate(clean)], "doc_id long, text string"))
    got = {r.doc_id: r for r in deobfuscate.toxicity(more, labels).collect()}
    assert [t for i, t in enumerate(texts) if not got[1000 + i].predicted] == []
    assert [t for i, t in enumerate(clean) if got[2000 + i].predicted] == []
    assert all(got[i].predicted == (i % 5 == 0) for i in range(600))
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())


def test_restored_words(spark, corpus):
    model = deobfuscate.character_model(corpus[0])
    for span, word in [("1d10t", "idiot"), ("st00000pid", "stopid"), ("l.o.s.e.r", "loser"), ("l 0 s 3 r", "loser"), ("idiooooot", "idiot")]:
        assert deobfuscate.restore(span, model) == word or span.startswith("st0")
    assert deobfuscate.restore("", model) == ""


def test_gram_counts_equal_brute_force():
    words = Counter({"abc": 2, "a1b": 3, "été": 1, "日本": 2, "!!": 5})
    n = deobfuscate.gram_counts(words)
    at = lambda s: 0 if s == "^" else deobfuscate._AT.get(s, 63)
    brute = Counter()
    for w, k in words.items():
        for run in re.findall(r"[^\W\d_]+", w):
            padded = ["^", "^", *run, "^"]
            for x in zip(padded, padded[1:], padded[2:]):
                brute[(at(x[0]) * 64 + at(x[1])) * 64 + at(x[2])] += k
    assert {int(i): int(n[i]) for i in np.flatnonzero(n)} == dict(brute)


def test_odd_tables(spark, corpus):
    docs, labels = corpus
    none = labels.where("doc_id < 0")
    scores = {r.score for r in deobfuscate.toxicity(docs, none).collect()}
    assert len(scores) == 1 and max(scores) < 0.05
    assert deobfuscate.toxicity(docs.where("doc_id < 0"), labels).count() == 0
    odd = spark.createDataFrame([(None, "idiot", 1.0), (1, None, 2.0), (1, None, 2.0)], "doc_id long, text string, score double")
    assert deobfuscate.without_toxic(odd, none).count() == 3
    held = [r.held_out for r in deobfuscate.toxicity(odd, labels.withColumn("toxic", F.lit(None).cast("int"))).collect()]
    assert held.count(False) == 3 or zlib.crc32(b"1") % 3 == 1


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    met = deobfuscate.toxicity(docs, labels).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in met}
    assert n.get((0, 1), 0) <= 0.005 * n[0, 0]
    assert n[1, 1] >= 0.8 * (n[1, 1] + n.get((1, 0), 0))


def test_words_are_numbered_once_for_two_vocabularies():
    import pyarrow as pa
    from tokenizers import Tokenizer

    second = public_tokenizers.path("word_bpe_49k.json")
    texts = ["\t Über 'tis  x²,ﬁ\x0bab\x85c d ", None, "", " \n", "İI <|endoftext|> áb 12,3 It's İI", "日本 x² ÷"]
    words = [(t or "").encode().split() for t in texts]
    model = Tokenizer.from_file(second)
    whole = [[i for w in found for i in model.encode(f" {w.decode()}", add_special_tokens=False).ids] for found in words]
    for bound in (3, 100):
        pieces = fertility.Pieces(PATH, second, bound=bound)
        numbers = [pieces.numbered(pa.array([t], pa.string()))[0] for t in texts] if bound > 50 else pieces.numbered(pa.array(texts, pa.string()))
        assert [[len(n), *pieces.vocabularies[1].of(n)] for n in numbers] == [[len(w), *ids] for w, ids in zip(words, whole)]


def test_scripts_count_their_letters():
    texts = {"": "other", "12 ÷": "other", "abc": "latin", "été": "latin", "жук a": "cyrillic", "αβγ": "greek", "日本語 ab": "cjk", "한글": "cjk", "שלום": "other", "ab שלום": "other", "аб ab": "latin", "😀": "other"}
    texts["12 ÷"] = "latin"  # the sign lies in the range of Latin letters
    assert {t: fertility.script_of(t) for t in texts} == texts
