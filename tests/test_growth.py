"""Steps that have to grow no faster than their input."""

from __future__ import annotations

import random

import pyarrow as pa
from conftest import rows
from pyspark import StorageLevel
from pyspark.sql import functions as F

from skillweave.functions.text import TAG, clean_tokens, drop_stopwords, letters_only
from skillweave.operators import categories, cleaning, clustering, embedding, features
from skillweave.operators.categories import infer_categories
from skillweave.plans.catalog.model_queries import ngram_counts


def test_only_grams_of_variants_leave_a_text(spark, monkeypatch):
    rng = random.Random(1)
    texts = [(n, " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6))) for _ in range(30))) for n in range(200)]
    texts += [(200, None), (200, "fa cab"), (None, "fa cab"), (201, ""), (202, "Fa-CAB 9"), (203, "x")]
    df = spark.createDataFrame(texts, "JobID int, clean_text string")
    names = spark.createDataFrame([("fa-cab",), ("B",), ("edge",), ("nowhere",), ("g a",), ("9",)], "Category string")
    sizes, join = [], categories.lookup_join

    def counted(facts, *options, **more):
        sizes.append(facts.count())
        return join(facts, *options, **more)

    monkeypatch.setattr(categories, "lookup_join", counted)
    for word_boundary in (False, True):
        inline = infer_categories(df.where("JobID IS NOT NULL AND JobID <> 200"), names, {}, word_boundary=word_boundary)
        many = infer_categories(df, names, {}, word_boundary=word_boundary, max_inline_variants=0)
        assert rows(many.where("JobID IS NOT NULL AND JobID <> 200")) == rows(inline)
        found = ["fa-cab"] if word_boundary else ["B", "fa-cab"]
        assert rows(many.where("JobID = 200")) == [(200, found), (200, [])]
    # At most one gram per variant and text; all grams of a text are about 300.
    assert max(sizes) <= 6 * len(texts)


def test_lemmas_by_join_on_repeated_and_missing_keys(spark):
    df = spark.createDataFrame([(1, ["cats", "cat", "dogs"]), (1, ["cats", "men"]), (None, ["cats", "man"]), (2, None), (3, [])], "ID int, tokens array<string>")
    found = cleaning.lemmatise(df.where("ID IS NOT NULL"), max_inline_lemmas=0)
    assert rows(found) == rows(cleaning.lemmatise(df.where("ID IS NOT NULL")))
    assert (1, ["cat", "cat", "dogs"]) in rows(found)


def test_words_are_replaced_in_slices(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(cleaning, "ROWS_AT_ONCE", 2)
    column = pa.array([["a", "b"], None, [], ["b", None], ["c"]], pa.list_(pa.string()))
    found = cleaning._replaced(column.slice(1), pa.array(["b"]), pa.array(["B"]))
    assert found.to_pylist() == [None, [], ["B", None], ["c"]]
    assert cleaning._replaced(column.slice(5), pa.array(["b"]), pa.array(["B"])).to_pylist() == []


def test_the_least_term_needs_no_sort_of_all_terms(spark, sf):
    plan = ngram_counts(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    df = spark.createDataFrame([(1, "b a b"), (2, "zz yy zz yy"), (3, None)], "ID int, clean_text string")
    nested = features.term_frequencies(df, nested=True).select("ID", F.inline("counts"))
    assert rows(nested) == rows(features.term_frequencies(df))


def test_fits_keep_their_own_vectors(spark, monkeypatch):
    seen, fit = [], clustering.KMeans.fit

    def watched(self, df, *options):
        seen.append(df.storageLevel)
        return fit(self, df, *options)

    monkeypatch.setattr(clustering.KMeans, "fit", watched)
    rng = random.Random(2)
    points = spark.createDataFrame([(n, [rng.random(), rng.random()]) for n in range(50)], "ID int, embedding array<double>")
    clustering.kmeans_fit(points, 2, n_init=2)
    clustering.kmeans_sweep(points, 2, 2, n_init=1)
    # A table that is kept already makes MLlib build its vectors again at every step.
    assert seen == [StorageLevel.NONE] * 3


def test_equal_terms_are_hashed_once(spark, monkeypatch):
    """As the md5 of every term by itself has it, over several slices of rows, and without an md5 per word in the plan."""
    texts = ["b a b", "", None, "naïve b  x", *["a c"] * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "ID int, clean_text string").coalesce(1)
    for grams in (1, 2):
        hashed = df.select("ID", embedding.hashed_terms(F.col("clean_text"), grams, embedding.portable_hash).alias("h"))
        assert grams == 2 or "md5" not in hashed._jdf.queryExecution().toString()
        plain = df.select("ID", embedding.hashed_terms(F.col("clean_text"), grams, lambda t: embedding.portable_hash(t)).alias("h"))
        assert sorted(map(tuple, hashed.collect())) == sorted(map(tuple, plain.collect()))
        weights = [embedding.inverse_frequencies(df, dim=7, grams=grams, term_hash=h) for h in (embedding.portable_hash, lambda t: embedding.portable_hash(t))]
        assert weights[0] == weights[1]


def test_words_are_split_without_a_second_pass(spark):
    """Tokens as the letters-only text has them, with and without tags, and no pattern pass over a text without a tag's start."""
    texts = [(i, t) for i, t in enumerate(["", None, "<b>Red</b> fish<br/>s", "a < b, C3PO's", "É tags<unclosed", "x" * 3 + "\nthe  DOGS-9dogs "])]
    df = spark.createDataFrame(texts, "ID int, t string")
    letters = letters_only(F.regexp_replace(F.coalesce("t", F.lit("")), TAG, " "))
    plain = drop_stopwords(F.filter(F.split(letters, " "), lambda w: w != ""))
    got = df.select("ID", clean_tokens(F.col("t")).alias("w"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.select("ID", plain.alias("w")).collect()))
    assert got._jdf.queryExecution().analyzed().toString().count("regexp_replace") == 1


def test_words_are_replaced_a_part_at_a_time(monkeypatch):
    monkeypatch.setattr(cleaning, "WORDS_AT_ONCE", 3)
    lists = pa.array([["dogs", "cat", "dogs"], [], None, ["dogs"] * 5, ["men"], ["x", "dogs"]])
    looked_up = []
    real = cleaning.pc.index_in
    monkeypatch.setattr(cleaning.pc, "index_in", lambda words, value_set: looked_up.append(len(words)) or real(words, value_set=value_set))
    got = cleaning._replaced(lists.slice(0), pa.array(["dogs", "men"]), pa.array(["dog", "man"]))
    assert got.to_pylist() == [["dog", "cat", "dog"], [], None, ["dog"] * 5, ["man"], ["x", "dog"]]
    assert looked_up == [2, 1, 3]  # different words of each part, not all ten


def test_texts_are_replaced_without_listing_their_words(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "CHARS_AT_ONCE", 9)
    texts = pa.array(["dogs cat dogs", "", "dogs", "men", "x dogs men"])
    listed, real = [], cleaning._replaced
    monkeypatch.setattr(cleaning, "_replaced", lambda words, *table: listed.append(len(words)) or real(words, *table))
    got = cleaning._text_replaced(texts, pa.array(["dogs", "men"]), pa.array(["dog", "man"]))
    assert got.to_pylist() == ["dog cat dog", "", "dog", "man", "x dog man"] and max(listed) < 5
    assert cleaning._text_replaced(texts.slice(5), pa.array(["dogs"]), pa.array(["dog"])).to_pylist() == []
    df = spark.createDataFrame([(1, ["cats", "cat", "dogs"]), (2, []), (3, ["x"])], "ID int, tokens array<string>")
    for inline in (100, 0):
        found = cleaning.lemmatise(df, max_inline_lemmas=inline, joined="clean")
        assert rows(found) == [(1, "cat cat dogs"), (2, ""), (3, "x")]
    assert rows(cleaning.lemmatise(df.where("ID > 1"), joined="clean")) == [(2, ""), (3, "x")]
