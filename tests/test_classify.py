from __future__ import annotations

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skillweave.operators import classify, features
from skillweave.operators.metrics import accuracy


@pytest.mark.parametrize("n", [20, 333, 2484])
def test_split_sizes_are_exact_and_stratified(spark, n):
    df = spark.range(n).select(F.col("id").alias("ID"), F.when(F.col("id") % 3 == 0, "big").otherwise((F.col("id") % 7).cast("string")).alias("Category"))
    split = features.stratified_split(df).cache()
    assert split.count() == n == split.select("ID").distinct().count()
    sizes = {r["split"]: r["n"] for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()}
    test = math.ceil(0.15 * n)
    assert sizes["test"] == test and sizes["val"] == math.ceil(0.15 / 0.85 * (n - test))
    per = {(r["Category"], r["split"]): r["n"] for r in split.groupBy("Category", "split").agg(F.count("*").alias("n")).collect()}
    for label in {k[0] for k in per}:
        total = sum(v for k, v in per.items() if k[0] == label)
        assert abs(per.get((label, "test"), 0) - 0.15 * total) < 1.01 and abs(per.get((label, "val"), 0) - 0.15 * total) < 2.01


def test_recorded_split_sizes(spark):
    counts = spark.createDataFrame([("a", 1000), ("b", 1484)], "Category string, n bigint")
    total = features.split_quotas(counts, "Category").agg(F.sum("n_test"), F.sum("n_val")).first()
    assert tuple(total) == (373, 373)


def test_tfidf_equals_the_definition_in_both_forms(spark):
    texts = ["red fish blue fish", "red fish", "one fish", "", "unseen words only"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "ID int, clean_text string")
    vocabulary = features.build_vocabulary(df)
    assert sorted(rows(vocabulary)) == [("fish", 3, 4), ("red", 2, 2), ("red fish", 2, 2)]
    idf = {t: math.log(6 / (1 + d)) + 1 for t, d, _ in rows(vocabulary)}
    got = {(r["ID"], r["term"]): r["weight"] for r in features.tfidf(df, vocabulary, 5).collect()}
    joined = {(r["ID"], r["term"]): r["weight"] for r in features.tfidf(df, vocabulary, 5, max_inline_terms=0).collect()}
    assert joined == {k: pytest.approx(v) for k, v in got.items()}
    raw = {"fish": 2 * idf["fish"], "red": idf["red"], "red fish": idf["red fish"]}
    length = math.sqrt(sum(v * v for v in raw.values()))
    assert {k[1]: v for k, v in got.items() if k[0] == 0} == {t: pytest.approx(v / length) for t, v in raw.items()}
    assert not [k for k in got if k[0] > 2]
    model = features.fit_tfidf(df)
    vector = model.transform(df).where("ID = 0").first()["tfidf"]
    assert {model.terms[i]: v for i, v in zip(vector.indices, vector.values)} == {t: pytest.approx(v / length) for t, v in raw.items()}


def test_vocabulary_limit_breaks_ties_by_term(spark):
    df = spark.createDataFrame([(0, "bb aa cc"), (1, "cc aa bb")], "ID int, clean_text string")
    assert rows(features.build_vocabulary(df, max_features=2, high=1), "term") == [("aa",), ("bb",)]


def test_class_weights(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "Category string")
    assert rows(features.class_weights(df)) == [("a", 3, pytest.approx(4 / 6)), ("b", 1, 2.0)]


def test_three_classifiers_learn(spark):
    rng = random.Random(2)
    words = {"cook": ["oven", "knife", "menu"], "code": ["java", "cloud", "linux"], "law": ["court", "brief", "judge"]}
    data = []
    for i in range(150):
        label = list(words)[i % 3]
        centre = {"cook": [1.0, 0.0], "code": [0.0, 1.0], "law": [-1.0, -1.0]}[label]
        data.append((str(i), label, " ".join(rng.choice(words[label]) for _ in range(6)), [c + rng.gauss(0, 0.2) for c in centre]))
    df = spark.createDataFrame(data, "ID string, Category string, clean_text string, embedding array<double>")
    predictions = classify.classify(df, trees=10, max_depth=5, max_iter=20).cache()
    assert predictions.count() == 3 * 46
    assert all(r["accuracy"] > 0.9 for r in accuracy(predictions, ["model"]).collect())
    assert classify.comparison_table(predictions).count() == 6
    assert classify.side_by_side(predictions.where("split = 'test'")).count() == 23


def test_split_and_weights_keep_rows_without_label(spark):
    from skillweave.operators.features import stratified_split, with_class_weights

    df = spark.createDataFrame([(i, None if i % 10 == 0 else "a" if i % 2 else "b") for i in range(100)], "ID long, Category string")
    assert stratified_split(df).count() == 100
    weighted = with_class_weights(df)
    assert weighted.count() == 100 and weighted.where("Category = 'nan'").count() == 10


def test_forest_tasks_are_few_and_small_and_keep_their_nodes(spark):
    from skillweave.operators.joins import for_iterations

    df = spark.range(60)
    parts = lambda n: for_iterations(df, n, classify.FOREST_ROWS).rdd.getNumPartitions()
    assert [parts(n) for n in (0, 5_000, 36_000, 150_000, 200_000)] == [1, 1, 8, 8, 10]
    assert for_iterations(df, 36_000).rdd.getNumPartitions() == 2
    train = spark.range(300).select((F.col("id") % 3).cast("string").alias("Category"), F.lit(1.0).alias("weight"), classify.array_to_vector(F.array(F.rand(1), F.rand(2) + F.col("id") % 3)).alias("vector"))
    fitted = classify.fit_random_forest(train, "vector", trees=5, max_depth=6)
    assert fitted.model.getCacheNodeIds() and fitted.model.getNumTrees == 5


def test_slices_of_texts_count_the_same_terms(spark, monkeypatch):
    """Terms of one to three words, counted a few words at a time and all at once, as plain counting has them."""
    monkeypatch.setattr(features, "WORDS_AT_ONCE", 5)
    draw = random.Random(1)
    texts = ["", "a", None, *(" ".join(draw.choices(["aa", "bb", "cc", "É日", "x_1"], k=draw.randrange(12))) for _ in range(60))]
    df = spark.createDataFrame(list(enumerate(texts)), "ID int, clean_text string").repartition(2)
    terms = []
    for text in texts:
        words = [w for w in (text or "").lower().split() if len(w) > 1]
        terms.append([" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)])
    every = {t for row in terms for t in row}
    plain = {t: (sum(t in row for row in terms), sum(row.count(t) for row in terms)) for t in every}
    lists = spark.createDataFrame([([w for w in (t or "").lower().split() if len(w) > 1],) for t in texts], "words array<string>")
    sliced = lists.coalesce(1).mapInArrow(features._slice_counts(1, 3), "term string, df bigint, tf bigint")
    assert sliced.groupBy("term").count().where("count > 1").count() > 0  # more slices than one
    vocabulary = features.build_vocabulary(df, min_df=1, high=3)
    assert {r["term"]: (r["df"], r["tf"]) for r in vocabulary.collect()} == plain
    inline = {(r["ID"], r["term"]): r["weight"] for r in features.tfidf(df, vocabulary, len(texts), high=3).collect()}
    joined = {(r["ID"], r["term"]): r["weight"] for r in features.tfidf(df, vocabulary, len(texts), high=3, max_inline_terms=0).collect()}
    assert inline.keys() == joined.keys() and inline == pytest.approx(joined)
    assert features.tfidf(df, vocabulary.where("term = '-'"), len(texts)).count() == 0
