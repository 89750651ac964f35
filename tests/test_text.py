from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skillweave.functions import text as tx
from skillweave.functions.arrays import term_counts
from skillweave.operators.cleaning import build_lemmas, clean_text, lemmatise, prompt_rows
from skillweave.operators.schema import (
    check_aligned,
    resolve_column,
    standardise_jobs,
    standardise_profiles,
    take_first,
    with_surrogate_id,
)


def value(spark, fn, text):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).first()[0]


@pytest.mark.parametrize("text", [None, "", "   ", "12 34", "<p><br/></p>", "<b>1</b>"])
def test_clean_text_of_nothing_is_empty(spark, text):
    df = spark.createDataFrame([("1", text)], "ID string, raw_text string")
    assert clean_text(df).first()["clean_text"] == ""


def test_text_expressions(spark):
    assert value(spark, tx.strip_html, " <p>a <b>b</b>\n c</p> ") == "a b c"
    assert value(spark, tx.letters_only, "C++ & Café No.1") == "c caf no"
    assert value(spark, tx.alnum_normalise, " A-1, b! ") == "a 1 b"
    assert value(spark, tx.skill_normalise, "  Power\t BI ") == "power bi"
    assert value(spark, tx.truncate_text, "x" * 5000) == "x" * 4000
    assert value(spark, tx.tokenise, " a  b ") == ["a", "b"]
    assert value(spark, lambda c: tx.drop_stopwords(tx.tokenise(c)), "the a b big cat don") == ["big", "cat"]
    assert value(spark, lambda c: tx.word_terms(c, 1, 2), "Ab c De_1 f-gh") == ["ab", "de_1", "gh", "ab de_1", "de_1 gh"]


def test_term_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],)], "t array<string>")
    assert [[tuple(x) for x in r[0]] for r in df.select(term_counts(F.col("t"))).collect()] == [[("a", 1), ("b", 2)], []]


def test_stop_words_go_before_lemmas(spark):
    lemmas = spark.createDataFrame([("cats", "the"), ("dogs", "dog")], "surface string, lemma string")
    df = spark.createDataFrame([("1", "The cats and the dogs")], "ID string, raw_text string")
    assert clean_text(df, lemmas=lemmas).first()["clean_text"] == "the dog"


WORDS = [["classes", "class", "boxes", "box", "ladies", "lady", "workmen", "workman", "glass", "wolves", "wolf", "buses"], ["class", "bus"], []]


def test_lemmas_need_a_base_form_in_the_corpus(spark):
    df = spark.createDataFrame([(str(i), w) for i, w in enumerate(WORDS)], "ID string, tokens array<string>")
    found = dict(rows(build_lemmas(df)))
    assert found == {"classes": "class", "boxes": "box", "ladies": "lady", "workmen": "workman", "wolves": "wolf", "buses": "bus"}


def test_both_ways_to_lemmatise_agree(spark):
    df = spark.createDataFrame([(str(i), w) for i, w in enumerate(WORDS)] + [("n", None)], "ID string, tokens array<string>")
    assert rows(lemmatise(df)) == rows(lemmatise(df, max_inline_lemmas=0))
    table = spark.createDataFrame([("class", "course")], "surface string, lemma string")
    given = rows(lemmatise(df, lemmas=table))
    assert given == rows(lemmatise(df, lemmas=table, max_inline_lemmas=0))
    assert ("1", ["course", "bus"]) in given


def test_resolve_column_takes_the_first_candidate(spark):
    df = spark.createDataFrame([(1, 2)], "TEXT int, Resume int")
    assert resolve_column(df, ["Resume_str", "resume", "text"]) == "Resume"
    assert resolve_column(df, ["none"]) is None


def test_standardise(spark):
    raw = spark.createDataFrame([(7, None)], "id int, resume_text string")
    assert rows(standardise_profiles(raw)) == [("7", "unknown", "")]
    with pytest.raises(ValueError):
        standardise_profiles(raw.select("id"))
    jobs = spark.createDataFrame([("Dev", None, "sql")], "title string, skills string, keyword string")
    assert standardise_jobs(jobs, order_by=["title"]).first()["raw_text"] == "Dev  sql"
    with pytest.raises(ValueError):
        standardise_jobs(jobs.select(F.lit(1).alias("id")))


def test_surrogate_ids_are_consecutive_in_order(spark):
    df = spark.range(0, 1000, 1, 7).select((999 - F.col("id")).alias("v"), (F.col("id") % 3).alias("hot"))
    got = rows(with_surrogate_id(df, ["hot", "v"]).orderBy("ID"), "ID", "hot", "v")
    assert [r[0] for r in sorted(got)] == list(range(1000))
    assert [r[1:] for r in sorted(got)] == sorted(r[1:] for r in got)


def test_profiles_without_ids_are_numbered_from_zero(spark):
    raw = spark.createDataFrame([("b",), ("a",)], "text string")
    assert rows(standardise_profiles(raw, ["text"]), "ID", "raw_text") == [("0", "a"), ("1", "b")]


def test_take_first_and_alignment(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "ID int")
    assert [r[0] for r in take_first(df, 2, ["ID"]).collect()] == [1, 2]
    assert check_aligned(df, df, "ID").count() == 3
    with pytest.raises(ValueError):
        check_aligned(df, df.limit(2), "ID")


def test_prompt_rows(spark):
    df = spark.createDataFrame([("1", "y" * 4100)], "ID string, clean_text string")
    system, user = prompt_rows(df).first()["messages"]
    assert system["role"] == "system" and user["content"].endswith("Resume:\n" + "y" * 4000)
