from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skillweave.operators import skills as sk
from skillweave.operators.incremental import cache_status, merge_cache, pending
from skillweave.sources.readers import read_skill_map
from skillweave.streaming.skill_stream import SkillCache, run_incremental

LISTS = "ID string, technical array<string>, soft array<string>"


@pytest.mark.parametrize(
    ("raw", "technical", "soft"),
    [
        ("[1,2]", [], []),
        ("not json", [], []),
        ("", [], []),
        (None, [], []),
        ('{"technical":"a"}', [], []),
        ('{"technical":[1,true,"x"]}', ["1", "true", "x"], []),
        ('Here:\n{"technical":["a"],\n"soft":["b"]} thanks', ["a"], ["b"]),
        ('{"soft":["b"]', [], []),
    ],
)
def test_parse_response(spark, raw, technical, soft):
    df = spark.createDataFrame([("1", raw)], "ID string, response string")
    assert rows(sk.parse_skill_response(df)) == [("1", technical, soft)]


def test_extract_block_is_greedy(spark):
    df = spark.createDataFrame([("a {x} b {y} c",), ("none",)], "t string")
    assert [r[0] for r in df.select(sk.extract_json_block(F.col("t"))).collect()] == ["{x} b {y}", "none"]


def test_clean_skills(spark):
    many = [f"s{n:02d}" for n in range(25)]
    df = spark.createDataFrame(
        [
            ("1", ["one two three four five six", "state law", " Power  BI", "power bi", None, ""], ["a b c d e", "Team Player", "calm"]),
            ("2", list(reversed(many)), list(reversed(many))),
        ],
        LISTS,
    )
    got = {r["ID"]: r for r in sk.clean_skills(df).collect()}
    assert got["1"]["technical"] == ["none", "power bi"] and got["1"]["soft"] == ["calm"]
    assert got["2"]["technical"] == many[:20] and got["2"]["soft"] == many[:10]


def test_fallback_without_keywords_gives_the_defaults(spark):
    df = spark.createDataFrame([("1", "nothing here"), ("2", "Python and sql with leadership"), ("3", None)], "ID string, clean_text string")
    got = {r["ID"]: (r["technical"], r["soft"]) for r in sk.fallback_skills(df).collect()}
    defaults = (["data entry", "excel", "microsoft office"], ["communication", "teamwork"])
    assert got["1"] == defaults and got["3"] == defaults
    assert got["2"] == (["excel", "python", "sql"], ["communication", "leadership"])


def test_fallback_only_for_empty_rows(spark):
    df = spark.createDataFrame([("1", "java", ["sql"], []), ("2", "java", ["state law"], [])], "ID string, clean_text string, technical array<string>, soft array<string>")
    got = {r["ID"]: (r["technical"], r["recovered"]) for r in sk.skills_with_fallback(df).collect()}
    assert got == {"1": (["sql"], False), "2": (["excel", "java", "microsoft office"], True)}


def test_a_callers_extractor(spark):
    def extractor(batches):
        for b in batches:
            yield b.assign(technical=[["made up"] if "x" in t else [] for t in b.clean_text], soft=[[] for _ in b.clean_text])[["ID", "technical", "soft"]]

    df = spark.createDataFrame([("1", "x"), ("2", "y")], "ID string, clean_text string")
    got = {r["ID"]: (r["technical"], r["recovered"]) for r in sk.extract_skills(df, extractor=extractor).collect()}
    assert got["1"] == (["made up"], False) and got["2"][1]


def test_keyword_join_equals_contains(spark):
    rng = random.Random(5)
    alphabet = ["a", "b", "c", "ab", "bc"]
    texts = [(str(n), " ".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))) for n in range(80)]
    words = sorted({" ".join(rng.choice(alphabet) for _ in range(rng.randint(1, 3))) for _ in range(40)})
    df = spark.createDataFrame(texts, "ID string, clean_text string")
    table = spark.createDataFrame([(w, "technical" if i % 2 else "soft") for i, w in enumerate(words)], "keyword string, kind string")
    joined = rows(sk.match_keyword_table(df, table))
    inline = rows(sk.match_keywords(df, technical=words[1::2], soft=words[0::2]))
    expect = sorted([(i, [w for w in words[1::2] if f" {w} " in f" {t} "], [w for w in words[0::2] if f" {w} " in f" {t} "]) for i, t in texts], key=repr)
    assert joined == inline == expect


def test_keywords_may_have_any_number_of_words(spark):
    df = spark.createDataFrame([("1", "x a b c d e f y"), ("2", "a b c")], "ID string, clean_text string")
    table = spark.createDataFrame([("a b c d e f", "soft")], "keyword string, kind string")
    assert rows(sk.match_keyword_table(df, table)) == [("1", [], ["a b c d e f"]), ("2", [], [])]
    assert rows(sk.match_keyword_table(df, table.limit(0))) == [("1", [], []), ("2", [], [])]


def test_a_repeated_cache_entry_does_not_repeat_profiles(spark):
    cache = spark.createDataFrame([("1", [], []), ("1", [], [])], LISTS)
    df = spark.createDataFrame([("1",), ("2",)], "ID string")
    assert rows(pending(df, cache, True)) == [("1",), ("2",)]


def test_cache(spark):
    cache = spark.createDataFrame([("1", ["a"], []), ("2", [], []), ("9", ["z"], [])], LISTS)
    df = spark.createDataFrame([("1",), ("2",), ("3",)], "ID string")
    assert rows(pending(df, cache)) == [("3",)]
    assert rows(pending(df, cache, refill_empty=True)) == [("2",), ("3",)]
    assert tuple(cache_status(df, cache).first()) == (3, 2, 1, 1)
    new = spark.createDataFrame([("2", ["n"], []), ("3", ["m"], [])], LISTS)
    assert rows(merge_cache(cache, new)) == [("1", ["a"], []), ("2", ["n"], []), ("3", ["m"], []), ("9", ["z"], [])]


def test_skill_items_may_repeat_across_lists(spark):
    df = spark.createDataFrame([("1", [" A ", ""], ["a", "b"])], LISTS)
    assert df.select(sk.skill_items(df)).first()[0] == ["a", "a", "b"]


def test_stream_resumes_and_counts_a_repeated_batch_once(spark, tmp_path):
    source, cache_dir, checkpoint = (str(tmp_path / n) for n in ("in", "cache", "cp"))
    schema = "ID string, clean_text string"

    def arrive(*records):
        spark.createDataFrame(records, schema).write.mode("append").parquet(source)

    def run():
        run_incremental(spark.readStream.schema(schema).parquet(source), cache_dir, checkpoint).awaitTermination()

    arrive(("1", "java"), ("2", "python"))
    run()
    run()
    arrive(("2", "sql"), ("3", "sql"))
    run()
    cache = SkillCache(spark, cache_dir)
    got = {r["ID"]: r["technical"] for r in cache.read().collect()}
    assert set(got) == {"1", "2", "3"} and "python" in got["2"]  # cached profiles are not done again
    cache.append(cache.read().where("ID = '3'"), 1)
    assert cache.read().count() == 3


def test_skill_map_file(spark, tmp_path):
    path = tmp_path / "skills.json"
    assert read_skill_map(spark, str(path)).count() == 0
    path.write_text('{"7": {"technical": ["sql"], "soft": []},\n "8": {"soft": ["calm"]}}')
    assert rows(read_skill_map(spark, str(path))) == [("7", ["sql"], []), ("8", [], ["calm"])]


def test_answers_that_are_not_json_are_empty(spark):
    forms = ["{'technical': ['python'], 'soft': ['calm']}", '{"technical": ["a"], "soft": []} and also {"x": 1}', '{"technical": ["a"]', '{"technical": ["a"], "soft": ["b"]} thanks']
    df = spark.createDataFrame(list(enumerate(forms)), "ID int, response string")
    from skillweave.operators.skills import parse_skill_response

    got = {r.ID: (r.technical, r.soft) for r in parse_skill_response(df).collect()}
    assert got == {0: ([], []), 1: ([], []), 2: ([], []), 3: (["a"], ["b"])}
