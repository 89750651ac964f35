"""Skill lists: parsed from responses, validated, recovered from the text, put together as items."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillweave.functions.arrays import let, string_array
from skillweave.functions.text import gram_terms, skill_normalise, strip, text_or_empty
from skillweave.operators.joins import lookup_join

# Rules for acceptable skills.
BLOCKED_FRAGMENTS = ("university", "college", "club", "association", "city", "state", "country")
SOFT_DENYLIST = (
    "team player", "hard worker", "hard working", "self motivated", "quick learner", "fast learner", "punctual",
    "sincere", "dedicated", "good communication", "excellent communication", "strong communication",
    "communication skill", "communication skills",
)
TECHNICAL_KEYWORDS = (
    "python", "java", "sql", "c++", "c#", "javascript", "typescript", "html", "css", "excel", "powerpoint", "word",
    "tableau", "power bi", "sap", "oracle", "mysql", "postgresql", "mongodb", "linux", "aws", "azure", "gcp", "docker",
    "kubernetes", "tensorflow", "pytorch", "scikit-learn", "machine learning", "data analysis", "project management",
    "agile", "jira", "git", "github", "salesforce", "hadoop", "spark", "etl", "hris", "payroll", "recruitment",
)
SOFT_KEYWORDS = (
    "communication", "leadership", "teamwork", "problem solving", "time management", "adaptability", "negotiation",
    "conflict resolution", "critical thinking", "attention to detail", "collaboration", "interpersonal", "organization",
)
TECHNICAL_DEFAULTS = ("excel", "microsoft office", "data entry")
SOFT_DEFAULTS = ("communication", "teamwork")
TECHNICAL_WORDS, SOFT_WORDS = 5, 4
TECHNICAL_MAX, SOFT_MAX = 20, 10
TECHNICAL_MIN, SOFT_MIN = 3, 2

SKILLS_TYPE = "technical array<string>, soft array<string>"


def _none() -> Column:
    return F.array().cast("array<string>")


def extract_json_block(col: Column) -> Column:
    """From the first ``{`` to the last ``}``, across lines; the text itself when there is none."""
    block = F.regexp_extract(col, r"(?s)\{.*\}", 0)
    return F.when(block != "", block).otherwise(col)


def parse_skill_response(df: DataFrame, key: str = "ID", raw: str = "response") -> DataFrame:
    """(key, technical, soft) of a JSON answer; whatever is no list becomes an empty one.

    The block is read as the only element of an array: text behind its closing brace makes it invalid.
    """
    block = F.concat(F.lit("["), extract_json_block(text_or_empty(F.col(raw))), F.lit("]"))
    parsed = F.from_json(block, "array<struct<technical: array<string>, soft: array<string>>>", {"allowSingleQuotes": "false"})
    return df.select(key, F.when(F.size(parsed) == 1, F.get(parsed, F.lit(0))).alias("_p")).select(
        key, F.coalesce("_p.technical", _none()).alias("technical"), F.coalesce("_p.soft", _none()).alias("soft")
    )


def _named(item: Column) -> Column:
    return skill_normalise(F.coalesce(item, F.lit("none")))


def _acceptable(name: Column, max_words: int) -> Column:
    blocked = F.lit(False)
    for fragment in BLOCKED_FRAGMENTS:
        blocked = blocked | F.contains(name, F.lit(fragment))
    return (name != "") & (F.size(F.split(name, " ")) <= max_words) & ~blocked


def _technical(name: Column) -> Column:
    return _acceptable(name, TECHNICAL_WORDS)


def _soft(name: Column) -> Column:
    return _acceptable(name, SOFT_WORDS) & ~name.isin(*SOFT_DENYLIST)


def keep_technical(item: Column) -> Column:
    return let(_named(item), _technical)


def keep_soft(item: Column) -> Column:
    return let(_named(item), _soft)


def _tidy(items: Column, acceptable: Callable[[Column], Column], limit: int) -> Column:
    names = F.array_distinct(F.transform(F.coalesce(items, _none()), _named))
    return F.slice(F.sort_array(F.filter(names, acceptable)), 1, limit)


def clean_skills(df: DataFrame) -> DataFrame:
    """Both lists filtered, normalised, distinct, in sort order and cut to their lengths."""
    return df.withColumns(
        {
            "technical": _tidy(F.col("technical"), _technical, TECHNICAL_MAX),
            "soft": _tidy(F.col("soft"), _soft, SOFT_MAX),
        }
    )


def is_empty_skills(technical: Column | None = None, soft: Column | None = None) -> Column:
    technical = F.col("technical") if technical is None else technical
    soft = F.col("soft") if soft is None else soft
    return (F.size(F.coalesce(technical, _none())) == 0) & (F.size(F.coalesce(soft, _none())) == 0)


def _mentioned(padded: Column, keywords: Sequence[str]) -> Column:
    return F.filter(string_array(list(keywords)), lambda word: F.contains(padded, F.concat(F.lit(" "), word, F.lit(" "))))


def match_keywords(
    df: DataFrame,
    key: str = "ID",
    text: str = "clean_text",
    technical: Sequence[str] = TECHNICAL_KEYWORDS,
    soft: Sequence[str] = SOFT_KEYWORDS,
) -> DataFrame:
    """(key, technical, soft): the keywords that occur as whole words or phrases; no join, no shuffle."""
    padded = F.concat(F.lit(" "), skill_normalise(text_or_empty(F.col(text))), F.lit(" "))
    return df.select(key, padded.alias("_padded")).select(
        key, _mentioned(F.col("_padded"), technical).alias("technical"), _mentioned(F.col("_padded"), soft).alias("soft")
    )


def match_keyword_table(df: DataFrame, keywords: DataFrame, key: str = "ID", text: str = "clean_text") -> DataFrame:
    """The same for a keyword table (keyword, kind) of any size, by equi-join on the word n-grams.

    The longest keyword of the table says how long the n-grams have to be.
    """
    max_words = keywords.agg(F.max(F.size(F.split("keyword", " ")))).first()[0] or 1
    words = F.filter(F.split(skill_normalise(text_or_empty(F.col(text))), " "), lambda w: w != "")
    grams = df.select(key, F.explode(F.array_distinct(gram_terms(words, 1, max_words))).alias("keyword"))
    table = keywords.select("keyword", "kind").distinct()
    found = (
        lookup_join(grams, table, "keyword")
        .groupBy(key)
        .agg(
            F.array_sort(F.collect_set(F.when(F.col("kind") == "technical", F.col("keyword")))).alias("technical"),
            F.array_sort(F.collect_set(F.when(F.col("kind") == "soft", F.col("keyword")))).alias("soft"),
        )
    )
    return df.select(key).join(found, key, "left").select(
        key, F.coalesce("technical", _none()).alias("technical"), F.coalesce("soft", _none()).alias("soft")
    )


def _fill(items: Column, defaults: Sequence[str], least: int) -> Column:
    missing = F.greatest(F.lit(0), F.lit(least) - F.size(items))
    return F.concat(items, F.slice(F.array_except(string_array(list(defaults)), items), F.lit(1), missing))


def backfill_skills(df: DataFrame) -> DataFrame:
    """Defaults in their order until a list has its least length, then cleaned again."""
    filled = clean_skills(df).withColumns(
        {
            "technical": _fill(F.col("technical"), TECHNICAL_DEFAULTS, TECHNICAL_MIN),
            "soft": _fill(F.col("soft"), SOFT_DEFAULTS, SOFT_MIN),
        }
    )
    return clean_skills(filled)


def fallback_skills(df: DataFrame, key: str = "ID", text: str = "clean_text", **keywords: Sequence[str]) -> DataFrame:
    """Skills from the text alone: keywords, then defaults."""
    return backfill_skills(match_keywords(df, key, text, **keywords))


def skills_with_fallback(df: DataFrame, key: str = "ID", text: str = "clean_text", **keywords: Sequence[str]) -> DataFrame:
    """(key, technical, soft, recovered): the row's own lists, or the fallback where both are empty.

    ``df`` carries the text and the parsed lists in the same row, so nothing is joined.
    """
    padded = F.concat(F.lit(" "), skill_normalise(text_or_empty(F.col(text))), F.lit(" "))
    own = clean_skills(df.select(key, "technical", "soft", padded.alias("_padded"))).select(
        key, F.col("technical").alias("_technical"), F.col("soft").alias("_soft"), "_padded"
    )
    other = backfill_skills(
        own.withColumns(
            {
                "technical": _mentioned(F.col("_padded"), keywords.get("technical", TECHNICAL_KEYWORDS)),
                "soft": _mentioned(F.col("_padded"), keywords.get("soft", SOFT_KEYWORDS)),
            }
        )
    )
    empty = is_empty_skills(F.col("_technical"), F.col("_soft"))
    return other.select(
        key,
        F.when(empty, F.col("technical")).otherwise(F.col("_technical")).alias("technical"),
        F.when(empty, F.col("soft")).otherwise(F.col("_soft")).alias("soft"),
        empty.alias("recovered"),
    )


def extract_skills(
    df: DataFrame,
    key: str = "ID",
    text: str = "clean_text",
    extractor: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None,
) -> DataFrame:
    """Skills of every profile by a caller's extractor, with the keyword fallback for empty answers.

    The extractor maps batches with (key, text) to batches with (key, technical, soft), in tasks. It
    must answer every key once. Without one, all profiles take the keyword fallback.
    """
    if extractor is None:
        return fallback_skills(df, key, text).withColumn("recovered", F.lit(True))
    kind = df.schema[key].dataType.simpleString()
    answers = df.select(key, text).mapInPandas(extractor, f"`{key}` {kind}, {SKILLS_TYPE}")
    return skills_with_fallback(df.select(key, text).join(answers, key, "left"), key, text)


def skill_items(df: DataFrame) -> Column:
    """Technical and soft skills of a row as one list, trimmed and in lower case, blanks dropped."""
    both = F.concat(F.coalesce(F.col("technical"), _none()), F.coalesce(F.col("soft"), _none()))
    lowered = F.transform(both, lambda x: F.lower(strip(F.coalesce(x, F.lit("none")))))
    return F.filter(lowered, lambda x: x != "")
