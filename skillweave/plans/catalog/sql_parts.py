"""Pieces of SQL that several twins share."""

from __future__ import annotations

from skillweave.functions.text import ENGLISH_STOPWORDS, SPACE
from skillweave.operators.cleaning import NOUN_SUFFIXES

STOPS = ", ".join(f"'{w}'" for w in ENGLISH_STOPWORDS)


def letters(expr: str) -> str:
    return f"trim(regexp_replace(lower({expr}), '[^a-z]+', ' ', 'g'))"


def collapse(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{SPACE}+', ' ', 'g'))"


def untag(expr: str) -> str:
    return f"regexp_replace({expr}, '<[^>]+>', ' ', 'g')"


def alnum(expr: str) -> str:
    return f"trim(regexp_replace(lower({expr}), '[^a-z0-9]+', ' ', 'g'))"


def clean_ctes(table: str, key: str, text: str, prefix: str = "", lemmas: str | None = None) -> str:
    """CTEs ending in ``{prefix}clean(id, words, clean_text)``; ``lemmas`` names another corpus' table."""
    p = prefix
    body = f"""
{p}split AS (SELECT {key} AS id, string_split({letters(untag(f"coalesce({text}, '')"))}, ' ') AS words FROM {table}),
{p}token AS (
  SELECT id, pos, word FROM (
    SELECT id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM {p}split)
  WHERE length(word) > 1 AND word NOT IN ({STOPS})),"""
    if lemmas is None:
        lemmas = f"{p}lemma"
        forms = "\n  UNION ALL ".join(
            f"SELECT word AS surface, substr(word, 1, length(word) - {len(end)}) || '{new}' AS form FROM {p}vocab WHERE word LIKE '%{end}'"
            for end, new in NOUN_SUFFIXES
        )
        body += f"""
{p}vocab AS (SELECT DISTINCT word FROM {p}token),
{p}form AS ({forms}),
{p}lemma AS (
  SELECT surface, form AS lemma FROM (
    SELECT surface, form, row_number() OVER (PARTITION BY surface ORDER BY length(form), form) AS n
    FROM {p}form WHERE form IN (SELECT word FROM {p}vocab)) WHERE n = 1),"""
    return (
        body
        + f"""
{p}base AS (SELECT t.id, t.pos, coalesce(l.lemma, t.word) AS word FROM {p}token t LEFT JOIN {lemmas} l ON l.surface = t.word),
{p}clean AS (
  SELECT s.id, coalesce(b.clean_text, '') AS clean_text
  FROM {p}split s LEFT JOIN (SELECT id, string_agg(word, ' ' ORDER BY pos) AS clean_text FROM {p}base GROUP BY id) b ON b.id = s.id)"""
    )


def quality_values(where: str = "") -> str:
    """Vectors in long form: (id, label, pos, x)."""
    return f"""
v AS (SELECT vec_id AS id, label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings {where}),
c AS (SELECT label, pos, avg(x) AS m FROM v GROUP BY label, pos),
g AS (SELECT pos, avg(x) AS m FROM v GROUP BY pos),
size AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)"""
