"""Cleaned text: tokens, noun lemmas and the text put together again."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillweave.functions.text import ENGLISH_STOPWORDS, clean_tokens
from skillweave.operators.joins import lookup_join
from skillweave.session import written

MAX_INLINE_LEMMAS = 200_000
#: Rows and words that are replaced together; a longer list is replaced alone.
ROWS_AT_ONCE = 512
WORDS_AT_ONCE = 200_000
CHARS_AT_ONCE = 2_000_000

# Noun endings and what replaces them.
NOUN_SUFFIXES: tuple[tuple[str, str], ...] = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)


def _may_be_inflected(token: Column) -> Column:
    return token.endswith("s") | token.endswith("men")


def build_lemmas(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(surface, lemma) for the inflected nouns of a corpus.

    A suffix rule counts only where the form it yields is itself a word of the corpus. Of several
    such forms the shortest wins, then the first in sort order.
    """
    surface = F.col("word")
    itself = F.struct(surface.alias("form"), F.lit(None).cast("string").alias("surface"))
    derived = [
        F.when(
            surface.endswith(end),
            F.struct(
                F.concat(F.substring(surface, F.lit(1), F.length(surface) - len(end)), F.lit(new)).alias("form"),
                surface.alias("surface"),
            ),
        )
        for end, new in NOUN_SUFFIXES
    ]
    # One pass over the words: a form is in the corpus when it also arrives as a word of its own.
    words = df.select(F.explode(F.array_distinct(tokens)).alias("word")).distinct()
    forms = words.select(F.inline(F.array_compact(F.array(itself, *derived))))
    attested = (
        forms.groupBy("form")
        .agg(F.bool_or(F.col("surface").isNull()).alias("known"), F.collect_set("surface").alias("surfaces"))
        .where(F.col("known"))
        .select("form", F.explode("surfaces").alias("surface"))
    )
    return attested.groupBy("surface").agg(F.min_by("form", F.struct(F.length("form"), "form")).alias("lemma"))


def lemmatise(
    df: DataFrame,
    tokens: str = "tokens",
    lemmas: DataFrame | None = None,
    key: str = "ID",
    max_inline_lemmas: int = MAX_INLINE_LEMMAS,
    joined: str | None = None,
) -> DataFrame:
    """``df`` with every token replaced by its lemma; without a table one is built from the corpus.

    With ``joined`` the tokens, which then have no null and no space, are replaced by that column: their lemmas as one text.

    A table of checked size goes to the tasks and the rows stay in place. A larger one is joined:
    only the distinct tokens it may change are exploded, and ``key`` must then identify a row. Of several lemmas that a given
    table has for a surface the shortest counts, then the first in sort order.
    """
    if lemmas is None:
        table = build_lemmas(df, tokens)
    else:
        named = lemmas.where("surface IS NOT NULL AND lemma IS NOT NULL")
        table = named.groupBy("surface").agg(F.min_by("lemma", F.struct(F.length("lemma"), "lemma")).alias("lemma"))
    table = written(table, "lemmas")  # read several times, and building it is a pass over the texts
    head = table.limit(max_inline_lemmas + 1).toArrow()
    if head.num_rows <= max_inline_lemmas:
        return _lemmatise_text(df, tokens, head, joined) if joined else _lemmatise_inline(df, tokens, head)
    changed = _lemmatise_by_join(written(df, "tokens"), tokens, table, key, any_token=lemmas is not None)
    return changed.withColumn(joined, F.array_join(tokens, " ")).drop(tokens) if joined else changed


def _replaced(column: pa.Array, surfaces: pa.Array, forms: pa.Array) -> pa.Array:
    """Lists of words with every word of ``surfaces`` replaced, some words at a time: what is made on the way stays small.

    Equal words of a part are looked up and replaced once, so a part adds its word numbers and the text of its result.
    """

    def some(part: pa.Array) -> pa.Array:
        coded = part.flatten().dictionary_encode()
        words = coded.dictionary
        changed = pc.coalesce(pc.take(forms, pc.index_in(words, value_set=surfaces)), words).take(coded.indices)
        lengths = pc.fill_null(pc.list_value_length(part), 0)
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(lengths).cast(pa.int32())])
        return pa.ListArray.from_arrays(offsets, changed, mask=pc.is_null(part))

    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    parts, start = [], 0
    while start < len(column):
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, min(start + ROWS_AT_ONCE, int(np.searchsorted(ends, done + WORDS_AT_ONCE, "right"))))
        parts.append(some(column.slice(start, stop - start)))
        start = stop
    return pa.concat_arrays(parts) if len(parts) > 1 else parts[0] if parts else column


def _lemmatise_inline(df: DataFrame, tokens: str, table: pa.Table) -> DataFrame:
    if not table.num_rows:
        return df
    shared = df.sparkSession.sparkContext.broadcast(tuple(table.column(c).combine_chunks().cast(pa.string()) for c in ("surface", "lemma")))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def replace(column: pa.Array) -> pa.Array:
        return _replaced(column, *shared.value)

    return df.withColumn(tokens, replace(F.col(tokens)))


def _text_replaced(column: pa.Array, surfaces: pa.Array, forms: pa.Array) -> pa.Array:
    """As ``_replaced`` for texts of words with one space between. The words of some rows at a time are listed, never those of a whole batch."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    parts, start = [], 0
    while start < len(column):
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, min(start + ROWS_AT_ONCE, int(np.searchsorted(ends, done + CHARS_AT_ONCE, "right"))))
        words = pc.split_pattern(column.slice(start, stop - start), " ")
        parts.append(pc.binary_join(_replaced(words, surfaces, forms), " "))
        start = stop
    return pa.concat_arrays(parts) if len(parts) > 1 else parts[0] if parts else column


def _lemmatise_text(df: DataFrame, tokens: str, table: pa.Table, out: str) -> DataFrame:
    text = F.array_join(tokens, " ")
    if not table.num_rows:
        return df.withColumn(out, text).drop(tokens)
    shared = df.sparkSession.sparkContext.broadcast(tuple(table.column(c).combine_chunks().cast(pa.string()) for c in ("surface", "lemma")))

    @F.arrow_udf(T.StringType())
    def replace(column: pa.Array) -> pa.Array:
        return _text_replaced(column, *shared.value)

    return df.withColumn(out, replace(text)).drop(tokens)


def _lemmatise_by_join(df: DataFrame, tokens: str, table: DataFrame, key: str, any_token: bool) -> DataFrame:
    distinct = F.array_distinct(tokens)
    words = df.select(key, F.explode(distinct if any_token else F.filter(distinct, _may_be_inflected)).alias("surface"))
    found = (
        lookup_join(words, table, "surface", max_broadcast_rows=0)
        .groupBy(key)
        .agg(F.collect_list(F.struct("surface", "lemma")).alias("_lemmas"))
    )

    # A surface has one lemma, so those that the rows of a batch bring along serve all of them.
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def replace(column: pa.Array, lemmas: pa.Array) -> pa.Array:
        known = pa.Table.from_struct_array(lemmas.flatten()).group_by("surface").aggregate([("lemma", "min")])
        surfaces, forms = (known.column(c).combine_chunks().cast(pa.string()) for c in ("surface", "lemma_min"))
        return _replaced(column, surfaces, forms)

    return df.join(found, key, "left").withColumn(tokens, replace(F.col(tokens), F.col("_lemmas"))).drop("_lemmas")


def clean_text(
    df: DataFrame,
    text: str = "raw_text",
    stops: Iterable[str] = ENGLISH_STOPWORDS,
    lemmas: DataFrame | None = None,
    key: str = "ID",
    out: str = "clean_text",
) -> DataFrame:
    """``df`` with ``out``: tags, case, punctuation and stop words gone, nouns as lemmas."""
    tokens = df.withColumn("_clean_tokens", clean_tokens(F.col(text), stops))
    return lemmatise(tokens, "_clean_tokens", lemmas, key, joined=out)


def prompt_rows(df: DataFrame, key: str = "ID", text: str = "clean_text") -> DataFrame:
    """One request per profile for a batch inference service: (key, messages)."""
    from skillweave.functions.text import SYSTEM_PROMPT, USER_PROMPT, text_or_empty, truncate_text

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    request = F.concat(F.lit(USER_PROMPT), truncate_text(text_or_empty(F.col(text))))
    return df.select(key, F.array(message("system", F.lit(SYSTEM_PROMPT)), message("user", request)).alias("messages"))
