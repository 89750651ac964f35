"""Which categories a text speaks of, by name variants and aliases."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillweave.functions.arrays import let
from skillweave.functions.text import alnum_normalise, text_or_empty
from skillweave.operators.joins import lookup_join
from skillweave.session import cut_lineage

MAX_INLINE_VARIANTS = 2_000
#: All characters of a normalised text.
LETTERS = " 0123456789abcdefghijklmnopqrstuvwxyz"

# Wording of job posts that stands for a category.
CATEGORY_ALIASES: dict[str, list[str]] = {
    "INFORMATION-TECHNOLOGY": [
        "software developer", "software engineer", "web developer", "full stack", "frontend", "backend",
        "programmer", "python", "java", "dot net", "asp net", "devops", "cloud engineer",
    ],
    "BUSINESS-DEVELOPMENT": ["business development", "lead generation", "b2b sales"],
    "PUBLIC-RELATIONS": ["public relations", "media relations", "press release"],
    "DIGITAL-MEDIA": ["digital marketing", "digital media", "seo", "sem", "social media"],
    "HR": ["human resources", "talent acquisition", "recruiter", "hr executive"],
    "BPO": ["bpo", "call center", "voice process", "customer support"],
    "ACCOUNTANT": ["accountant", "bookkeeping", "tally", "audit", "gst"],
    "FINANCE": ["financial analyst", "finance", "fp a", "investment"],
    "SALES": ["sales executive", "inside sales", "field sales", "account manager"],
    "TEACHER": ["teacher", "tutor", "faculty", "lecturer"],
}


def category_variants(categories: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """(Category, variant): the name with dashes as spaces, without dashes, and its aliases."""
    aliases = CATEGORY_ALIASES if aliases is None else aliases
    name = F.upper(F.col("Category").cast("string"))
    spelled = [name, F.replace(name, F.lit("-"), F.lit(" ")), F.replace(name, F.lit("-"), F.lit(""))]
    known = F.array().cast("array<string>")
    for key, words in aliases.items():
        known = F.when(name == key, F.array(*[F.lit(w) for w in words])).otherwise(known)
    return (
        categories.select(F.col("Category").cast("string").alias("Category"))
        .distinct()
        .select("Category", F.explode(F.concat(F.array(*spelled), known)).alias("raw"))
        .select("Category", alnum_normalise(F.col("raw")).alias("variant"))
        .where(F.col("variant") != "")
        .distinct()
    )


def _hit(padded: Column, tokens: Column, variant: Column, word_boundary: bool) -> Column:
    """``padded`` is the normalised text between spaces; variants neither begin nor end with one."""
    within = F.contains(padded, F.concat(F.lit(" "), variant, F.lit(" ")) if word_boundary else variant)
    # The words of a one-word variant cannot occur without the variant itself.
    several = F.contains(variant, F.lit(" "))
    return within | (several & (F.size(F.array_except(F.split(variant, " "), tokens)) == 0))


def _padded() -> Column:
    return F.concat(F.lit(" "), F.col("_text"), F.lit(" "))


def infer_categories(
    texts: DataFrame,
    categories: DataFrame,
    aliases: dict[str, list[str]] | None = None,
    key: str = "JobID",
    text: str = "clean_text",
    word_boundary: bool = False,
    max_inline_variants: int = MAX_INLINE_VARIANTS,
) -> DataFrame:
    """(key, matched_categories) for every text, categories in sort order.

    A category matches when one of its variants is a substring of the normalised text or when all
    words of a variant occur in it. Substrings count inside words too ("hr" in "three");
    ``word_boundary`` switches that off.
    """
    normal = texts.select(key, alnum_normalise(text_or_empty(F.col(text))).alias("_text"))
    variants = category_variants(categories, aliases)
    few = variants.limit(max_inline_variants + 1).collect()
    if len(few) <= max_inline_variants:
        return _match_inline(normal, few, key, word_boundary)
    return _match_by_grams(normal, variants, key, word_boundary)


def _match_inline(normal: DataFrame, few: list, key: str, word_boundary: bool) -> DataFrame:
    """Few variants, counted before: test them inside the row, no join."""
    by_category: dict[str, list[str]] = {}
    for row in few:
        by_category.setdefault(row["Category"], []).append(row["variant"])
    if not by_category:
        return normal.select(key, F.array().cast("array<string>").alias("matched_categories"))
    table = F.array(
        *[
            F.struct(F.lit(c).alias("category"), F.array(*[F.lit(v) for v in sorted(by_category[c])]).alias("variants"))
            for c in sorted(by_category)
        ]
    )
    body = F.struct(_padded().alias("padded"), F.array_distinct(F.split("_text", " ")).alias("tokens"))
    found = let(
        body,
        lambda b: F.filter(
            table, lambda c: F.exists(c["variants"], lambda v: _hit(b["padded"], b["tokens"], v, word_boundary))
        ),
    )
    return normal.select(key, F.transform(found, lambda c: c["category"]).alias("matched_categories"))


def _grams_found(text: Column, wanted: list[str], df: DataFrame) -> Column:
    """Which of the ``wanted`` grams occur in a normalised text: one to three of 37 characters, so at most 52,059 of them."""
    place = {c: i for i, c in enumerate(LETTERS)}
    number = np.full(sum(len(LETTERS) ** n for n in (1, 2, 3)), -1, np.int32)
    for at, gram in enumerate(wanted):
        code = sum(place[c] * len(LETTERS) ** i for i, c in enumerate(reversed(gram)))
        number[code + sum(len(LETTERS) ** n for n in range(1, len(gram)))] = at
    letter = np.zeros(256, np.int32)
    letter[np.frombuffer(LETTERS.encode(), np.uint8)] = np.arange(len(LETTERS))
    shared = df.sparkSession.sparkContext.broadcast((letter, number, np.array(wanted, dtype=object)))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def found(column: pa.Array) -> pa.Array:
        letter, number, wanted = shared.value
        base, out = len(LETTERS), []
        for text in column:
            one = letter[np.frombuffer((text.as_py() or "").encode(), np.uint8)]
            two = one[:-1] * base + one[1:]
            three = two[:-1] * base + one[2:]
            at = np.concatenate([number[one], number[two + base], number[three + base + base * base]])
            out.append(wanted[np.unique(at[at >= 0])].tolist())
        return pa.array(out, pa.list_(pa.string()))

    return found(text)


def _match_by_grams(normal: DataFrame, variants: DataFrame, key: str, word_boundary: bool) -> DataFrame:
    """Many variants: equi-join on a key every match must share, then verify the candidates.

    A variant inside a text has its longest word there, and so has one whose words all occur; with the word come its letter
    grams, so one of these, the rarest in the texts, is a sound key. Only grams of variants ever leave a text's row.
    """

    def grams(word: Column) -> Column:
        # Overlapping matches of a look-ahead: one pass over the word.
        return F.when(F.length(word) >= 3, F.regexp_extract_all(word, F.lit("(?=(.{3}))"), F.lit(1))).otherwise(F.array(word))

    sized = F.transform(F.split("variant", " "), lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))
    longest = F.element_at(F.array_sort(sized), -1)["w"]
    of_variant = cut_lineage(variants.select("Category", "variant", F.explode(F.array_distinct(grams(longest))).alias("_gram")))

    def in_texts(chosen: DataFrame) -> DataFrame:
        wanted = sorted(row[0] for row in chosen.select("_gram").distinct().collect())
        return normal.select(key, F.explode(_grams_found(F.col("_text"), wanted, normal)).alias("_gram"))

    frequency = in_texts(of_variant).groupBy("_gram").agg(F.count("*").alias("_df"))
    rarest = cut_lineage(
        of_variant.join(frequency, "_gram").groupBy("Category", "variant").agg(F.min_by("_gram", F.struct("_df", "_gram")).alias("_gram"))
    )
    candidates = (
        lookup_join(in_texts(rarest), rarest, "_gram").groupBy(key).agg(F.collect_set(F.struct("Category", "variant")).alias("_candidates"))
    )
    body = F.struct(_padded().alias("padded"), F.array_distinct(F.split("_text", " ")).alias("tokens"))
    kept = let(
        body, lambda b: F.filter("_candidates", lambda c: _hit(b["padded"], b["tokens"], c["variant"], word_boundary))
    )
    names = F.array_sort(F.array_distinct(F.transform(kept, lambda c: c["Category"])))
    return normal.join(candidates, key, "left").select(
        key, F.when(F.col("_candidates").isNotNull(), names).otherwise(F.array().cast("array<string>")).alias("matched_categories")
    )
