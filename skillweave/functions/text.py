"""Text expressions: all work inside one row and need no Python."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space in Unicode text.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

TAG = "<[^>]+>"

# English stop words as they look once apostrophes are gone.
ENGLISH_STOPWORDS: tuple[str, ...] = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is
    are was were be been being have has had having do does did doing a an the and but if or because as until
    while of at by for with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will just don should now
    d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn
    weren won wouldn
    """.split()
)

PROMPT_CHARS = 4000

# The wording of a skill request.
SYSTEM_PROMPT = "You are a resume skill extractor. Always respond with ONLY valid JSON — no explanation, no markdown."
USER_PROMPT = (
    "Extract all technical and soft skills from this resume.\n"
    "Rules:\n"
    "- Each skill must be 1-4 words (no full sentences).\n"
    "- No years of experience, no job responsibilities.\n"
    '- Return ONLY this JSON format: {"technical": ["skill1", "skill2"], "soft": ["skill3"]}\n\n'
    "Resume:\n"
)


def collapse(col: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(col, SPACE + "+", " "))


def strip(col: Column) -> Column:
    """No white space at the ends."""
    return F.regexp_replace(col, f"^{SPACE}+|{SPACE}+$", "")


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def strip_html(col: Column) -> Column:
    """Tags become a space; the text between them stays, also inside script and style."""
    return collapse(F.regexp_replace(col, TAG, " "))


def letters_only(col: Column) -> Column:
    """Lower case, everything but a-z becomes a space."""
    return F.trim(F.regexp_replace(F.lower(col), "[^a-z]+", " "))


def tokenise(col: Column) -> Column:
    return F.filter(F.split(collapse(col), " "), lambda t: t != "")


def drop_stopwords(tokens: Column, stops: Iterable[str] = ENGLISH_STOPWORDS, min_len: int = 2) -> Column:
    stops = list(stops)

    def keep(token: Column) -> Column:
        long_enough = F.length(token) >= min_len
        return long_enough & ~token.isin(stops) if stops else long_enough

    return F.filter(tokens, keep)


def clean_tokens(col: Column, stops: Iterable[str] = ENGLISH_STOPWORDS) -> Column:
    """Tag-free, letters-only tokens without stop words; an empty array for null or blank text."""
    text = text_or_empty(col)
    untagged = F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, TAG, " ")).otherwise(text)
    return drop_stopwords(F.filter(F.split(F.lower(untagged), "[^a-z]+"), lambda t: t != ""), stops)


def alnum_normalise(col: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", " "))


def skill_normalise(col: Column) -> Column:
    return collapse(F.lower(col))


def truncate_text(col: Column, n: int = PROMPT_CHARS) -> Column:
    return F.substring(col, 1, n)


def word_terms(col: Column, low: int = 1, high: int = 1) -> Column:
    """Word n-grams of every size from ``low`` to ``high``; words are runs of 2+ word characters."""
    return gram_terms(plain_words(col), low, high)


def plain_words(col: Column) -> Column:
    """The lower-case runs of 2+ word characters. What separates runs is split away, which is cheaper than extracting every run."""
    return F.filter(F.split(F.lower(col), r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) >= 2)


def gram_terms(words: Column, low: int = 1, high: int = 1) -> Column:
    from skillweave.functions.arrays import let

    def grams(w: Column, n: int) -> Column:
        if n == 1:
            return w
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(w, i - 1 + j) for j in range(n)]))

    return let(words, lambda w: F.concat(*[grams(w, n) for n in range(low, high + 1)]))
