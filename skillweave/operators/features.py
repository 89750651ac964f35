"""Splits, vocabulary, TF-IDF and class weights."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillweave.functions.arrays import term_counts
from skillweave.functions.text import plain_words, text_or_empty, word_terms
from skillweave.operators.joins import lookup_join
from skillweave.session import cut_lineage

SEED = 42
TEST_SHARE = 0.15
VALIDATION_SHARE = 0.15
MIN_DF = 2
MAX_FEATURES = 30_000
NGRAMS = (1, 2)

MAX_INLINE_TERMS = 100_000
#: Texts are counted together while they have so many words; a longer text is counted alone.
WORDS_AT_ONCE = 1_000_000

_DRAW_PREFIX = 4


def _quotas(counts: DataFrame, label: str, available: str, draws: Column, total: Column, name: str) -> DataFrame:
    """Shares of ``draws`` by largest remainder, so that they add up exactly; ties by label."""
    exact = F.col(available) / total * draws
    floored = counts.withColumn("_floor", F.floor(exact)).withColumn("_rest", exact - F.col("_floor"))
    # One row per label: the windows see the label table, never the data.
    everything = W.partitionBy(F.lit(1))
    missing = draws - F.sum("_floor").over(everything)
    place = F.row_number().over(everything.orderBy(F.desc("_rest"), label))
    return floored.withColumns({"_missing": missing, "_place": place}).withColumn(
        name, F.col("_floor") + F.when(F.col("_place") <= F.col("_missing"), 1).otherwise(0)
    ).drop("_floor", "_rest", "_missing", "_place")


def split_quotas(counts: DataFrame, label: str, test: float = TEST_SHARE, validation: float = VALIDATION_SHARE) -> DataFrame:
    """(label, n, n_test, n_val): first the test share of all rows, then validation of the rest.

    ``counts`` has one row per label with ``n``.
    """
    everything = W.partitionBy(F.lit(1))
    total = counts.withColumn("_total", F.sum("n").over(everything))
    sized = total.withColumn("_test", F.ceil(F.lit(test) * F.col("_total")))
    kept = _quotas(sized, label, "n", F.col("_total") - F.col("_test"), F.col("_total"), "_keep")
    rest = F.col("_total") - F.col("_test")
    second = kept.withColumns({"_rest_total": rest, "_val": F.ceil(F.lit(validation / (1 - test)) * rest)})
    train = _quotas(second, label, "_keep", F.col("_rest_total") - F.col("_val"), F.col("_rest_total"), "_train")
    return train.select(
        label,
        "n",
        (F.col("n") - F.col("_keep")).cast("bigint").alias("n_test"),
        (F.col("_keep") - F.col("_train")).cast("bigint").alias("n_val"),
    )


def _named_labels(df: DataFrame, label: str) -> DataFrame:
    """A missing label is a class of its own, under the name that a missing text has in tables read from CSV."""
    return df.fillna("nan", [label])


def stratified_split(
    df: DataFrame,
    label: str = "Category",
    key: str = "ID",
    seed: int = SEED,
    test: float = TEST_SHARE,
    validation: float = VALIDATION_SHARE,
) -> DataFrame:
    """``df`` with ``split`` (train, val, test), exact per-label quotas, rows drawn in md5 order of their key.

    A count per (label, leading hash digits) finds where each quota ends. Only the rows that share
    the digits of such an end are ranked, so a label with a third of all rows is never sorted in
    one task.
    """
    df = _named_labels(df, label)
    drawn = df.withColumn("_draw", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))).withColumn(
        "_slot", F.substring("_draw", 1, _DRAW_PREFIX)
    )
    # One pass over the rows; everything up to the borders comes from this small table.
    slots = cut_lineage(drawn.groupBy(label, "_slot").agg(F.count("*").alias("_in_slot")))
    quotas = split_quotas(slots.groupBy(label).agg(F.sum("_in_slot").alias("n")), label, test, validation)
    running = slots.withColumn("_upto", F.sum("_in_slot").over(W.partitionBy(label).orderBy("_slot")))
    ends = {"test": F.col("n_test"), "val": F.col("n_test") + F.col("n_val")}
    borders = running.join(quotas, label).groupBy(label).agg(
        *[
            F.min(F.when(F.col("_upto") > end, F.struct(F.col("_slot").alias("slot"), (F.col("_upto") - F.col("_in_slot")).alias("before")))).alias(f"_{name}")
            for name, end in ends.items()
        ],
        F.any_value(ends["test"]).alias("_end_test"),
        F.any_value(ends["val"]).alias("_end_val"),
    )
    placed = lookup_join(drawn, cut_lineage(borders), label, salt_on=[key])
    test_slot, val_slot = F.col("_test.slot"), F.col("_val.slot")
    on_border = F.coalesce((F.col("_slot") == test_slot) | (F.col("_slot") == val_slot), F.lit(False))
    side = (
        F.when(test_slot.isNull() | (F.col("_slot") < test_slot), "test")
        .when(val_slot.isNull() | (F.col("_slot") < val_slot), "val")
        .otherwise("train")
    )
    clear = placed.where(~on_border).withColumn("split", side)
    before = F.when(F.col("_slot") == test_slot, F.col("_test.before")).otherwise(F.col("_val.before"))
    place = before + F.row_number().over(W.partitionBy(label, "_slot").orderBy("_draw", key))
    ranked = placed.where(on_border).withColumn("_rank", place).withColumn(
        "split", F.when(F.col("_rank") <= F.col("_end_test"), "test").when(F.col("_rank") <= F.col("_end_val"), "val").otherwise("train")
    )
    return clear.select(*df.columns, "split").unionByName(ranked.select(*df.columns, "split"))


def ngrams(df: DataFrame, low: int = 1, high: int = 2, key: str = "ID", text: str = "clean_text") -> DataFrame:
    """(key, terms): word n-grams of every text, repeats kept."""
    return df.select(key, word_terms(text_or_empty(F.col(text)), low, high).alias("terms"))


def term_frequencies(df: DataFrame, low: int = 1, high: int = 2, key: str = "ID", text: str = "clean_text", nested: bool = False) -> DataFrame:
    """(key, term, tf), counted inside each row; ``nested`` leaves them there, as an array ``counts``."""
    counted = ngrams(df, low, high, key, text).select(key, term_counts(F.col("terms")).alias("counts"))
    return counted if nested else counted.select(key, F.inline("counts"))


def build_vocabulary(
    df: DataFrame,
    min_df: int = MIN_DF,
    max_features: int = MAX_FEATURES,
    low: int = 1,
    high: int = 2,
    key: str = "ID",
    text: str = "clean_text",
) -> DataFrame:
    """(term, df, tf) of the ``max_features`` most frequent terms found in ``min_df`` texts; ties by term.

    Some texts at a time are counted by the numbers of their words, so only the different terms of such a slice become rows.
    """
    words = df.select(plain_words(text_or_empty(F.col(text))).alias("words"))
    return (
        words.mapInArrow(_slice_counts(low, high), "term string, df bigint, tf bigint")
        .groupBy("term")
        .agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
        .where(F.col("df") >= min_df)
        .orderBy(F.desc("tf"), "term")
        .limit(max_features)
    )


def _slices(lists: pa.Array, most: int) -> Iterator[pa.Array]:
    """Lists of words, as many at a time as have ``most`` words, one at least."""
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(lists):
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
        yield lists.slice(start, stop - start)
        start = stop


def _row_of_each(lists: pa.Array) -> np.ndarray:
    return np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))


def _slice_counts(low: int, high: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of word lists to (term, df, tf), each term once per slice."""
    most = WORDS_AT_ONCE

    def count(lists: pa.Array) -> Iterator[pa.RecordBatch]:
        coded, row = lists.flatten().dictionary_encode(), _row_of_each(lists)
        code, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        gram = code
        for size in range(1, high + 1):
            if size > 1:  # a gram is the one that is a word shorter, with the next word
                shorter = gram if size == 2 else np.unique(gram, return_inverse=True)[1]
                gram = shorter[:-1] * len(names) + code[size - 1 :]
            if size < low:
                continue
            at = np.flatnonzero(row[: len(gram)] == row[size - 1 :])
            _, first, number, tf = np.unique(gram[at], return_index=True, return_inverse=True, return_counts=True)
            pairs = np.unique(number * len(lists) + row[at])
            df = np.bincount(pairs // len(lists), minlength=len(tf))
            parts = [names.take(pa.array(code[at[first] + i])) for i in range(size)]
            terms = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, " ")
            yield pa.RecordBatch.from_arrays([terms, pa.array(df, pa.int64()), pa.array(tf, pa.int64())], names=["term", "df", "tf"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lists in _slices(batch.column(0), most):
                yield from count(lists)

    return run


def with_idf(vocabulary: DataFrame, n_documents: int) -> DataFrame:
    return vocabulary.withColumn("idf", F.log((1 + F.lit(float(n_documents))) / (1 + F.col("df"))) + 1)


class _Grams:
    """A vocabulary by word numbers: a gram is found from the one that is a word shorter, without building its text."""

    def __init__(self, table: pa.Table, low: int, high: int):
        table = table.select(["term", "idf"]).combine_chunks().sort_by("term")  # weights are added up in the order of the terms
        names = table.column("term").to_pylist()
        split = [t.split(" ") for t in names]
        listed = sorted({w for words in split for w in words})
        number = {w: i for i, w in enumerate(listed)}
        self.terms, self.idf, self.words = names, table.column("idf").to_numpy(), listed
        self.levels = []
        known: dict[tuple[str, ...], int] = {(): 0}
        for size in range(1, high + 1):
            found: dict[int, tuple[tuple[str, ...], int]] = {}
            for i, words in enumerate(split):
                if len(words) >= size:
                    key = known[tuple(words[: size - 1])] * len(listed) + number[words[size - 1]]
                    whole = i if len(words) == size >= low else -1
                    if key not in found or found[key][1] < 0 <= whole:
                        found[key] = (tuple(words[:size]), whole)
            keys = sorted(found)
            known = {found[k][0]: at for at, k in enumerate(keys)}
            self.levels.append((np.array(keys, np.int64), np.array([found[k][1] for k in keys], np.int64)))

    def counts(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, tf) in this order, for the terms that the lists have."""
        coded, row = lists.flatten().dictionary_encode(), _row_of_each(lists)
        of = pc.fill_null(pc.index_in(coded.dictionary, value_set=pa.array(self.words, coded.dictionary.type)), -1).to_numpy(zero_copy_only=False)
        word = of[coded.indices.to_numpy(zero_copy_only=False)].astype(np.int64)
        at, gram, hits = np.arange(len(word)), np.zeros(len(word), np.int64), []
        for size, (keys, whole) in enumerate(self.levels, 1):
            end = at + size - 1
            inside = np.flatnonzero(end < len(word)) if size > 1 else np.arange(len(at))
            inside = inside[(row[at[inside]] == row[end[inside]]) & (word[end[inside]] >= 0)]
            at, key = at[inside], gram[inside] * len(self.words) + word[end[inside]]
            place = np.searchsorted(keys, key)
            same = np.flatnonzero(keys[np.minimum(place, len(keys) - 1)] == key) if len(keys) else np.zeros(0, np.int64)
            at, gram = at[same], place[same]
            term = whole[gram]
            hits.append(row[at[term >= 0]] * len(self.terms) + term[term >= 0])
        pairs, tf = np.unique(np.concatenate(hits), return_counts=True)
        return *np.divmod(pairs, max(1, len(self.terms))), tf


def _weigh_in_row(df: DataFrame, table: pa.Table, low: int, high: int) -> Callable[[Column], Column]:
    """The words of a text to array<(term, weight)> over the terms of ``table``."""
    shared = df.sparkSession.sparkContext.broadcast(_Grams(table, low, high))
    most = WORDS_AT_ONCE

    def some(lists: pa.Array, grams: _Grams, terms: pa.Array) -> pa.Array:
        row, term, tf = grams.counts(lists)
        raw = tf * grams.idf[term]
        length = np.sqrt(np.bincount(row, weights=raw * raw, minlength=len(lists)))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lists)))]).astype(np.int32)
        weighted = pa.StructArray.from_arrays([terms.take(pa.array(term)), pa.array(raw / length[row])], names=["term", "weight"])
        return pa.ListArray.from_arrays(pa.array(offsets), weighted)

    @F.arrow_udf("array<struct<term:string,weight:double>>")
    def weigh(words: pa.Array) -> pa.Array:
        grams = shared.value
        terms = pa.array(grams.terms, pa.string())
        parts = [some(lists, grams, terms) for lists in _slices(words, most)]
        return pa.concat_arrays(parts) if parts else some(words, grams, terms)

    return weigh


def tfidf(
    df: DataFrame,
    vocabulary: DataFrame,
    n_documents: int,
    low: int = 1,
    high: int = 2,
    key: str = "ID",
    text: str = "clean_text",
    max_inline_terms: int = MAX_INLINE_TERMS,
) -> DataFrame:
    """(key, term, weight): tf times smooth idf, scaled to unit length per text; long form.

    A vocabulary of checked size travels to the texts, and a text is weighted inside its row. A
    larger one is joined to the (text, term) pairs.
    """
    weights = with_idf(vocabulary, n_documents).select("term", "idf")
    head = weights.limit(max_inline_terms + 1).toArrow()
    if head.num_rows <= max_inline_terms:
        words = df.select(key, plain_words(text_or_empty(F.col(text))).alias("_words"))
        return words.select(key, F.inline(_weigh_in_row(df, head, low, high)(F.col("_words"))))
    weighted = lookup_join(term_frequencies(df, low, high, key, text), weights, "term", max_broadcast_rows=0).select(
        key, "term", (F.col("tf") * F.col("idf")).alias("raw")
    )
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(key)))
    return weighted.withColumn("weight", F.col("raw") / length).drop("raw")


class TfIdfModel:
    """The same weights as a vector column, row by row, for MLlib."""

    def __init__(self, terms: list[str], idf: list[float], low: int, high: int):
        self.terms, self.idf, self.low, self.high = terms, idf, low, high

    def transform(self, df: DataFrame, text: str = "clean_text", out: str = "tfidf") -> DataFrame:
        counted = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_terms", outputCol="_tf")
        scaled = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_raw")
        unit = Normalizer(p=2.0, inputCol="_raw", outputCol=out)
        terms = df.withColumn("_terms", word_terms(text_or_empty(F.col(text)), self.low, self.high))
        return unit.transform(scaled.transform(counted.transform(terms))).drop("_terms", "_tf", "_raw")


def fit_tfidf(
    train: DataFrame, min_df: int = MIN_DF, max_features: int = MAX_FEATURES, low: int = 1, high: int = 2, key: str = "ID", text: str = "clean_text"
) -> TfIdfModel:
    """Learn vocabulary and idf from the training rows; at most ``max_features`` terms come to the driver."""
    n = train.count()
    rows = build_vocabulary(train, min_df, max_features, low, high, key, text).select("term", "df").orderBy("term").collect()
    if not rows:
        raise ValueError("no term is frequent enough")
    return TfIdfModel([r["term"] for r in rows], [math.log((1 + n) / (1 + r["df"])) + 1 for r in rows], low, high)


def class_weights(df: DataFrame, label: str = "Category") -> DataFrame:
    """(label, n, weight): rows over classes times rows of the class."""
    df = _named_labels(df, label)
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    everything = W.partitionBy(F.lit(1))  # one row per label
    return counts.withColumn("weight", F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n")))


def with_class_weights(df: DataFrame, label: str = "Category", out: str = "weight") -> DataFrame:
    df = _named_labels(df, label)
    weights = cut_lineage(class_weights(df, label).select(label, F.col("weight").alias(out)))
    return lookup_join(df, weights, label)
