"""Vectors for texts, and fewer dimensions for vectors."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillweave.functions.text import gram_terms, text_or_empty
from skillweave.functions.vectors import from_matrix, unit_rows

EMBEDDING_DIM = 384
ROWS_AT_ONCE = 512


def fast_hash(term: Column) -> Column:
    return F.xxhash64(term).bitwiseAND(F.lit((1 << 62) - 1))


def portable_hash(term: Column) -> Column:
    """The first 32 bits of the md5, which any SQL engine can compute too."""
    return F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint")


@F.arrow_udf(T.ArrayType(T.LongType()))
def _portable_hashes(terms: pa.Array) -> pa.Array:
    """``portable_hash`` of every term, worked out once for equal terms of some rows."""

    def some(part: pa.Array) -> pa.Array:
        coded = part.flatten().dictionary_encode()
        digests = b"".join([hashlib.md5(t.encode(), usedforsecurity=False).digest()[:4] for t in coded.dictionary.to_pylist()])
        hashes = np.frombuffer(digests, ">u4").astype(np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        offsets = np.concatenate([[0], np.cumsum(part.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes))

    parts = [some(terms.slice(start, ROWS_AT_ONCE)) for start in range(0, len(terms), ROWS_AT_ONCE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))


def hashed_terms(text: Column, grams: int = 1, term_hash: Callable[[Column], Column] = fast_hash) -> Column:
    words = F.filter(F.split(text_or_empty(text), " "), lambda w: w != "")
    if term_hash is portable_hash and grams == 1:  # Spark leaves a Python function over nested lambdas in place and cannot evaluate it
        return _portable_hashes(words)
    return F.transform(gram_terms(words, 1, grams), term_hash)


def inverse_frequencies(
    df: DataFrame,
    text: str = "clean_text",
    dim: int = EMBEDDING_DIM,
    grams: int = 1,
    term_hash: Callable[[Column], Column] = fast_hash,
) -> list[float]:
    """One weight per bucket, ln((1+n)/(1+df))+1, from one pre-aggregated pass over the texts.

    At most ``dim`` + 1 counts come to the driver.
    """

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def buckets(hashes: pa.Array) -> pa.Array:
        row = np.repeat(np.arange(len(hashes)), hashes.value_lengths().to_numpy(zero_copy_only=False))
        row, found = np.divmod(np.unique(row * dim + hashes.flatten().to_numpy(zero_copy_only=False) % dim), dim)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(hashes)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found))

    hashed = df.select(hashed_terms(F.col(text), grams, term_hash).alias("_hashes"))
    if grams > 1:
        found = F.array_distinct(F.transform("_hashes", lambda h: F.pmod(h, F.lit(dim))))
    else:
        found = buckets(F.col("_hashes"))
    seen = F.concat(found, F.array(F.lit(-1).cast("bigint")))
    counts = {row[0]: row[1] for row in hashed.select(F.explode(seen).alias("bucket")).groupBy("bucket").count().collect()}
    n = counts.get(-1, 0)
    return [math.log((1 + n) / (1 + counts.get(b, 0))) + 1.0 for b in range(dim)]


def embed_text(
    df: DataFrame,
    dim: int = EMBEDDING_DIM,
    encoder: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None,
    text: str = "clean_text",
    key: str = "ID",
    weights: list[float] | None = None,
    grams: int = 1,
    term_hash: Callable[[Column], Column] = fast_hash,
) -> DataFrame:
    """``df`` without its text, with ``embedding``: signed hashed TF-IDF of unit length.

    Row-local once the weights are known; pass the weights of the profiles to embed jobs in the same
    space. A text without words gives the zero vector. A caller's ``encoder`` maps batches with
    (key, text) to batches with (key, embedding) instead.
    """
    if encoder is not None:
        kind = df.schema[key].dataType.simpleString()
        return df.select(key, text).mapInPandas(encoder, f"`{key}` {kind}, embedding array<double>")
    if weights is None:
        weights = inverse_frequencies(df, text, dim, grams, term_hash)
    idf = np.asarray(weights)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def accumulate(hashes: pa.Array) -> pa.Array:
        # Some rows at a time: the table of all sums is as wide as the vectors and in double.
        parts = [some(hashes.slice(start, ROWS_AT_ONCE)) for start in range(0, len(hashes), ROWS_AT_ONCE)]
        return pa.concat_arrays(parts) if parts else from_matrix(np.zeros((0, dim)))

    def some(hashes: pa.Array) -> pa.Array:
        values = hashes.flatten().to_numpy(zero_copy_only=False)
        lengths = hashes.value_lengths().to_numpy(zero_copy_only=False)
        cell = np.repeat(np.arange(len(hashes)), lengths) * dim + values % dim
        sign = 1.0 - 2.0 * (values // dim % 2)
        counts = np.bincount(cell, weights=sign, minlength=len(hashes) * dim).reshape(len(hashes), dim)
        return from_matrix(unit_rows(counts * idf))

    # Non-deterministic to the optimiser only: it must not compute the vectors once more for a filter.
    accumulate = accumulate.asNondeterministic()
    return df.withColumn("embedding", accumulate(hashed_terms(F.col(text), grams, term_hash))).drop(text)


def pca_reduce(df: DataFrame, k: int, vector: str = "embedding") -> tuple[DataFrame, float]:
    """``df`` with its vectors on their first principal components, and the variance share they keep."""
    shape = df.agg(F.count("*").alias("n"), F.max(F.size(vector)).alias("d")).first()
    k = min(k, shape["n"], shape["d"])
    # Spark's PCA does not centre what it transforms, so the mean goes first.
    raw = df.withColumn("_raw", array_to_vector(F.col(vector).cast("array<double>")))
    centred = StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False).fit(raw).transform(raw)
    model = PCA(k=k, inputCol="_centred", outputCol="_reduced").fit(centred)
    reduced = model.transform(centred).withColumn(vector, vector_to_array("_reduced"))
    return reduced.drop("_raw", "_centred", "_reduced"), float(sum(model.explainedVariance))
