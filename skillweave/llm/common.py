"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, **inner: Column | str) -> DataFrame:
    """``row`` with all columns of ``df``, beside the columns an operator works on.

    As the given columns are nested, none of their names can clash with a name the operator uses.
    """
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in inner.items()], F.struct("*").alias("row"))


def salted(by: Column | str) -> Column:
    """A number below ``SALTS`` that a repeated task computes again."""
    return F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")


def join_groups(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """``rows`` (with ``salt``) joined to the one row ``groups`` has for each ``key``.

    A group is copied only to the salts that its rows use, so the rows of a key that holds a third of
    the table are spread over several tasks, and rare keys are not copied.
    """
    used = rows.select(key, "salt").distinct().join(groups, key)
    return rows.join(used, [key, "salt"])


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object]], schema: str | StructType) -> DataFrame:
    """``fn`` over Arrow batches; it returns the output columns as arrays or lists."""
    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    names, types = kind.names, to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays([_array(out[n], types.field(n).type) for n in names], schema=types)

    return df.mapInArrow(run, kind)


def _array(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values.cast(kind) if values.type != kind else values
    if isinstance(values, np.ndarray) and values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.array(values, type=kind)


class WordHashes(dict):
    """XXH64 of words as they come; forgets all once it holds ``bound`` words."""

    def __init__(self, bound: int = 500_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.bound:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
