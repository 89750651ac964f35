"""Registered queries: a name, the Spark query over the given tables, and its SQL twin if there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.sources.readers import balanced

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str, key: str, **columns: str) -> DataFrame:
    """The renamed columns of a table with heavy text, spread over all cores."""
    chosen = table(spark, sf_dir, name).select(*[F.col(old).alias(new) for new, old in columns.items()])
    return balanced(chosen, key)


def r6(col: Column | str) -> Column:
    return F.round(col, 6)


def joined(col: Column | str, sep: str = "|") -> Column:
    """An array as text, so that both engines hand over the same kind of value."""
    return F.array_join(F.col(col).cast("array<string>") if isinstance(col, str) else col.cast("array<string>"), sep)
