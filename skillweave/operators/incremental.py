"""Which profiles still need skills, and the cache that remembers those that have them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillweave.operators.skills import is_empty_skills


def _with_state(df: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    known = cache.groupBy(key).agg(F.lit(True).alias("_cached"), F.bool_and(is_empty_skills()).alias("_empty"))
    return df.join(known, key, "left").withColumns(
        {"_cached": F.coalesce("_cached", F.lit(False)), "_empty": F.coalesce("_empty", F.lit(False))}
    )


def pending(df: DataFrame, cache: DataFrame, refill_empty: bool = False, key: str = "ID") -> DataFrame:
    """Rows not in the cache, and with ``refill_empty`` also those cached with two empty lists."""
    todo = ~F.col("_cached")
    if refill_empty:
        todo = todo | F.col("_empty")
    return _with_state(df, cache, key).where(todo).drop("_cached", "_empty")


def merge_cache(cache: DataFrame, new: DataFrame, key: str = "ID") -> DataFrame:
    """New results replace old ones; cached rows that are not in the batch stay."""
    return cache.join(new.select(key), key, "left_anti").unionByName(new.select(*cache.columns))


def cache_status(df: DataFrame, cache: DataFrame, key: str = "ID") -> DataFrame:
    return _with_state(df, cache, key).agg(
        F.count("*").alias("total"),
        F.count_if("_cached").alias("cached"),
        F.count_if(F.col("_cached") & F.col("_empty")).alias("cached_empty"),
        F.count_if(~F.col("_cached")).alias("left_to_run"),
    )
