"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
HOT_KEYS = 100
SALTS = 32
ROWS_PER_TRAINING_TASK = 20_000
FEW_TRAINING_TASKS = 8


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and, written as text, ``max_bytes`` bytes; no task sends more rows than that."""
    head = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("size")).limit(max_rows + 1)
    found = head.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    return found["n"] <= max_rows and found["bytes"] <= max_bytes


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    salt_on: list[str] | None = None,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``facts`` joined to ``dim`` on ``key`` (``inner`` or ``left``).

    A dimension of checked size is broadcast, so the facts do not move. A larger one is joined by
    shuffle, with the keys that hold most fact rows spread over several salts: only the few
    dimension rows of those keys are copied. Salts come from the fact row itself, so a task that
    runs twice sends every row to the same place.
    """
    if fits(dim, max_broadcast_rows):
        return facts.join(F.broadcast(dim), key, how)
    hot = [
        row[0]
        for row in facts.where(F.col(key).isNotNull())
        .groupBy(key)
        .count()
        .orderBy(F.desc("count"), key)
        .limit(HOT_KEYS)
        .collect()
    ]
    is_hot = F.col(key).isin(hot)
    seed = salt_on or [c for c, t in facts.dtypes if not t.startswith("map")]
    salted_facts = facts.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*seed), F.lit(SALTS)).cast("int")).otherwise(0))
    copies: Column = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted_dim = dim.withColumn("_salt", F.explode(copies))
    return salted_facts.join(salted_dim, [key, "_salt"], how).drop("_salt")


def for_iterations(df: DataFrame, rows: int | None = None, least_rows: int = ROWS_PER_TRAINING_TASK) -> DataFrame:
    """``df`` on as many partitions as its rows need, for algorithms that run one job per step.

    The number follows the rows alone, and a row's partition and place the hash of its values, so a seeded algorithm meets
    the same layout on every cluster. A table of few tasks has up to ``FEW_TRAINING_TASKS`` of ``least_rows`` instead.
    """
    rows = df.count() if rows is None else rows
    few = min(FEW_TRAINING_TASKS, math.ceil(rows / least_rows))
    needed = max(1, few, math.ceil(rows / ROWS_PER_TRAINING_TASK))
    place = F.xxhash64(*df.columns)
    return df.repartition(needed, place).sortWithinPartitions(place)


def one_row(parts: list[DataFrame]) -> DataFrame:
    """One-row frames with different columns side by side in one row, without a join."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.agg(*[F.first(c, ignorenulls=True).alias(c) for c in merged.columns])
