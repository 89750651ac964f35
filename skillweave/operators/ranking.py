"""Ranks inside groups, with every tie settled by a stated column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rank_within(df: DataFrame, by: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def top_within(df: DataFrame, by: list[str], order: list[Column], n: int, name: str = "rank") -> DataFrame:
    """First ``n`` rows of every group; Spark cuts each partition to ``n`` before it shuffles."""
    return rank_within(df, by, order, name).where(F.col(name) <= n)
