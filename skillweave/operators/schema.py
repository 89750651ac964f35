"""From whatever columns a source has to the fixed profile and job schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillweave.functions.text import text_or_empty
from skillweave.session import written

# Accepted column names, the first that exists wins, case ignored.
PROFILE_TEXT = ("Resume_str", "resume", "resume_text", "text")
PROFILE_ID = ("ID", "id")
PROFILE_CATEGORY = ("Category", "category", "label")
JOB_ID = ("JobID", "id")
JOB_TEXT = (("Title",), ("Skills",), ("Responsibilities", "Responsibility"), ("Keywords", "Keyword"))

_ROW_BITS = 33


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The column of ``df`` named by the first candidate that exists; looks at the schema only."""
    by_lower = {name.lower(): name for name in df.columns}
    return next((by_lower[c.lower()] for c in candidates if c.lower() in by_lower), None)


def with_surrogate_id(df: DataFrame, order_by: Sequence[str | Column], name: str = "ID") -> DataFrame:
    """Consecutive ids from 0 in the stated order.

    A range-partitioned sort, written once to the shared folder; a row's id is its place within
    its partition plus the rows of the partitions before. Only one number per partition is broadcast.
    """
    place = F.monotonically_increasing_id()
    ordered = written(df.orderBy(*order_by).withColumn("_place", place), "ordered")
    part = F.shiftright("_place", _ROW_BITS)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_before") + row).cast("bigint"))
        .drop("_part", "_place", "_before")
    )


def take_first(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in the stated order."""
    return df.orderBy(*order_by).limit(n)


def concat_text(df: DataFrame, candidate_groups: Sequence[Sequence[str]] = JOB_TEXT) -> Column:
    """The columns that exist, joined by one space; a null is empty but keeps its separator."""
    present = [c for c in (resolve_column(df, group) for group in candidate_groups) if c is not None]
    if not present:
        raise ValueError("none of the expected text columns is present")
    return F.concat_ws(" ", *[text_or_empty(F.col(c)) for c in present])


def _with_key(df: DataFrame, candidates: Sequence[str], name: str, order_by: Sequence[str | Column] | None) -> tuple[DataFrame, Column]:
    found = resolve_column(df, candidates)
    if found is not None:
        return df, F.col(found).cast("string")
    if not order_by:
        raise ValueError(f"no {name} column: state an order to number the rows")
    return with_surrogate_id(df, order_by, "_surrogate"), F.col("_surrogate").cast("string")


def standardise_profiles(df: DataFrame, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """ID, Category, raw_text. Without a category column the category is ``unknown``."""
    text = resolve_column(df, PROFILE_TEXT)
    if text is None:
        raise ValueError("no profile text column")
    category = resolve_column(df, PROFILE_CATEGORY)
    df, key = _with_key(df, PROFILE_ID, "profile id", order_by)
    return df.select(
        key.alias("ID"),
        (F.col(category).cast("string") if category else F.lit("unknown")).alias("Category"),
        text_or_empty(F.col(text)).alias("raw_text"),
    )


def standardise_jobs(df: DataFrame, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """JobID, raw_text."""
    text = concat_text(df)
    df, key = _with_key(df, JOB_ID, "job id", order_by)
    return df.select(key.alias("JobID"), text.alias("raw_text"))


def alignment(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Matched rows and rows found on one side only, as one row."""
    sides = left.select(key, F.lit(1).alias("_l")).join(right.select(key, F.lit(1).alias("_r")), key, "full_outer")
    return sides.agg(
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("matched"),
        F.count_if(F.col("_r").isNull()).alias("left_only"),
        F.count_if(F.col("_l").isNull()).alias("right_only"),
    )


def check_aligned(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` again, or an error when a key is missing on either side."""
    found = alignment(left, right, key).first()
    if found["left_only"] or found["right_only"]:
        raise ValueError(f"row mismatch on {key}: {found['left_only']} only left, {found['right_only']} only right")
    return left


def attach_embeddings(profiles: DataFrame, embeddings: DataFrame, key: str = "ID") -> DataFrame:
    """Profiles with their vectors, joined by key."""
    return profiles.join(embeddings, key, "inner")
