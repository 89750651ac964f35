"""Exact deduplication against a persistent index of digests (operator 3, DataFrame functions only).

The index is a Parquet table bucketed and sorted by digest. A batch is first reduced to one row per
digest, a sort-merge anti-join finds the digests that the index lacks, and these are appended. The
index side of the join needs neither shuffle nor sort as long as a bucket is one file; later batches
add files, and then Spark sorts inside buckets, still without a shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm.common import join_groups, packed, salted
from skillweave.session import shared_root, written

# One match for every run of white space that is not already a single space.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def text_digest(text: Column | str) -> Column:
    """SHA-256 (binary) of the text with each run of white space replaced by one space; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), _RUNS, " "), 256))


class DigestIndex:
    """``digest``, ``keep_id`` for every text seen so far, at ``path``; a later session opens it again."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64):
        self.spark = spark
        self.buckets = buckets
        self.path = path or f"{shared_root(spark).rstrip('/')}/digests-{uuid.uuid4().hex}"
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, groups: DataFrame) -> None:
        """Append the digests of ``groups`` (``digest``, ``keep_id``, unique by digest) that are new."""
        new = groups.select("digest", "keep_id").join(self.table().hint("merge"), "digest", "left_anti")
        new.repartition(self.buckets, "digest").write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").mode("append").option("path", self.path).saveAsTable(self.name)


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``doc_id, keep_id, group_size, kept, text_sha256``.

    Equal texts (white space runs count as one space) form a group; the least id stays, unless the
    index knew the text before: then its id is ``keep_id`` and no row stays. ``group_size`` counts
    rows of this batch. Null text equals empty text; a null id goes last; of repeated rows with the
    least id one stays. An empty table gives an empty result; other columns are ignored.
    """
    index = index or DigestIndex(docs.sparkSession)
    rows = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(text_col).alias("digest"), F.monotonically_increasing_id().alias("row_id")), "digests")
    rows = rows.withColumn("salt", salted("row_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")).alias("first")
    groups = written(rows.groupBy("digest").agg(first, F.count("*").alias("group_size")), "digest-groups")
    known = index.table().select("digest", F.col("keep_id").alias("old_id"))
    before = groups.join(known.hint("merge"), "digest", "left_semi").select("digest", F.lit(True).alias("old"))
    before = written(before, "known-digests")
    index.add(groups.select("digest", F.col("first.doc_id").alias("keep_id")))
    kept = groups.join(index.table().hint("merge"), "digest").join(before, "digest", "left")
    kept = kept.select("digest", "keep_id", "group_size", F.when(F.col("old").isNull(), F.col("first.row_id")).alias("kept_row"))
    return join_groups(rows, kept, "digest").select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("row_id") == F.col("kept_row"), F.lit(False)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with their columns.

    Texts meet the verdicts by (id, digest), which no large group shares; of rows that repeat both,
    the one that was counted as kept stays.
    """
    kept = exact_dedup(docs, index).where("kept").select("doc_id", F.unhex("text_sha256").alias("digest"))
    rows = packed(docs, doc_id=F.col("doc_id").cast("long"), digest=text_digest("text"))
    met = rows.join(kept, rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["digest"] == kept["digest"]), "left_semi")
    from pyspark.sql import Window

    one = F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy(F.lit(1)))
    return met.withColumn("nth", one).where("nth = 1").select("row.*")
