"""Profiles, jobs, vectors and skill maps from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillweave.sources.writers import read_table, write_table

SKILL_ENTRY = "map<string,struct<technical:array<string>,soft:array<string>>>"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV with long quoted, multi-line text; all columns as strings.

    Quoted line breaks make one file one task, so land big sources as Parquet once
    (:func:`land`) and work from there.
    """
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
    header = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return spark.read.options(**options).schema(schema).csv(path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    lowered = path.lower().rstrip("/")
    if lowered.endswith((".csv", ".csv.gz")):
        return read_text_csv(spark, path)
    return spark.read.json(path) if lowered.endswith((".json", ".jsonl")) else spark.read.parquet(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Raw profile table; CSV, JSON lines or Parquet by name."""
    return _read(spark, path)


def read_jobs(spark: SparkSession, path: str) -> DataFrame | None:
    """Raw job table, or None when there is none: the job source is optional."""
    return _read(spark, path) if path_exists(spark, path) else None


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` on all cores when its source yields fewer partitions than there are cores, by hash of ``keys``.

    For heavy per-row work on a few big files. A source with enough partitions is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def land(df: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """Write once as a new version of a Parquet table and go on from the splittable copy."""
    write_table(df if partitions is None else df.repartition(partitions), path)
    return read_table(df.sparkSession, path)


def read_embeddings(spark: SparkSession, path: str, key: str = "ID", vector: str = "embedding") -> DataFrame:
    """(key, vector) from a versioned table or plain Parquet; only these two columns are read."""
    try:
        table = read_table(spark, path)
    except FileNotFoundError:
        table = spark.read.parquet(path)
    return table.select(key, vector)


def write_embeddings(df: DataFrame, path: str, key: str = "ID", vector: str = "embedding") -> None:
    """A new version of the table: ``df`` may be read from the one it replaces."""
    write_table(df.select(key, F.col(vector).cast("array<float>").alias(vector)), path)


def read_skill_map(spark: SparkSession, path: str) -> DataFrame:
    """(ID, technical, soft) from one JSON object per file, id to lists; a missing file gives no rows."""
    empty = F.array().cast("array<string>")
    schema = "ID string, technical array<string>, soft array<string>"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path).select("ID", "technical", "soft")
    entries = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", SKILL_ENTRY)).alias("ID", "entry"))
    return entries.select(
        "ID", F.coalesce("entry.technical", empty).alias("technical"), F.coalesce("entry.soft", empty).alias("soft")
    )
