"""Result tables and summary documents.

A table is a folder of versions. A writer adds ``version=<n>``; readers take the newest version
that was finished, so a result is replaced in one step, a failed write is never seen, and a job may
read the table it is about to replace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.session import written

_DONE = "_SUCCESS"


def _versions(spark: SparkSession, path: str, finished: bool) -> list[int]:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("version=") and (not finished or fs.exists(hadoop.Path(status.getPath(), _DONE))):
            found.append(int(name.split("=")[1]))
    return sorted(found)


def _flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for sinks with plain cells."""
    nested = ("array", "map", "struct")
    return df.select(*[F.to_json(c).alias(c) if t.startswith(nested) else F.col(c) for c, t in df.dtypes])


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a new version as ``parquet``, ``csv`` or ``json`` and return its folder."""
    spark = df.sparkSession
    number = max(_versions(spark, path, finished=False), default=-1) + 1
    target = f"{path.rstrip('/')}/version={number}"
    writer = (_flat(df) if fmt == "csv" else df).write.mode("errorifexists")
    if fmt == "csv":
        writer.option("header", True).option("quote", '"').option("escape", '"').csv(target)
    elif fmt in ("parquet", "json"):
        writer.format(fmt).save(target)
    else:
        raise ValueError(f"unknown format {fmt}")
    return target


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest finished version."""
    done = _versions(spark, path, finished=True)
    if not done:
        raise FileNotFoundError(path)
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    return reader.format(fmt).load(f"{path.rstrip('/')}/version={done[-1]}")


def write_summary(summary: DataFrame, path: str, variant: str | None = None) -> None:
    """A summary document, a few rows in one JSON file, under its variant and as the latest one; computed once."""
    summary = written(summary, "summary").coalesce(1)
    if variant:
        write_table(summary, f"{path.rstrip('/')}/variant={variant}", "json")
    write_table(summary, f"{path.rstrip('/')}/latest", "json")
