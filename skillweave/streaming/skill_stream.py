"""Skill extraction as a stream that picks up where it stopped.

The cache is a log: every micro-batch appends the results of its pending profiles under its own
number, and reading takes the newest result per profile. Nothing already cached is rewritten, and
a batch that runs again after a failure replaces its own folder, so it counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skillweave.operators.incremental import pending
from skillweave.operators.skills import fallback_skills
from skillweave.sources.readers import path_exists

CACHE_SCHEMA = "ID string, technical array<string>, soft array<string>"


class SkillCache:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _log(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], CACHE_SCHEMA + ", batch bigint")
        return self.spark.read.schema(CACHE_SCHEMA + ", batch bigint").parquet(self.path)

    def read(self, before: int | None = None, ids: DataFrame | None = None) -> DataFrame:
        """Newest lists per profile, optionally as they were before a batch and only of some profiles."""
        log = self._log() if before is None else self._log().where(F.col("batch") < before)
        if ids is not None:
            log = log.join(ids.select("ID").distinct(), "ID", "left_semi")
        newest = log.groupBy("ID").agg(F.max_by(F.struct("technical", "soft"), "batch").alias("_s"))
        return newest.select("ID", "_s.technical", "_s.soft")

    def append(self, skills: DataFrame, batch: int) -> None:
        skills.select("ID", "technical", "soft").write.mode("overwrite").parquet(f"{self.path}/batch={batch}")


def run_incremental(
    stream: DataFrame,
    cache_dir: str,
    checkpoint_dir: str,
    extract: Callable[[DataFrame], DataFrame] = fallback_skills,
    refill_empty: bool = False,
) -> StreamingQuery:
    """Extract skills for the profiles (ID, clean_text) that arrived since the last run, then stop."""
    cache = SkillCache(stream.sparkSession, cache_dir)

    def step(batch: DataFrame, number: int) -> None:
        # Only the arriving profiles' entries are grouped, however long the log has become.
        todo = pending(batch, cache.read(before=number, ids=batch), refill_empty)
        cache.append(extract(todo), number)

    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
