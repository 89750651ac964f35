"""k-means for every k and restart at once: one pass over the points per Lloyd step, for all models.

Each (k, seed) model starts from the k points of smallest hash of (key, seed), so the start does not depend on the partitioning.
A step sends all centres to the tasks (their number is the sum of k over the models, times the width: bounded by the settings,
not by the data); each task finds every point's nearest centre under every model and adds up counts, sums and squared
distances per (model, centre); Spark adds the tasks' parts, per dimension, and the driver takes the new centres (a row per
centre and dimension). A centre without points stays where it was. Steps stop when no centre of any model moves by more than
``tol``, or after ``max_iter`` steps; a last pass gives the inertia of the final centres.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillweave.functions.vectors import to_matrix
from skillweave.operators.ranking import top_within
from skillweave.session import written

MAX_ITER = 20
TOL = 1e-4
PARTS = "model int, centre int, dim int, value double"


def _starts(points: DataFrame, key: str, vector: str, ks: list[int], seeds: list[int]) -> dict[int, np.ndarray]:
    """Per seed, the ``max(ks)`` points of smallest hash of (key, seed), in that order."""
    tagged = points.select(key, vector, F.explode(F.array(*[F.lit(s) for s in seeds])).alias("seed"))
    tagged = tagged.withColumn("h", F.xxhash64(F.col(key), F.col("seed")))
    first = top_within(tagged, ["seed"], [F.asc("h"), F.asc(key)], max(ks), "pos").toPandas()  # seeds x max(ks) rows
    return {s: np.stack([np.asarray(v, np.float64) for v in g.sort_values("pos")[vector]]) for s, g in first.groupby("seed")}


def _step(points: DataFrame, vector: str, models: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Sums, counts per centre and inertia of every model, in one pass."""
    shared = points.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        width = centres[0].shape[1]
        sums = [np.zeros((len(c), width + 2)) for c in centres]  # sum per dimension, count, squared distance
        for batch in batches:
            x = to_matrix(batch.column(0))
            if not len(x):
                continue
            norms = np.square(x).sum(axis=1)
            for m, c in enumerate(centres):
                gap = norms[:, None] - 2 * x @ c.T + np.square(c).sum(axis=1)[None, :]
                near = np.argmin(gap, axis=1)
                np.add.at(sums[m], near, np.hstack([x, np.ones((len(x), 1)), np.maximum(gap[np.arange(len(x)), near], 0)[:, None]]))
        model, centre, dim, value = [], [], [], []
        for m, s in enumerate(sums):
            rows, cols = np.nonzero(s)
            model.append(np.full(len(rows), m, np.int32))
            centre.append(rows.astype(np.int32))
            dim.append(cols.astype(np.int32))
            value.append(s[rows, cols])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)) for a in (model, centre, dim, value)], names=["model", "centre", "dim", "value"])

    parts = points.select(vector).mapInArrow(run, PARTS).groupBy("model", "centre", "dim").agg(F.sum("value").alias("value")).toPandas()
    width = models[0].shape[1]
    sums = [np.zeros((len(c), width + 2)) for c in models]
    for m, c, d, v in parts.itertuples(index=False):
        sums[m][c, d] = v
    return [s[:, :width] for s in sums], [s[:, width] for s in sums], np.array([s[:, width + 1].sum() for s in sums])


def kmeans_all(df: DataFrame, ks: list[int], seeds: list[int], vector: str = "embedding", key: str = "ID", max_iter: int = MAX_ITER, tol: float = TOL) -> DataFrame:
    """``k, seed, inertia, iterations, best, centres`` of every (k, seed) model; ``best`` marks the lowest inertia of each k (lower seed on ties).

    Rows without a vector take no part; repeated rows count as often as they occur. A table with fewer points than k gives no
    rows for that k. Other columns are ignored.
    """
    spark = df.sparkSession
    points = written(df.select(key, F.col(vector).cast("array<double>").alias(vector)).where(F.col(vector).isNotNull()), "kmeans_points")
    count = points.count()
    runs = [(k, s) for k in ks for s in seeds if k <= count]
    if not runs:
        return spark.createDataFrame([], "k int, seed int, inertia double, iterations int, best boolean, centres array<array<double>>")
    starts = _starts(points, key, vector, [k for k, _ in runs], sorted({s for _, s in runs}))
    models = [starts[s][:k].copy() for k, s in runs]
    moving = np.ones(len(runs), bool)
    steps = np.zeros(len(runs), np.int32)
    values = points.select(vector)
    for _ in range(max_iter):
        sums, counts, _ = _step(values, vector, models)
        for m in np.flatnonzero(moving):
            fresh = np.where(counts[m][:, None] > 0, sums[m] / np.maximum(counts[m], 1)[:, None], models[m])
            moving[m] = np.sqrt(np.square(fresh - models[m]).sum(axis=1)).max() > tol
            models[m] = fresh
            steps[m] += 1
        if not moving.any():
            break
    _, _, inertia = _step(values, vector, models)
    rows = [(k, s, float(inertia[m]), int(steps[m]), [c.tolist() for c in models[m]]) for m, (k, s) in enumerate(runs)]
    best = {}
    for k, s, i, _, _ in rows:
        if k not in best or (i, s) < best[k]:
            best[k] = (i, s)
    return spark.createDataFrame([(k, s, i, n, best[k][1] == s, c) for k, s, i, n, c in rows],
                                 "k int, seed int, inertia double, iterations int, best boolean, centres array<array<double>>")
