"""All k-means models in shared passes: equal to plain Lloyd steps from the same starts, on any partitioning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from skillweave.operators import kmeans_pass as K


def plain(points, start, steps, tol=K.TOL):
    c = start.copy()
    for n in range(1, steps + 1):
        near = np.argmin(((points[:, None, :] - c[None]) ** 2).sum(axis=2), axis=1)
        fresh = np.array([points[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        moved = np.sqrt(((fresh - c) ** 2).sum(axis=1)).max()
        c = fresh
        if moved <= tol:
            return c, n
    return c, steps


def test_models_equal_plain_lloyd_on_any_partitioning(spark):
    rng = np.random.default_rng(0)
    pts = np.vstack([rng.normal(loc=m, scale=0.3, size=(60, 4)) for m in (0, 3, 6)]).round(3)
    rows = [(i, pts[i].tolist()) for i in range(len(pts))] + [(999, None)]
    frame = spark.createDataFrame(rows, "ID long, embedding array<double>")
    results = []
    for parts in (1, 5):
        got = K.kmeans_all(frame.repartition(parts), [2, 3, 4], [1, 2], max_iter=30).collect()
        results.append(sorted((r.k, r.seed, round(r.inertia, 6), r.iterations) for r in got))
        for r in got:
            starts = frame.where("embedding is not null").select("ID", "embedding", F.xxhash64("ID", F.lit(r.seed)).alias("h")).orderBy("h", "ID").limit(r.k).collect()
            want, steps = plain(pts, np.array([s.embedding for s in starts]), 30)
            assert np.allclose(np.array(r.centres), want, atol=1e-9) and r.iterations == steps
            near = ((pts[:, None, :] - want[None]) ** 2).sum(axis=2).min(axis=1).sum()
            assert abs(r.inertia - near) < 1e-6
        assert sum(r.best for r in got) == 3
    assert results[0] == results[1]


def test_fewer_points_than_k(spark):
    frame = spark.createDataFrame([(1, [0.0, 1.0])], "ID long, embedding array<double>")
    assert K.kmeans_all(frame, [1, 2], [7]).select("k").collect() == [(1,)]
