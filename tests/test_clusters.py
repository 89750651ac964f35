from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from skillweave.operators import cluster_quality as quality
from skillweave.operators import clustering
from skillweave.operators.embedding import embed_text, inverse_frequencies, pca_reduce

# Recorded silhouettes by k and sizes of the chosen clustering.
RECORDED = {
    8: 0.11953605711460114, 9: 0.12443450838327408, 10: 0.13113050162792206, 11: 0.12640482187271118, 12: 0.1269018054008484,
    13: 0.12665657699108124, 14: 0.12797173857688904, 15: 0.12578722834587097, 16: 0.12397962808609009,
}
SIZES = [354, 257, 376, 159, 380, 318, 175, 112, 276, 77]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(1)
    data = [(i, i % 3, [i % 3 * 4 + rng.gauss(0, 1), rng.gauss(0, 1), (i % 3 == 1) * 5.0 + rng.gauss(0, 0.5)]) for i in range(90)]
    data.append((90, 7, [20.0, 20.0, 20.0]))
    return spark.createDataFrame(data, "ID int, label int, embedding array<double>"), data


def test_quality_equals_the_definitions(blobs):
    df, data = blobs
    x, y = np.array([d[2] for d in data]), np.array([d[1] for d in data])
    labels = sorted(set(y))
    centre = {c: x[y == c].mean(axis=0) for c in labels}
    within = sum(((x[y == c] - centre[c]) ** 2).sum() for c in labels)
    between = sum((y == c).sum() * ((centre[c] - x.mean(axis=0)) ** 2).sum() for c in labels)
    n, k = len(x), len(labels)
    got = quality.dispersion(df, "label").first()
    assert got["inertia"] == pytest.approx(within) and quality.inertia(df, "label").first()[0] == pytest.approx(within)
    assert got["calinski_harabasz"] == pytest.approx(between / within * (n - k) / (k - 1))
    spread = {c: np.linalg.norm(x[y == c] - centre[c], axis=1).mean() for c in labels}
    worst = [max((spread[a] + spread[b]) / np.linalg.norm(centre[a] - centre[b]) for b in labels if b != a) for a in labels]
    assert quality.davies_bouldin(df, "label").first()[0] == pytest.approx(np.mean(worst))
    scores = {}
    for i in range(n):
        d = np.linalg.norm(x - x[i], axis=1)
        a = d[y == y[i]].sum() / max((y == y[i]).sum() - 1, 1)
        b = min(d[y == c].mean() for c in labels if c != y[i])
        scores[str(data[i][0])] = (b - a) / max(a, b) if (y == y[i]).sum() > 1 else 0.0
    points = {r["key"]: r["silhouette"] for r in quality.silhouette_points(df, "label").collect()}
    assert points == {k: pytest.approx(v, abs=1e-9) for k, v in scores.items()}
    assert points["90"] == 0.0
    assert quality.silhouette(df, "label").first()[0] == pytest.approx(np.mean(list(scores.values())))


def test_silhouette_sample_is_bounded(blobs):
    assert quality.silhouette_points(blobs[0], "label", sample=20).count() == 20


def test_sweep_scores_all_points(spark):
    """More points than the sample of ``silhouette_points``: the score is the mean over every one, keys repeated or missing."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(2300, 3)) + 2.0 * draw.integers(0, 3, (2300, 1))
    x[:40] = x[40]
    data = [(None if i % 50 == 0 else i // 2, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(data, "ID int, embedding array<double>")
    scores, models = clustering.kmeans_sweep(df, 2, 3, n_init=1)
    got = {r["k"]: r["silhouette"] for r in scores.collect()}
    for k, model in models.items():
        y = np.argmin(np.linalg.norm(x[:, None] - np.array(model.clusterCenters()), axis=2), axis=1)
        assert got[k] == pytest.approx(_mean_silhouette(x, y), abs=1e-9)


def _mean_silhouette(x, y):
    distance = np.linalg.norm(x[:, None] - x[None], axis=2)
    size = np.bincount(y)
    mean = np.stack([distance[:, y == c].sum(axis=1) for c in range(len(size))], axis=1)
    at, alone = np.arange(len(y)), size[y] == 1
    a = mean[at, y] / np.maximum(size[y] - 1, 1)
    mean = mean / size
    mean[at, y] = np.inf
    b = mean.min(axis=1)
    return np.where(alone, 0.0, (b - a) / np.maximum(a, b)).mean()


def test_silhouettes_of_several_labellings(spark, monkeypatch):
    """Small blocks and chunks, labels of any type, a cluster of one point, a labelling of one cluster, and no points."""
    monkeypatch.setattr(quality, "BLOCK_VALUES", 400)
    monkeypatch.setattr(quality, "POINTS_AT_ONCE", 7)
    draw = np.random.default_rng(4)
    x, a, b = draw.normal(size=(120, 2)), draw.integers(0, 3, 120), draw.integers(0, 5, 120)
    b[7] = 5
    df = spark.createDataFrame([(int(a[i]), f"c{b[i]}", 1, v) for i, v in enumerate(x.tolist())], "a int, b string, c int, embedding array<double>")
    got = quality.silhouettes(df, ["a", "b", "c"])
    assert got == {"a": pytest.approx(_mean_silhouette(x, a)), "b": pytest.approx(_mean_silhouette(x, b)), "c": None}
    assert quality.silhouettes(df.limit(0), ["a", "b"]) == {"a": None, "b": None}


def test_external_measures(spark):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b"), (1, "b")], "c int, cat string")
    assert quality.purity(df, "c", "cat").first()[0] == pytest.approx(0.75)
    h = lambda *p: -sum(q * math.log(q) for q in p)
    mi = 0.5 * math.log(0.5 / (0.75 * 0.5)) + 0.25 * math.log(0.25 / (0.75 * 0.5)) + 0.25 * math.log(0.25 / (0.25 * 0.5))
    assert quality.nmi(df, "cat", "c").first()[0] == pytest.approx(mi / ((h(0.75, 0.25) + h(0.5, 0.5)) / 2))
    same = df.withColumn("c", F.lit(1)).withColumn("cat", F.lit("x"))
    assert quality.nmi(same, "cat", "c").first()[0] == 1.0
    assert quality.nmi(df.withColumn("c", F.lit(1)), "cat", "c").first()[0] == 0.0
    assert rows(quality.contingency(df, "c", "cat", wide=True)) == [(0, 2, 1), (1, 0, 1)]


def test_select_k_on_the_recorded_scores(spark):
    schema = clustering.SCORES
    scores = spark.createDataFrame([(k, s, 0.0, 0.0, 0.0) for k, s in RECORDED.items()], schema)
    assert clustering.select_k(scores).first()["k"] == 10
    tied = spark.createDataFrame([(5, 0.2, 0.0, 0.0, 0.0), (4, 0.2, 0.0, 0.0, 0.0)], schema)
    assert clustering.select_k(tied).first()["k"] == 4
    low = spark.createDataFrame([(5, -1.0, 0.0, 0.0, 0.0), (4, -1.0, 0.0, 0.0, 0.0)], schema)
    assert clustering.select_k(low).first()["k"] == 4


def test_recorded_sizes(spark):
    df = spark.createDataFrame(list(enumerate(SIZES)), "cluster_id int, size bigint")
    assert tuple(quality.size_summary(df).first()) == (2484, 77, 380, 248.4)


def test_sweep_summary_and_ablation(spark, blobs):
    df = blobs[0].where("label < 7").withColumn("Category", F.col("label").cast("string"))
    lines = []
    for normalise, pca in ((False, None), (False, 2)):
        ready, kept = clustering.prepare_vectors(df, normalise, pca)
        scores, models = clustering.kmeans_sweep(ready, 2, 4, n_init=2)
        found = {r["k"]: r for r in scores.collect()}
        assert found[2]["inertia"] > found[3]["inertia"] > found[4]["inertia"]
        best = clustering.select_k(scores).first()["k"]
        assert best == 3
        assigned = clustering.kmeans_assign(models[best], ready).select("ID", "Category", "cluster_id")
        assert assigned.count() == assigned.select("ID").distinct().count() == 90
        summary = clustering.clustering_summary(scores, assigned, normalise, pca, kept)
        one = summary.first()
        assert one["best_k"] == 3 and one["n_samples"] == 90 and sum(one["cluster_size_by_id"].values()) == 90
        assert one["purity_with_category"] > 0.9 and one["silhouette_by_k"][3] == one["best_silhouette"]
        lines.append(summary)
    table = {r["variant"]: r for r in clustering.ablation_table(lines).collect()}
    assert set(table) == {"nonorm", "nonorm_pca2"} and 0 < table["nonorm_pca2"]["pca_variance_explained"] <= 1


def test_assign_nearest_takes_the_lower_id_on_ties(spark):
    points = spark.createDataFrame([(1, [0.0]), (2, [1.9])], "ID int, embedding array<double>")
    centres = spark.createDataFrame([(5, [1.0]), (3, [-1.0])], "cluster_id int, centre array<double>")
    assert rows(clustering.assign_nearest(points, centres), "ID", "cluster_id") == [(1, 3), (2, 5)]


def test_assign_nearest_in_blocks_of_centres(spark, monkeypatch):
    points = spark.createDataFrame([(i, [float(i)]) for i in range(8)] + [(9, None)], "ID int, embedding array<double>")
    centres = spark.createDataFrame([(7 - i, [float(i)]) for i in range(8)], "cluster_id int, centre array<double>")
    monkeypatch.setattr(clustering, "MAX_CENTRE_VALUES", 3)
    assert rows(clustering.assign_nearest(points, centres), "ID", "cluster_id") == [(i, 7 - i) for i in range(8)] + [(9, None)]


def test_assign_nearest_without_centres(spark):
    points = spark.createDataFrame([(1, [0.0]), (2, None)], "ID int, embedding array<double>")
    centres = spark.createDataFrame([], "cluster_id int, centre array<double>")
    assert rows(clustering.assign_nearest(points, centres), "ID", "cluster_id") == [(1, None), (2, None)]


def test_kmeans_fit_keeps_the_best_restart(blobs):
    df = blobs[0].where("label < 7")
    assert clustering.kmeans_fit(df, 3, n_init=4).summary.trainingCost <= clustering.kmeans_fit(df, 3, n_init=1).summary.trainingCost


def test_pca_keeps_all_variance_with_all_components(blobs):
    df, data = blobs
    reduced, kept = pca_reduce(df, 9)
    assert kept == pytest.approx(1.0)
    x = np.array([r["embedding"] for r in reduced.collect()])
    assert x.shape == (91, 3) and np.allclose(x.mean(axis=0), 0, atol=1e-9)
    assert x.var(axis=0).sum() == pytest.approx(np.array([d[2] for d in data]).var(axis=0).sum())


def test_embedding(spark):
    df = spark.createDataFrame([("1", "sql python sql"), ("2", "sql"), ("3", ""), ("4", None)], "ID string, clean_text string")
    got = {r["ID"]: r["embedding"] for r in embed_text(df, 16).collect()}
    assert all(len(v) == 16 for v in got.values()) and got["3"] == [0.0] * 16 == got["4"]
    assert sum(v * v for v in got["1"]) == pytest.approx(1.0)
    weights = inverse_frequencies(df, dim=16)
    other = embed_text(df.where("ID = '2'"), 16, weights=weights).first()["embedding"]
    assert other == pytest.approx(got["2"])


def test_a_callers_encoder(spark):
    def encoder(batches):
        for b in batches:
            yield b.assign(embedding=[[float(len(t))] for t in b.clean_text])[["ID", "embedding"]]

    df = spark.createDataFrame([("1", "abc")], "ID string, clean_text string")
    assert rows(embed_text(df, encoder=encoder)) == [("1", [3.0])]
