"""k-means with restarts, the sweep over k, the choice of k, and the run's documents."""

from __future__ import annotations

from collections.abc import Iterable
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillweave.functions.vectors import l2_normalise, to_matrix
from skillweave.operators import cluster_quality as quality
from skillweave.operators.joins import for_iterations, one_row

SEED = 42
RESTARTS = 10
K_MIN, K_MAX = 8, 16
PARALLEL_RUNS = 8
MAX_CENTRE_VALUES = 4_000_000

SCORES = "k int, silhouette double, davies_bouldin double, calinski_harabasz double, inertia double"


def _vectors(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))


def _fit_all(points: DataFrame, runs: list[tuple[int, int]], parallelism: int) -> dict[int, KMeansModel]:
    """Fit every (k, seed) of ``runs``, several at a time, and keep the best of each k by inertia."""

    # A view of the kept points that is not kept itself: MLlib then holds its own vectors during a fit, instead of
    # turning every row into one again at each step.
    view = points.select("_features").where(F.lit(True))

    def attempt(run: tuple[int, int]) -> KMeansModel:
        return KMeans(k=run[0], seed=run[1], featuresCol="_features", predictionCol="cluster_id").fit(view)

    best: dict[int, KMeansModel] = {}
    with ThreadPool(max(1, min(parallelism, len(runs)))) as pool:
        for (k, _), model in zip(runs, pool.imap(inheritable_thread_target(points.sparkSession)(attempt), runs)):
            if k not in best or model.summary.trainingCost < best[k].summary.trainingCost:
                best[k] = model
    return best


def kmeans_fit(
    df: DataFrame,
    k: int,
    seed: int = SEED,
    n_init: int = RESTARTS,
    vector: str = "embedding",
    parallelism: int = PARALLEL_RUNS,
) -> KMeansModel:
    """Best of ``n_init`` runs by inertia; several runs share the cluster."""
    points = for_iterations(_vectors(df, vector).select("_features")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_all(points, [(k, s) for s in range(seed, seed + n_init)], parallelism)[k]
    finally:
        points.unpersist()


def kmeans_assign(model: KMeansModel, df: DataFrame, vector: str = "embedding") -> DataFrame:
    return model.transform(_vectors(df, vector)).drop("_features")


def assign_nearest(points: DataFrame, centres: DataFrame, vector: str = "embedding", out: str = "cluster_id") -> DataFrame:
    """``points`` with the id of the nearest row of ``centres`` (cluster_id, centre), the lower id on ties.

    The centres travel to the points in blocks of bounded size, in the order of their ids; a point without a vector gets no id,
    and without centres no point gets one.
    """
    first = centres.select(F.size("centre").alias("width")).first()
    if first is None:
        return points.withColumn(out, F.lit(None).cast("long"))
    width = first["width"]
    most = max(1, MAX_CENTRE_VALUES // width)
    best, rest = None, centres.select("cluster_id", "centre")
    while (block := rest.orderBy("cluster_id").limit(most).toArrow()).num_rows:
        found = _nearest_of(points, block)(F.col(vector))
        best = found if best is None else F.least(best, found)
        if block.num_rows < most:
            break
        rest = centres.select("cluster_id", "centre").where(F.col("cluster_id") > block.column("cluster_id")[-1].as_py())
    return points.withColumn(out, best["id"])


def _nearest_of(points: DataFrame, block: pa.Table):
    """A function from vectors to (squared distance, id) of the nearest centre of ``block``, whose ids ascend."""
    matrix = to_matrix(block.column("centre"))
    at_once = max(1, MAX_CENTRE_VALUES // matrix.size)
    shared = points.sparkSession.sparkContext.broadcast((block.column("cluster_id").to_numpy(), matrix))

    @F.arrow_udf(T.StructType([T.StructField("distance", T.DoubleType()), T.StructField("id", T.LongType())]))
    def nearest(column: pa.Array) -> pa.Array:
        names, middle = shared.value
        there = column.is_valid().to_numpy(zero_copy_only=False)
        place = np.flatnonzero(there)
        x = to_matrix(column.drop_null()) if len(place) else np.zeros((0, middle.shape[1]))
        near, ids = np.zeros(len(column)), np.zeros(len(column), np.int64)
        for start in range(0, len(x), at_once):
            rows = slice(start, start + at_once)
            gap = np.square(x[rows, None, :] - middle[None, :, :]).sum(axis=2)
            near[place[rows]], ids[place[rows]] = gap.min(axis=1), names[gap.argmin(axis=1)]
        return pa.StructArray.from_arrays([pa.array(near), pa.array(ids)], names=["distance", "id"], mask=pa.array(~there))

    return nearest


def kmeans_sweep(
    df: DataFrame,
    k_min: int = K_MIN,
    k_max: int = K_MAX,
    seed: int = SEED,
    n_init: int = RESTARTS,
    vector: str = "embedding",
    key: str = "ID",
    parallelism: int = PARALLEL_RUNS,
) -> tuple[DataFrame, dict[int, KMeansModel]]:
    """All quality scores for every k over all points, and the fitted models, so the chosen one is not fitted again."""
    points = for_iterations(_vectors(df.select(key, vector), vector)).persist(StorageLevel.MEMORY_AND_DISK)

    def score(k: int) -> tuple:
        labelled = models[k].transform(points)
        spread = quality.dispersion(labelled, "cluster_id", vector).first()
        return (
            k,
            apart[f"_in_{k}"],
            quality.davies_bouldin(labelled, "cluster_id", vector).first()["davies_bouldin"],
            spread["calinski_harabasz"],
            spread["inertia"],
        )

    try:
        runs = [(k, s) for k in range(k_min, k_max + 1) for s in range(seed, seed + n_init)]
        models = _fit_all(points, runs, parallelism)
        placed = points
        for k, model in models.items():
            placed = model.copy({model.predictionCol: f"_in_{k}"}).transform(placed)
        apart = quality.silhouettes(placed, [f"_in_{k}" for k in models], vector)
        with ThreadPool(max(1, min(parallelism, len(models)))) as pool:
            rows = pool.map(inheritable_thread_target(df.sparkSession)(score), sorted(models))
    finally:
        points.unpersist()
    return df.sparkSession.createDataFrame(rows, SCORES), models


def select_k(scores: DataFrame) -> DataFrame:
    """The row with the highest silhouette; of equal ones, and when none exceeds -1, the smallest k."""
    usable = F.when(F.col("silhouette") > -1, F.col("silhouette")).otherwise(F.lit(-1.0))
    return scores.orderBy(F.desc(usable), "k").limit(1)


def variant_name(normalised: bool, pca_components: int | None) -> str:
    base = "norm" if normalised else "nonorm"
    return base if pca_components is None else f"{base}_pca{pca_components}"


def clustering_summary(
    scores: DataFrame,
    assigned: DataFrame,
    normalised: bool = True,
    pca_components: int | None = None,
    pca_variance_explained: float | None = None,
) -> DataFrame:
    """The run as one row: the chosen k with its scores, all scores by k, sizes, NMI and purity.

    ``assigned`` has ID, Category, cluster_id.
    """
    best = select_k(scores).select(
        F.col("k").alias("best_k"),
        F.col("silhouette").alias("best_silhouette"),
        F.col("davies_bouldin").alias("davies_bouldin_at_best_k"),
        F.col("calinski_harabasz").alias("calinski_harabasz_at_best_k"),
    )
    by_k = scores.agg(
        *[
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", m)))).alias(f"{m}_by_k")
            for m in ("silhouette", "davies_bouldin", "calinski_harabasz", "inertia")
        ]
    )
    sizes = quality.cluster_sizes(assigned, "cluster_id")
    size_map = sizes.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cluster_id", "size")))).alias("cluster_size_by_id"))
    parts = [
        best,
        by_k,
        size_map,
        quality.size_summary(sizes),
        quality.nmi(assigned, "Category", "cluster_id").withColumnRenamed("nmi", "nmi_with_category"),
        quality.purity(assigned, "cluster_id", "Category").withColumnRenamed("purity", "purity_with_category"),
    ]
    return one_row(parts).select(
        F.lit(variant_name(normalised, pca_components)).alias("variant"),
        "*",
        F.lit(normalised).alias("normalized_embeddings"),
        F.lit(pca_components).cast("int").alias("pca_components"),
        F.lit(pca_variance_explained).cast("double").alias("pca_variance_explained"),
    )


def ablation_table(summaries: Iterable[DataFrame]) -> DataFrame:
    """One line per variant of the run, scores to four places."""
    table = None
    for summary in summaries:
        line = summary.select(
            "variant",
            "best_k",
            F.round("best_silhouette", 4).alias("silhouette"),
            F.round("davies_bouldin_at_best_k", 4).alias("davies_bouldin"),
            F.round("calinski_harabasz_at_best_k", 1).alias("calinski_harabasz"),
            F.round("nmi_with_category", 4).alias("nmi_with_category"),
            F.round("purity_with_category", 4).alias("purity_with_category"),
            "cluster_size_min",
            "cluster_size_max",
            "cluster_size_mean",
            "pca_components",
            "pca_variance_explained",
        )
        table = line if table is None else table.unionByName(line)
    if table is None:
        raise ValueError("no summaries")
    return table


def prepare_vectors(df: DataFrame, normalise: bool = True, pca_components: int | None = None, vector: str = "embedding") -> tuple[DataFrame, float | None]:
    """Vectors as the sweep wants them: unit length and, on request, on their principal components."""
    from skillweave.operators.embedding import pca_reduce

    ready = df.withColumn(vector, l2_normalise(F.col(vector))) if normalise else df
    return (ready, None) if pca_components is None else pca_reduce(ready, pca_components, vector)
