"""How good a clustering is, from the vectors alone and against known categories.

Within- and between-cluster dispersion come from one aggregation per cluster; no pair of points is
ever listed. Tables with one row per cluster are joined back under a size check.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillweave.functions.vectors import as_double, to_matrix
from skillweave.operators.joins import lookup_join
from skillweave.session import cut_lineage, written

SILHOUETTE_SAMPLE = 2000
ROWS_AT_ONCE = 256
#: Numbers a task holds for its block of points in ``silhouettes``: vectors, and a sum per cluster of every labelling.
BLOCK_VALUES = 8_000_000
POINTS_AT_ONCE = 2048


def _squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def centroids(df: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    """(label, n, centre, within): size, mean and summed squared distance to the mean per cluster."""
    stats = Summarizer.metrics("mean", "variance").summary(array_to_vector(as_double(F.col(vector))))
    return (
        df.groupBy(label)
        .agg(F.count("*").alias("n"), stats.alias("_s"))
        .select(
            label,
            "n",
            vector_to_array("_s.mean").alias("centre"),
            ((F.col("n") - 1) * _total(vector_to_array("_s.variance"))).alias("within"),
        )
    )


def dispersion(df: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    """Inertia and Calinski-Harabasz in one pass over the points."""
    summed = Summarizer.metrics("mean", "variance").summary(array_to_vector("centre"), F.col("n").cast("double"))
    total = (
        centroids(df, label, vector)
        .agg(
            F.count("*").alias("k"),
            F.sum("n").alias("n"),
            F.sum("within").alias("inertia"),
            summed.alias("_s"),
            F.collect_list(F.struct("n", "centre")).alias("_clusters"),
        )
        .withColumn("_mean", vector_to_array("_s.mean"))
    )
    between = F.aggregate(
        "_clusters", F.lit(0.0), lambda s, c: s + c["n"] * _squared_distance(c["centre"], F.col("_mean"))
    )
    ratio = F.when(F.col("inertia") > 0, between / F.col("inertia") * (F.col("n") - F.col("k")) / (F.col("k") - 1)).otherwise(1.0)
    return total.select("k", "n", "inertia", ratio.alias("calinski_harabasz"))


def inertia(df: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    return centroids(df, label, vector).agg(F.sum("within").alias("inertia"))


def calinski_harabasz(df: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    return dispersion(df, label, vector).select("calinski_harabasz")


def davies_bouldin(df: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / distance to another cluster."""
    centres = cut_lineage(centroids(df, label, vector).select(label, "centre"))
    spread = (
        lookup_join(df.select(label, vector), centres, label)
        .groupBy(label)
        .agg(F.avg(F.sqrt(_squared_distance(F.col(vector), F.col("centre")))).alias("spread"), F.any_value("centre").alias("centre"))
    )
    # One row per cluster: every cluster sees the others as one array.
    everyone = F.collect_list(F.struct(F.col(label).alias("id"), "centre", "spread")).over(W.partitionBy(F.lit(1)))
    apart = lambda o: F.sqrt(_squared_distance(o["centre"], F.col("centre")))
    others = F.filter("_all", lambda o: (o["id"] != F.col(label)) & (apart(o) > 0))
    worst = F.coalesce(F.array_max(F.transform(others, lambda o: (o["spread"] + F.col("spread")) / apart(o))), F.lit(0.0))
    return spread.withColumn("_all", everyone).agg(F.avg(worst).alias("davies_bouldin"))


def silhouette_points(
    df: DataFrame, label: str, sample: int = SILHOUETTE_SAMPLE, vector: str = "embedding", key: str = "ID"
) -> DataFrame:
    """(key, label, a, b, silhouette) for a sample of at most ``sample`` points, Euclidean.

    The sample is the first points in md5 order of their key, so it does not depend on the
    partitioning. It travels to the tasks as one bounded matrix; distances stay inside the tasks.
    """
    chosen = df.select(F.col(key).cast("string").alias("_key"), F.col(label).cast("string").alias("_label"), vector)
    table = chosen.orderBy(F.md5("_key"), "_key").limit(sample).toArrow()
    spark = df.sparkSession
    names, inverse, sizes = np.unique(np.array(table.column("_label").to_pylist(), dtype=object), return_inverse=True, return_counts=True)
    matrix = to_matrix(table.column(vector))
    member = np.eye(len(names))[inverse] if len(names) else np.zeros((0, 0))
    shared = spark.sparkContext.broadcast((names, inverse, sizes, matrix, member))
    keys = table.column("_key").to_pylist()
    schema = pa.schema([("key", pa.string()), ("label", pa.string()), ("a", pa.float64()), ("b", pa.float64()), ("silhouette", pa.float64())])

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, inverse, sizes, matrix, member = shared.value
        squares = np.square(matrix).sum(axis=1)
        for batch in batches:
            positions, ids = batch.column("position").to_numpy(), batch.column("key")
            for start in range(0, len(positions), ROWS_AT_ONCE):
                rows = positions[start : start + ROWS_AT_ONCE]
                gap = squares[rows, None] + squares[None, :] - 2.0 * matrix[rows] @ matrix.T
                distance = np.sqrt(np.maximum(gap, 0.0))
                distance[np.arange(len(rows)), rows] = 0.0
                to_cluster = distance @ member
                own = inverse[rows]
                at = np.arange(len(rows))
                a = to_cluster[at, own] / np.maximum(sizes[own] - 1, 1)
                mean = to_cluster / sizes
                mean[at, own] = np.inf
                b = mean.min(axis=1)
                value = np.where(sizes[own] > 1, (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0.0)
                alone = np.isinf(b)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, len(rows)),
                        pa.array(names[own].tolist(), pa.string()),
                        pa.array(a),
                        pa.array(b, mask=alone),
                        pa.array(value, mask=alone),
                    ],
                    schema=schema,
                )

    tasks = max(1, len(keys) // ROWS_AT_ONCE)
    points = spark.createDataFrame(list(enumerate(keys)), "position bigint, key string").repartition(tasks, "position")
    return points.mapInArrow(measure, "key string, label string, a double, b double, silhouette double")


def silhouette(df: DataFrame, label: str, sample: int = SILHOUETTE_SAMPLE, vector: str = "embedding", key: str = "ID") -> DataFrame:
    return silhouette_points(df, label, sample, vector, key).agg(F.avg("silhouette").alias("silhouette"))


class _Block:
    """Points of one task with the sum of their distances to every cluster of every labelling, as far as the others have passed."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, own: np.ndarray, columns: int):
        order = np.argsort(ids)
        self.ids, self.points, self.own = ids[order], points[order], own[order]
        self.squares = np.square(self.points).sum(axis=1)
        self.sums = np.zeros((len(ids), columns))

    def add(self, ids: np.ndarray, points: np.ndarray, clusters: np.ndarray) -> None:
        """``clusters``: the column of a point's cluster in each labelling."""
        for start in range(0, len(ids), POINTS_AT_ONCE):
            some = slice(start, start + POINTS_AT_ONCE)
            others, member = points[some], np.zeros((len(ids[some]), self.sums.shape[1]))
            np.put_along_axis(member, clusters[some], 1.0, axis=1)
            squares = np.square(others).sum(axis=1)
            place = np.minimum(np.searchsorted(self.ids, ids[some]), len(self.ids) - 1)
            same = np.flatnonzero(self.ids[place] == ids[some])
            for first in range(0, len(self.ids), ROWS_AT_ONCE):
                rows = slice(first, first + ROWS_AT_ONCE)
                gap = self.points[rows] @ (-2.0 * others.T)
                gap += self.squares[rows, None]
                gap += squares
                np.maximum(gap, 0.0, out=gap)
                np.sqrt(gap, out=gap)
                here = same[(place[same] >= first) & (place[same] < first + ROWS_AT_ONCE)]
                gap[place[here] - first, here] = 0.0
                self.sums[rows] += gap @ member

    def values(self, sizes: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """The silhouette of every point in each labelling, NaN where it has one cluster only; ``sizes`` by column."""
        at = np.arange(len(self.ids))
        for number, (start, end) in enumerate(zip(starts[:-1], starts[1:])):
            own = self.own[:, number] - start
            size, sums = sizes[start:end], self.sums[:, start:end]
            a = sums[at, own] / np.maximum(size[own] - 1, 1)
            mean = sums / size
            mean[at, own] = np.inf
            b = mean.min(axis=1)
            alone = np.isinf(b)
            b[alone] = 0.0
            value = np.where(size[own] > 1, (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0.0)
            yield np.where(alone, np.nan, value)


def silhouettes(df: DataFrame, labels: list[str], vector: str = "embedding") -> dict[str, float | None]:
    """The mean Euclidean silhouette over all points, for each of several labellings; None where it has one cluster only.

    A task holds a block of points and all points stream past it, so a distance is computed once for all labellings, no pair
    is listed and memory does not grow with the table. The work grows with its square.
    """
    spark = df.sparkSession
    points = written(df.select(F.monotonically_increasing_id().alias("_at"), *labels, F.col(vector).alias("_vector")), "silhouette_points")
    places = F.explode(F.array(*[F.struct(F.lit(i).alias("labelling"), F.col(c).cast("string").alias("cluster")) for i, c in enumerate(labels)])).alias("_of")
    counts = points.select(places).groupBy("_of.labelling", "_of.cluster").count().orderBy("labelling", "cluster").collect()  # a row per cluster
    if not counts:
        return dict.fromkeys(labels)
    names = [[r["cluster"] for r in counts if r["labelling"] == i] for i in range(len(labels))]
    starts = np.cumsum([0, *map(len, names)])
    sizes = np.array([r["count"] for r in counts])
    width = points.select(F.max(F.size("_vector"))).first()[0]
    rows, cores = sum(sizes[: starts[1]]), spark.sparkContext.defaultParallelism
    n_blocks = math.ceil(rows / max(1, BLOCK_VALUES // (2 * width + 2 * len(sizes))) / cores) * cores
    block = F.pmod(F.xxhash64("_at"), F.lit(n_blocks)).cast("int").alias("_block")
    left = points.select(block, F.lit(0).alias("_role"), *points.columns)
    right = points.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_block"), F.lit(1).alias("_role"), *points.columns)
    met = left.unionByName(right).repartitionById(n_blocks, "_block").sortWithinPartitions("_role")

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = [pc.index_in(batch.column(c).cast(pa.string()), value_set=pa.array(n, pa.string())).to_numpy(zero_copy_only=False) for c, n in zip(labels, names)]
        return batch.column("_at").to_numpy(), to_matrix(batch.column("_vector")), np.stack(own, axis=1) + starts[:-1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], None
        for batch in batches:
            first = int(np.searchsorted(batch.column("_role").to_numpy(), 1))
            if first:
                waiting.append(read(batch.slice(0, first)))
            if first < batch.num_rows and (waiting or held):
                if held is None:
                    held, waiting = _Block(*(np.concatenate(part) for part in zip(*waiting)), len(sizes)), []
                held.add(*read(batch.slice(first)))
        if held is not None:
            found = [v[~np.isnan(v)] for v in held.values(sizes, starts)]
            columns = [pa.array(range(len(labels)), pa.int32()), pa.array([v.sum() for v in found]), pa.array([len(v) for v in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["labelling", "total", "n"])

    parts = met.mapInArrow(measure, "labelling int, total double, n bigint").groupBy("labelling").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return {labels[r["labelling"]]: r["total"] / r["n"] if r["n"] else None for r in parts.collect()}


def silhouette_sq(df: DataFrame, label: str, vector: str = "embedding") -> float:
    """Spark's own silhouette on squared distances over all points; another number than the Euclidean one."""
    points = df.select(F.col(label).cast("double").alias("prediction"), array_to_vector(as_double(F.col(vector))).alias("features"))
    return ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(points)


def cluster_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("size")).orderBy(label)


def size_summary(sizes: DataFrame) -> DataFrame:
    return sizes.agg(
        F.sum("size").alias("n_samples"),
        F.min("size").alias("cluster_size_min"),
        F.max("size").alias("cluster_size_max"),
        F.round(F.avg("size"), 1).alias("cluster_size_mean"),
    )


def contingency(df: DataFrame, a: str, b: str, wide: bool = False) -> DataFrame:
    """Counts of every pair of values, in long form; ``wide`` pivots the second column."""
    if wide:
        return df.groupBy(a).pivot(b).count().na.fill(0)
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def purity(df: DataFrame, cluster: str, category: str) -> DataFrame:
    largest = contingency(df, cluster, category).groupBy(cluster).agg(F.max("n").alias("top"), F.sum("n").alias("size"))
    return largest.agg((F.sum("top") / F.sum("size")).alias("purity"))


def nmi(df: DataFrame, a: str, b: str) -> DataFrame:
    """Mutual information over the mean of the two entropies; 1 when both sides are constant."""
    counts = contingency(df, a, b).withColumns(
        {"in_a": F.sum("n").over(W.partitionBy(a)), "in_b": F.sum("n").over(W.partitionBy(b))}
    )
    n, total = F.col("n"), F.sum("n")
    sums = counts.agg(
        total.alias("total"),
        (F.sum(n * (F.log("n") - F.log("in_a") - F.log("in_b"))) / total + F.log(total)).alias("mi"),
        (F.log(total) - F.sum(n * F.log("in_a")) / total).alias("ha"),
        (F.log(total) - F.sum(n * F.log("in_b")) / total).alias("hb"),
        F.max("in_a").alias("top_a"),
        F.max("in_b").alias("top_b"),
    )
    constant = (F.col("top_a") == F.col("total")) & (F.col("top_b") == F.col("total"))
    share = F.when(F.col("mi") > 1e-15, F.col("mi") / ((F.col("ha") + F.col("hb")) / 2)).otherwise(0.0)
    return sums.select(F.when(constant, F.lit(1.0)).otherwise(share).alias("nmi"))
