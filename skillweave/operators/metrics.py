"""Classification and ranking metrics.

Predictions are rows with ``y_true`` and ``y_pred`` (plus grouping columns such as ``model`` and
``split``). Everything is computed from the confusion counts, so the only shuffle that sees the
predictions is a pre-aggregated one and a dominant class costs nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def confusion(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "y_true", "y_pred").agg(F.count("*").alias("n"))


def accuracy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    same = (F.col("y_true") == F.col("y_pred")).cast("double")
    return df.groupBy(*by).agg(F.coalesce(F.avg(same), F.lit(0.0)).alias("accuracy"))


def per_class(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support for every label seen as truth or as prediction."""
    hit = F.col("y_true") == F.col("y_pred")
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    roles = F.array(
        F.struct(
            F.col("y_true").alias("label"),
            F.when(hit, n).otherwise(zero).alias("tp"),
            zero.alias("fp"),
            F.when(hit, zero).otherwise(n).alias("fn"),
        ),
        F.struct(
            F.col("y_pred").alias("label"),
            zero.alias("tp"),
            F.when(hit, zero).otherwise(n).alias("fp"),
            zero.alias("fn"),
        ),
    )
    counted = (
        confusion(df, by)
        .select(*by, F.inline(roles))
        .groupBy(*by, "label")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counted.select(
        *by,
        "label",
        "tp",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("support"),
    )


def macro_f1(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return per_class(df, by).groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


def weighted_f1(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    weighted = F.sum(F.col("f1") * F.col("support")) / F.sum("support")
    return per_class(df, by).groupBy(*by).agg(weighted.alias("weighted_f1"))


def _disparity_columns() -> list[Column]:
    f1, zero = F.col("f1"), F.lit(0.0)
    return [
        F.coalesce(F.min(f1), zero).alias("min_f1"),
        F.coalesce(F.max(f1), zero).alias("max_f1"),
        F.coalesce(F.max(f1) - F.min(f1), zero).alias("gap"),
        F.coalesce(F.stddev_pop(f1), zero).alias("std"),
    ]


def disparity(classes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Spread of the per-class F1: min, max, gap and population deviation; zeros without classes."""
    return classes.groupBy(*by).agg(*_disparity_columns())


def evaluate_predictions(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro and weighted F1 and a ``disparity`` struct, one row per group."""
    support = F.sum("support")
    return (
        per_class(df, by)
        .groupBy(*by)
        .agg(
            (F.sum("tp") / support).alias("accuracy"),
            F.avg("f1").alias("macro_f1"),
            (F.sum(F.col("f1") * F.col("support")) / support).alias("weighted_f1"),
            *_disparity_columns(),
        )
        .select(
            *by,
            "accuracy",
            "macro_f1",
            "weighted_f1",
            F.struct("min_f1", "max_f1", "gap", "std").alias("disparity"),
        )
    )


def classification_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The report as rows: one per label, then ``accuracy``, ``macro avg`` and ``weighted avg``."""
    support = F.sum("support")
    line_type = "array<struct<label:string,precision:double,recall:double,f1:double,support:bigint>>"
    rows = (
        per_class(df, by)
        .groupBy(*by)
        .agg(
            F.collect_list(F.struct("label", "precision", "recall", "f1", "support")).cast(line_type).alias("classes"),
            (F.sum("tp") / support).alias("acc"),
            support.alias("n"),
            *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
            *[(F.sum(F.col(c) * F.col("support")) / support).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
        )
    )
    nothing = F.lit(None).cast("double")

    def line(name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            F.col("n").alias("support"),
        )

    totals = F.array(
        line("accuracy", nothing, nothing, F.col("acc")),
        line("macro avg", F.col("m_precision"), F.col("m_recall"), F.col("m_f1")),
        line("weighted avg", F.col("w_precision"), F.col("w_recall"), F.col("w_f1")),
    )
    return rows.select(*by, F.inline(F.concat("classes", totals.cast(line_type))))


def flatten_models(results: DataFrame) -> DataFrame:
    """Lift the ``disparity`` struct to ``disparity_*`` columns and drop the detail columns."""
    kept = [c for c in results.columns if c not in ("disparity", "report", "per_class_f1")]
    inner = results.schema["disparity"].dataType.names if "disparity" in results.columns else []
    return results.select(*kept, *[F.col(f"disparity.{c}").alias(f"disparity_{c}") for c in inner])


def compare_models(results: DataFrame) -> DataFrame:
    """One flat row per model, best macro F1 first."""
    flat = flatten_models(results)
    return flat.orderBy(F.desc("macro_f1"), "model") if "macro_f1" in flat.columns else flat


def precision_at_k(ranked: DataFrame, relevant: DataFrame, k: int, query: str = "JobID", item: str = "ID") -> DataFrame:
    """Share of relevant items among the first ``k``, one row per query.

    ``ranked`` holds (query, item, rank), ``relevant`` distinct (query, item) pairs. The divisor is
    ``k`` even for shorter lists; ``k <= 0`` gives 0.
    """
    if k <= 0:
        return ranked.select(query).distinct().withColumn("precision_at_k", F.lit(0.0))
    # Every query has a first rank, so the head of the lists already holds all queries.
    flagged = ranked.where(F.col("rank") <= k).join(
        relevant.select(query, item).distinct().withColumn("_hit", F.lit(1)), [query, item], "left"
    )
    return flagged.groupBy(query).agg((F.count("_hit") / F.lit(float(k))).alias("precision_at_k"))


def mean_precision_at_k(ranked: DataFrame, relevant: DataFrame, k: int, query: str = "JobID", item: str = "ID") -> DataFrame:
    """Mean over all queries; a query without relevant items counts as 0, no queries give 0."""
    each = precision_at_k(ranked, relevant, k, query, item)
    return each.agg(F.coalesce(F.avg("precision_at_k"), F.lit(0.0)).alias("mean_precision_at_k"))


def relevant_ids(profiles: DataFrame, category: str) -> DataFrame:
    """Ids of the profiles of one category."""
    return profiles.where(F.col("Category").cast("string") == category).select(F.col("ID").cast("string").alias("ID")).distinct()
