"""Three category classifiers on one split, and the tables that compare them."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LinearSVC, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillweave.operators.features import fit_tfidf, stratified_split, with_class_weights
from skillweave.operators.joins import for_iterations
from skillweave.operators.metrics import evaluate_predictions, per_class
from skillweave.session import written

SEED = 42
SVM_ITERATIONS = 100
TREES = 200
MAX_DEPTH = 30
FOREST_ROWS = 5_000  # a pass of the forest is long; every task sends sums of all nodes, so only a few tasks are as small

# Model names and their columns in the prediction table.
PREDICTION_COLUMNS = {"tfidf_linearsvc": "pred_tfidf", "sbert_rf": "pred_sbert_rf", "sbert_linearsvc": "pred_sbert_linearsvc"}


class FittedClassifier:
    """A Spark model with the label names it was trained on."""

    def __init__(self, model, labels: list[str], features: str):
        self.model, self.labels, self.features = model, labels, features


def _indexed(train: DataFrame, label: str) -> tuple[DataFrame, StringIndexerModel]:
    indexer = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc").fit(train)
    return indexer.transform(train), indexer


def fit_linear_svc(train: DataFrame, features: str, label: str = "Category", weight: str = "weight", max_iter: int = SVM_ITERATIONS, parallelism: int = 4) -> FittedClassifier:
    """One linear SVM per class against the rest; the penalty equals a cost of 1 per training row."""
    n = train.count()
    rows, indexer = _indexed(for_iterations(train.select(label, features, weight), n), label)
    svm = LinearSVC(maxIter=max_iter, regParam=1.0 / max(1, n), standardization=False)
    model = OneVsRest(classifier=svm, featuresCol=features, labelCol="_label", weightCol=weight, predictionCol="_predicted", parallelism=parallelism).fit(rows)
    return FittedClassifier(model, indexer.labels, features)


def fit_random_forest(train: DataFrame, features: str, label: str = "Category", weight: str = "weight", trees: int = TREES, max_depth: int = MAX_DEPTH, seed: int = SEED) -> FittedClassifier:
    """Every row keeps the node it stands at in every tree, so no pass walks the trees from their roots again."""
    rows, indexer = _indexed(for_iterations(train.select(label, features, weight), least_rows=FOREST_ROWS), label)
    forest = RandomForestClassifier(
        numTrees=trees,
        maxDepth=max_depth,
        featureSubsetStrategy="sqrt",
        seed=seed,
        featuresCol=features,
        labelCol="_label",
        weightCol=weight,
        predictionCol="_predicted",
        cacheNodeIds=True,
    )
    return FittedClassifier(forest.fit(rows), indexer.labels, features)


def predict(fitted: FittedClassifier, df: DataFrame, label: str = "Category", key: str = "ID") -> DataFrame:
    """(key, split if present, y_true, y_pred)."""
    back = IndexToString(inputCol="_predicted", outputCol="y_pred", labels=fitted.labels)
    kept = [key, *(["split"] if "split" in df.columns else []), F.col(label).cast("string").alias("y_true"), "y_pred"]
    return back.transform(fitted.model.transform(df)).select(*kept)


def classify(
    profiles: DataFrame,
    trees: int = TREES,
    max_depth: int = MAX_DEPTH,
    max_iter: int = SVM_ITERATIONS,
    max_features: int = 30_000,
    seed: int = SEED,
) -> DataFrame:
    """Train on the training rows, predict validation and test: (model, split, ID, y_true, y_pred).

    ``profiles`` has ID, Category, clean_text, embedding.
    """
    ready = written(stratified_split(profiles, "Category", "ID", seed), "split").withColumn(
        "vector", array_to_vector(F.col("embedding").cast("array<double>"))
    )
    train, held = ready.where(F.col("split") == "train"), ready.where(F.col("split") != "train")
    weighted = with_class_weights(train)
    text_model = fit_tfidf(train, max_features=max_features)
    fitted = {
        "tfidf_linearsvc": fit_linear_svc(text_model.transform(weighted), "tfidf", max_iter=max_iter),
        "sbert_rf": fit_random_forest(weighted, "vector", trees=trees, max_depth=max_depth, seed=seed),
        "sbert_linearsvc": fit_linear_svc(weighted, "vector", max_iter=max_iter),
    }
    rows = []
    for name, model in fitted.items():
        source = text_model.transform(held) if model.features == "tfidf" else held
        rows.append(predict(model, source).select(F.lit(name).alias("model"), "split", "ID", "y_true", "y_pred"))
    return reduce(DataFrame.unionByName, rows)


def comparison_table(predictions: DataFrame) -> DataFrame:
    """(model, split, accuracy, macro_f1, weighted_f1, disparity_gap) from long predictions."""
    return evaluate_predictions(predictions, ["model", "split"]).select(
        "model", "split", "accuracy", "macro_f1", "weighted_f1", F.col("disparity.gap").alias("disparity_gap")
    )


def per_class_f1_table(predictions: DataFrame) -> DataFrame:
    """(model, category, f1) over the labels that occur as truth."""
    return per_class(predictions, ["model"]).where(F.col("support") > 0).select("model", F.col("label").alias("category"), "f1")


def side_by_side(predictions: DataFrame, key: str = "ID", names: dict[str, str] | None = None) -> DataFrame:
    """One row per key with the truth and one column per model."""
    names = PREDICTION_COLUMNS if names is None else names
    wide = [F.first(F.when(F.col("model") == model, F.col("y_pred")), ignorenulls=True).alias(column) for model, column in names.items()]
    return predictions.groupBy(key, "y_true").agg(*wide)
