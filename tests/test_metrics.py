from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skillweave.operators import metrics
from skillweave.operators.classify import comparison_table, per_class_f1_table, side_by_side

# Recorded test predictions of one model, as counts per true category.
CONFUSION = {
    "ACCOUNTANT": "ACCOUNTANT:18",
    "ADVOCATE": "ADVOCATE:12 APPAREL:1 ARTS:1 HEALTHCARE:4",
    "AGRICULTURE": "AGRICULTURE:7 CONSTRUCTION:1 FITNESS:1",
    "APPAREL": "ADVOCATE:1 APPAREL:5 AVIATION:1 BANKING:1 BUSINESS-DEVELOPMENT:1 DESIGNER:2 FITNESS:1 PUBLIC-RELATIONS:1 SALES:2",
    "ARTS": "ARTS:4 AVIATION:1 BPO:1 DIGITAL-MEDIA:1 FITNESS:1 HEALTHCARE:1 PUBLIC-RELATIONS:1 TEACHER:5",
    "AUTOMOBILE": "ADVOCATE:2 AUTOMOBILE:2 AVIATION:1",
    "AVIATION": "AGRICULTURE:1 AUTOMOBILE:2 AVIATION:12 DESIGNER:1 PUBLIC-RELATIONS:1 SALES:1",
    "BANKING": "ACCOUNTANT:1 ADVOCATE:1 AGRICULTURE:1 BANKING:12 BPO:1 INFORMATION-TECHNOLOGY:1",
    "BPO": "AVIATION:1 BPO:1 HEALTHCARE:1",
    "BUSINESS-DEVELOPMENT": "BUSINESS-DEVELOPMENT:18",
    "CHEF": "ARTS:1 BANKING:1 CHEF:14 SALES:1 TEACHER:1",
    "CONSTRUCTION": "BANKING:1 CONSTRUCTION:13 FITNESS:1 HEALTHCARE:1 INFORMATION-TECHNOLOGY:1",
    "CONSULTANT": "CONSULTANT:17",
    "DESIGNER": "AGRICULTURE:1 DESIGNER:13 INFORMATION-TECHNOLOGY:1 PUBLIC-RELATIONS:1",
    "DIGITAL-MEDIA": "CONSULTANT:1 DESIGNER:1 DIGITAL-MEDIA:10 ENGINEERING:1 PUBLIC-RELATIONS:1",
    "ENGINEERING": "BANKING:1 CONSTRUCTION:1 ENGINEERING:15 INFORMATION-TECHNOLOGY:1",
    "FINANCE": "FINANCE:17 HR:1",
    "FITNESS": "ADVOCATE:1 ARTS:1 AUTOMOBILE:1 AVIATION:1 BPO:1 FITNESS:9 HEALTHCARE:1 SALES:1 TEACHER:2",
    "HEALTHCARE": "AVIATION:1 DIGITAL-MEDIA:1 FITNESS:1 HEALTHCARE:14",
    "HR": "HEALTHCARE:1 HR:16",
    "INFORMATION-TECHNOLOGY": "ARTS:1 CONSULTANT:1 INFORMATION-TECHNOLOGY:16",
    "PUBLIC-RELATIONS": "ACCOUNTANT:1 BPO:1 BUSINESS-DEVELOPMENT:1 CHEF:1 DIGITAL-MEDIA:1 FITNESS:1 PUBLIC-RELATIONS:11",
    "SALES": "CONSTRUCTION:1 SALES:16",
    "TEACHER": "ARTS:1 FITNESS:1 TEACHER:13",
}


@pytest.fixture(scope="module")
def recorded(spark):
    pairs = [(t, p.split(":")[0]) for t, line in CONFUSION.items() for p in line.split() for _ in range(int(p.split(":")[1]))]
    return spark.createDataFrame(pairs, "y_true string, y_pred string")


def test_recorded_predictions_give_the_recorded_metrics(recorded):
    found = metrics.evaluate_predictions(recorded).first()
    assert found["accuracy"] == pytest.approx(0.7640750670241286, abs=1e-12)
    assert found["macro_f1"] == pytest.approx(0.7240688837115566, abs=1e-12)
    assert found["weighted_f1"] == pytest.approx(0.757299398986747, abs=1e-12)
    assert found["disparity"]["gap"] == pytest.approx(0.7214285714285714, abs=1e-12)
    table = comparison_table(recorded.select(F.lit("m").alias("model"), F.lit("test").alias("split"), "*")).first()
    assert table["disparity_gap"] == pytest.approx(0.7214285714285714, abs=1e-12)


def test_single_metrics_agree_with_the_combined_ones(recorded):
    found = metrics.evaluate_predictions(recorded).first()
    assert metrics.accuracy(recorded).first()[0] == pytest.approx(found["accuracy"])
    assert metrics.macro_f1(recorded).first()[0] == pytest.approx(found["macro_f1"])
    assert metrics.weighted_f1(recorded).first()[0] == pytest.approx(found["weighted_f1"])
    report = {r["label"]: r for r in metrics.classification_report(recorded).collect()}
    assert report["accuracy"]["f1"] == pytest.approx(found["accuracy"]) and report["macro avg"]["support"] == 373
    assert report["macro avg"]["f1"] == pytest.approx(found["macro_f1"]) and len(report) == 24 + 3


def test_labels_of_one_side_only_count_as_zero(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "a")], "y_true string, y_pred string")
    classes = {r["label"]: r for r in metrics.per_class(pairs).collect()}
    assert classes["b"]["f1"] == 0 and classes["c"]["f1"] == 0 and classes["c"]["support"] == 0
    assert metrics.macro_f1(pairs).first()[0] == pytest.approx((0.5 + 0 + 0) / 3)
    by_model = pairs.withColumn("model", F.lit("m"))
    assert [r["category"] for r in per_class_f1_table(by_model).orderBy("category").collect()] == ["a", "b"]


def test_disparity_without_classes_is_zero(spark):
    empty = spark.createDataFrame([], "label string, f1 double")
    assert tuple(metrics.disparity(empty).first()) == (0.0, 0.0, 0.0, 0.0)


def test_disparity_uses_the_population_deviation(spark):
    two = spark.createDataFrame([("a", 0.0), ("b", 1.0)], "label string, f1 double")
    assert metrics.disparity(two).first()["std"] == pytest.approx(0.5)


def test_compare_models_sorts_by_macro_f1_and_flattens(spark):
    pairs = spark.createDataFrame(
        [("bad", "a", "b"), ("bad", "b", "b"), ("good", "a", "a"), ("good", "b", "b")], "model string, y_true string, y_pred string"
    )
    table = metrics.compare_models(metrics.evaluate_predictions(pairs, ["model"]))
    assert table.columns[-4:] == ["disparity_min_f1", "disparity_max_f1", "disparity_gap", "disparity_std"]
    assert [r["model"] for r in table.collect()] == ["good", "bad"]


def test_precision_at_k(spark):
    ranked = spark.createDataFrame([("q1", "x", 1), ("q2", "y", 1), ("q2", "z", 2), ("q3", "w", 1)], "JobID string, ID string, rank int")
    relevant = spark.createDataFrame([("q1", "x"), ("q2", "z"), ("q2", "y")], "JobID string, ID string")
    assert rows(metrics.precision_at_k(ranked, relevant, 5)) == [("q1", 0.2), ("q2", 0.4), ("q3", 0.0)]
    assert rows(metrics.precision_at_k(ranked, relevant, 1)) == [("q1", 1.0), ("q2", 1.0), ("q3", 0.0)]
    assert rows(metrics.precision_at_k(ranked, relevant, 0)) == [("q1", 0.0), ("q2", 0.0), ("q3", 0.0)]
    assert metrics.mean_precision_at_k(ranked, relevant, 5).first()[0] == pytest.approx(0.2)
    assert metrics.mean_precision_at_k(ranked.limit(0), relevant, 5).first()[0] == 0.0


def test_side_by_side(spark):
    long = spark.createDataFrame(
        [("m1", "1", "a", "a"), ("m2", "1", "a", "b"), ("m1", "2", "b", "b")], "model string, ID string, y_true string, y_pred string"
    )
    assert rows(side_by_side(long, names={"m1": "p1", "m2": "p2"})) == [("1", "a", "a", "b"), ("2", "b", "b", None)]
