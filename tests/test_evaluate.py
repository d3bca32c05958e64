import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from barforge.operators import evaluate, report


def matrix(spark, tn, fp, fn, tp, split="validation"):
    cells = [(split, 0.0, 0.0, tn), (split, 0.0, 1.0, fp), (split, 1.0, 0.0, fn),
             (split, 1.0, 1.0, tp)]
    counted = spark.createDataFrame(
        cells, "split string, label double, prediction double, n int")
    return counted.select(
        "split", "label", "prediction", F.explode(F.sequence(F.lit(1), "n"))).drop("col")


@pytest.fixture(scope="module")
def guesses(spark):
    rng = np.random.default_rng(5)
    n = 1000
    return spark.createDataFrame(pd.DataFrame({
        "split": np.where(np.arange(n) < 400, "validation", "test"),
        "label": rng.integers(0, 2, n) * 1.0, "prediction": rng.integers(0, 2, n) * 1.0}))


def test_classification_metrics_equal_the_evaluators(spark, guesses):
    names = {"accuracy": "accuracy", "f1": "f1", "precision": "weightedPrecision",
             "recall": "weightedRecall"}
    never = guesses.withColumn("prediction", F.lit(1.0))  # one class never predicted
    for df in (guesses, never):
        for row in evaluate.classification_metrics(df).collect():
            part = df.where(F.col("split") == row["split"])
            for ours, theirs in names.items():
                want = MulticlassClassificationEvaluator(metricName=theirs).evaluate(part)
                assert row[ours] == pytest.approx(want, rel=1e-12), ours


def test_regression_metrics_equal_the_evaluators(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame(pd.DataFrame({
        "split": "test", "label": rng.normal(0, 1, 500), "prediction": rng.normal(0, 1, 500)}))
    row = evaluate.regression_metrics(df).first()
    for name in ("rmse", "mae", "r2"):
        assert row[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df))


def test_class_report_scores(spark):
    # By hand: precision 30/50, recall 30/40 for class 1; 45/55 and 45/65 for class 0.
    df = matrix(spark, tn=45, fp=20, fn=10, tp=30)
    row = evaluate.class_report(df).first()
    assert (row.total, row.predicted_positive, row.predicted_negative) == (105, 50, 55)
    assert row.precision_1 == pytest.approx(0.6) and row.recall_1 == pytest.approx(0.75)
    assert row.f1_1 == pytest.approx(2 / 3)
    assert row.precision_0 == pytest.approx(45 / 55) and row.recall_0 == pytest.approx(45 / 65)
    assert row.balanced_accuracy == pytest.approx((0.75 + 45 / 65) / 2)
    cells = {(r.label, r.prediction): r.rows for r in evaluate.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 45, (0, 1): 20, (1, 0): 10, (1, 1): 30}


def test_majority_baseline_is_the_constant_prediction(spark, guesses):
    train = spark.createDataFrame([("train", 1.0), ("train", 0.0)], "split string, label double")
    df = guesses.select("split", "label").union(train)  # a tie: predicts 1
    row = evaluate.majority_baseline(df).first()
    assert row.majority_class == 1.0
    constant = df.where("split <> 'train'").withColumn("prediction", F.lit(1.0))
    for want in evaluate.classification_metrics(constant).collect():
        side = {"validation": "val", "test": "test"}[want["split"]]
        for name in evaluate.CLASSIFICATION_METRICS:
            assert row[f"{side}_{name}"] == pytest.approx(want[name], rel=1e-12)


def test_majority_of_another_class(spark):
    df = spark.createDataFrame(
        [("train", 0.0), ("validation", 0.0), ("validation", 1.0), ("test", 1.0)],
        "split string, label double")
    row = evaluate.majority_baseline(df).first()
    assert row.majority_class == 0.0 and row.val_accuracy == 0.5
    assert (row.test_accuracy, row.test_f1, row.test_precision) == (0.0, 0.0, 0.0)


def test_zero_baseline(spark):
    df = spark.createDataFrame(
        [("train", 9.0), ("validation", 3.0), ("validation", -1.0), ("test", 2.0),
         ("test", 4.0)], "split string, label double")
    row = evaluate.zero_baseline(df).first()
    assert row.val_rmse == pytest.approx(5 ** 0.5) and row.val_mae == 2.0
    assert row.test_r2 == pytest.approx(1 - 20 / 2)


def test_leaderboard_and_best(spark):
    a = spark.createDataFrame(
        [("A", 0, 0.5, 0.1), ("A", 1, 0.7, 0.2), ("A", 2, 0.7, 0.3)],
        "model_name string, grid_index int, val_f1 double, val_accuracy double")
    b = spark.createDataFrame([("B", 1.0, 0.6), ("C", 0.0, None)],
                              "model_name string, majority_class double, val_f1 double")
    marked = report.mark_best(a, "val_f1", largest=True)
    both = report.combine_results(marked, b)
    board = report.leaderboard(both, report.CLASSIFICATION_ORDER).collect()
    assert [(r.model_name, r.grid_index) for r in board] == [
        ("A", 2), ("A", 1), ("B", None), ("A", 0), ("C", None)]
    # The first of equals is the best one.
    assert [r.grid_index for r in report.best_per_model(both).collect()] == [1]
    smallest = report.mark_best(a, "val_f1", largest=False).where("is_best").first()
    assert smallest.grid_index == 0
