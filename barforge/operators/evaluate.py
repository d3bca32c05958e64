"""Metrics, baselines and reports from frames with label and prediction.

Each works on all splits at once: one aggregation that combines before the
shuffle, instead of a pass per metric and split.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def regression_metrics(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """Root mean squared error, mean absolute error and R2."""
    error = F.col("label") - F.col("prediction")
    n = F.count(error)
    squared = F.sum(error * error)
    return df.groupBy(*by).agg(
        F.sqrt(squared / n).alias("rmse"), F.mean(F.abs(error)).alias("mae"),
        (1 - F.try_divide(squared, n * F.var_pop("label"))).alias("r2"))


def confusion_matrix(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """Rows per label and prediction, long form."""
    return df.groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("rows"))


def binary_counts(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """The four cells of the binary confusion matrix, side by side."""
    cells = {"tn": (0.0, 0.0), "fp": (0.0, 1.0), "fn": (1.0, 0.0), "tp": (1.0, 1.0)}
    return df.groupBy(*by).agg(*(
        F.count_if((F.col("label") == label) & (F.col("prediction") == guess)).alias(name)
        for name, (label, guess) in cells.items()))


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _class_scores(hit: str, missed: str, wrong: str) -> tuple[Column, Column, Column]:
    precision = _share(F.col(hit), F.col(hit) + F.col(wrong))
    recall = _share(F.col(hit), F.col(hit) + F.col(missed))
    return precision, recall, _share(2 * precision * recall, precision + recall)


def classification_metrics(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """Accuracy and label-weighted F1, precision and recall of 0/1 predictions."""
    ones = F.col("tp") + F.col("fn")
    zeros = F.col("tn") + F.col("fp")
    scores_1 = _class_scores("tp", "fn", "fp")
    scores_0 = _class_scores("tn", "fp", "fn")
    precision, recall, f1 = (
        (a * ones + b * zeros) / (ones + zeros) for a, b in zip(scores_1, scores_0))
    return binary_counts(df, by).select(
        *by, ((F.col("tp") + F.col("tn")) / (ones + zeros)).alias("accuracy"),
        f1.alias("f1"), precision.alias("precision"), recall.alias("recall"))


def class_report(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """Predicted class shares, confusion cells, per-class scores, balanced accuracy."""
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    positives, negatives = F.col("tp") + F.col("fp"), F.col("tn") + F.col("fn")
    p1, r1, f1 = _class_scores("tp", "fn", "fp")
    p0, r0, f0 = _class_scores("tn", "fp", "fn")
    return binary_counts(df, by).select(
        *by, total.alias("total"),
        positives.alias("predicted_positive"), _share(positives, total).alias("positive_pct"),
        negatives.alias("predicted_negative"), _share(negatives, total).alias("negative_pct"),
        "tn", "fp", "fn", "tp",
        p1.alias("precision_1"), r1.alias("recall_1"), f1.alias("f1_1"),
        p0.alias("precision_0"), r0.alias("recall_0"), f0.alias("f1_0"),
        ((r0 + r1) / 2).alias("balanced_accuracy"))


def val_test_columns(metrics: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per key: metrics of the two later splits as val_* and test_*."""
    sides = {"val": "validation", "test": "test"}
    return metrics.groupBy(*keys).agg(*(
        F.max(F.when(F.col("split") == split, F.col(name))).alias(f"{side}_{name}")
        for side, split in sides.items() for name in names))


REGRESSION_METRICS = ("rmse", "mae", "r2")
CLASSIFICATION_METRICS = ("accuracy", "f1", "precision", "recall")


def zero_baseline(df: DataFrame) -> DataFrame:
    """Result row of always predicting a return of 0."""
    guessed = df.withColumn("prediction", F.lit(0.0)).withColumn(
        "model_name", F.lit("ZeroBaseline"))
    metrics = regression_metrics(
        guessed.where(F.col("split") != "train"), ["model_name", "split"])
    return val_test_columns(metrics, REGRESSION_METRICS, ["model_name"]).withColumn(
        "is_best", F.lit(True))


def majority_baseline(df: DataFrame) -> DataFrame:
    """Result row of always predicting the larger class of the training rows.

    One pass counts the labels of each split; the rest is arithmetic on those
    few counts. A tie predicts 1.
    """
    counts = df.groupBy("split").agg(
        F.count_if(F.col("label") == 1.0).alias("ones"),
        F.count_if(F.col("label") == 0.0).alias("zeros"))
    rises = F.max(F.when(F.col("split") == "train", F.col("ones") >= F.col("zeros")))
    sides = {"val": "validation", "test": "test"}
    collected = counts.agg(rises.alias("rises"), *(
        F.sum(F.when(F.col("split") == split, F.col(c))).alias(f"{side}_{c}")
        for side, split in sides.items() for c in ("ones", "zeros")))
    columns = []
    for side in sides:
        ones, zeros = F.col(f"{side}_ones"), F.col(f"{side}_zeros")
        # A constant prediction is right for the share p of its class: accuracy and
        # weighted recall p, weighted precision p squared, weighted F1 p * 2p / (1 + p).
        p = F.try_divide(F.when(F.col("rises"), ones).otherwise(zeros), ones + zeros)
        columns += [p.alias(f"{side}_accuracy"), (p * 2 * p / (1 + p)).alias(f"{side}_f1"),
                    (p * p).alias(f"{side}_precision"), p.alias(f"{side}_recall")]
    return collected.select(
        F.lit("MajorityBaseline").alias("model_name"),
        F.when(F.col("rises"), 1.0).otherwise(0.0).alias("majority_class"),
        *columns, F.lit(True).alias("is_best"))
