"""Leaderboards over the small result frames of models and baselines."""

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

# --- fixed values: order of the leaderboards -------------------------------------
CLASSIFICATION_ORDER = [("val_f1", "desc"), ("val_accuracy", "desc")]
REGRESSION_ORDER = [("val_rmse", "asc"), ("test_rmse", "asc")]
CROSS_VALIDATION_ORDER = [("test_rmse", "asc")]


def combine_results(*results: DataFrame) -> DataFrame:
    """Stack results whose columns differ by model; what a model lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)


def leaderboard(results: DataFrame, order: list[tuple[str, str]]) -> DataFrame:
    """Best results first, missing metrics last."""
    return results.orderBy(*(
        F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last()
        for c, way in order))


def mark_best(results: DataFrame, metric: str, largest: bool) -> DataFrame:
    """Flag each model's best row as ``is_best``; ties go to the first grid row.

    One row per grid point and model, so the windows stay small.
    """
    by_metric = F.col(metric).desc_nulls_last() if largest else F.col(metric).asc_nulls_last()
    order = Window.partitionBy("model_name").orderBy(by_metric, "grid_index")
    return results.withColumn("is_best", F.row_number().over(order) == 1)


def best_per_model(results: DataFrame) -> DataFrame:
    return results.where("is_best")
