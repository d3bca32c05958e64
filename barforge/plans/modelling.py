"""The modelling jobs from bars to a written leaderboard.

Bars come from ``load_stock_data`` or any table of the same columns. The model
frame is stored once by split in the shared folder; every fit reads from there.
"""

from typing import NamedTuple

from pyspark.ml import Model
from pyspark.sql import DataFrame, functions as F

from barforge.constants import FEATURES, FOLDS, LEGACY_FEATURES, MIN_ROWS, TRAIN_END, VAL_END
from barforge.functions.storage import stored
from barforge.operators import models
from barforge.operators.evaluate import class_report, majority_baseline, zero_baseline
from barforge.operators.prepare import prepare_classification, prepare_legacy, prepare_regression
from barforge.operators.report import (
    CLASSIFICATION_ORDER, CROSS_VALIDATION_ORDER, REGRESSION_ORDER, combine_results, leaderboard,
)
from barforge.operators.split import add_fold, add_hash_split, add_temporal_split
from barforge.sources.results import write_results


class Outcome(NamedTuple):
    """Leaderboard, folder it was written to, reports and models by model name."""

    leaderboard: DataFrame
    path: str
    reports: dict[str, DataFrame]
    best_models: dict[str, Model]


def _write(results: list[DataFrame], order, output_dir: str, name: str) -> tuple[DataFrame, str]:
    board = leaderboard(combine_results(*results), order)
    return board, write_results(board, output_dir, name)


def _vectors(frame: DataFrame, scale: bool) -> DataFrame:
    """The stored model frame as stored vectors."""
    return stored(models.with_vectors(frame, FEATURES, scale, ["split", "label"]), "vectors",
                  partition_by="split")


def classification_job(
    bars: DataFrame, output_dir: str, min_rows: int = MIN_ROWS,
    train_end: str = TRAIN_END, val_end: str = VAL_END, parallel: int = models.PARALLEL_FITS,
) -> Outcome:
    """Direction of the 20-row return: baseline, logistic regression, forest, boosting.

    ``parallel`` fits of a grid run side by side.
    """
    frame = stored(
        add_temporal_split(prepare_classification(bars, min_rows), train_end, val_end),
        "classification", partition_by="split")
    scaled, plain = _vectors(frame, scale=True), _vectors(frame, scale=False)
    searches = {
        "LogisticRegression": (models.logistic_grid(scaled, parallel=parallel), scaled),
        "RandomForestClassifier": (models.rf_classifier_grid(plain, parallel=parallel), plain),
        "GBTClassifier": (models.gbt_classifier_grid(plain, parallel=parallel), plain),
    }
    reports = {
        name: class_report(search.best_model.transform(table.where(F.col("split") != "train")))
        for name, (search, table) in searches.items()
    }
    results = [majority_baseline(frame), *(s.results for s, _ in searches.values())]
    board, path = _write(results, CLASSIFICATION_ORDER, output_dir, "classification_results")
    return Outcome(board, path, reports, {n: s.best_model for n, (s, _) in searches.items()})


def regression_job(
    bars: DataFrame, output_dir: str, min_rows: int = MIN_ROWS,
    train_end: str = TRAIN_END, val_end: str = VAL_END, forest: bool = False,
    parallel: int = models.PARALLEL_FITS,
) -> Outcome:
    """Size of the 20-row log return: baseline, two linear models, a forest on demand."""
    frame = stored(
        add_temporal_split(prepare_regression(bars, min_rows), train_end, val_end),
        "regression", partition_by="split")
    scaled = _vectors(frame, scale=True)
    searches = {
        "LinearRegression": models.linear_regression_grid(scaled, parallel=parallel),
        "GeneralizedLinearRegression": models.glr_grid(scaled, parallel=parallel),
    }
    if forest:
        searches["RandomForestRegressor"] = models.rf_regressor_grid(
            _vectors(frame, scale=False), parallel=parallel)
    results = [zero_baseline(frame), *(s.results for s in searches.values())]
    board, path = _write(results, REGRESSION_ORDER, output_dir, "regression_results")
    return Outcome(board, path, {}, {n: s.best_model for n, s in searches.items()})


def cross_validation_job(bars: DataFrame, output_dir: str,
                         parallel: int = models.PARALLEL_FITS) -> Outcome:
    """The early regression on seven features: hash split, three folds."""
    frame = stored(add_fold(add_hash_split(prepare_legacy(bars)), FOLDS), "cross-validation")
    searches = {
        "LinearRegression": models.linear_regression_cv(
            frame, LEGACY_FEATURES, parallel=parallel),
        "GeneralizedLinearRegression": models.glr_cv(
            frame, LEGACY_FEATURES, parallel=parallel),
    }
    results = [s.results for s in searches.values()]
    board, path = _write(results, CROSS_VALIDATION_ORDER, output_dir, "regression_results")
    return Outcome(board, path, {}, {n: s.best_model for n, s in searches.items()})
