"""Fitting, tuning and scoring of MLlib models.

The vectors of the model frame are stored by split, scaled by one fit; fits and scores
read that table. All models of a grid are scored on both later splits in one pass.

Least squares (linear and gaussian models) see their rows only through the count, means and
covariances of features and label. Those are taken in one pass for all points of a grid
(and all folds); MLlib then fits each point on few weighted rows that have the same ones.
"""

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool
from operator import and_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    GeneralizedLinearRegression, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barforge.constants import (
    FOLDS, GBT_CLASSIFIER_GRID, GLR_GRID, LINEAR_GRID, LOGISTIC_GRID, MAX_ITER,
    RF_CLASSIFIER_GRID, RF_REGRESSOR_GRID, SEED,
)
from barforge.functions.ranks import area_under_roc
from barforge.functions.storage import stored
from barforge.operators.evaluate import (
    CLASSIFICATION_METRICS, REGRESSION_METRICS, classification_metrics, regression_metrics,
)
from barforge.operators.logistic import fit_grid_by_sums, fits_by_sums
from barforge.operators.report import mark_best

Grid = dict[str, list]
PARALLEL_FITS = 4
# Trees keep a copy of their training rows, some 500 bytes each: side by side, all copies have
# at most about this many rows. A larger one is alone.
MAX_COPIED_ROWS = 20_000_000
# A task of a fit has at most about this many rows, however few bytes they take when stored.
MAX_ROWS_PER_PART = 1_000_000
# Beyond that, logistic regressions share passes over the rows instead of a copy of them each.
MAX_LOGISTIC_ROWS = 1_000_000
# Wider vectors are fitted row by row: their covariances, a square matrix, are on the driver.
MAX_MOMENT_COLUMNS = 1_000


def grid_points(grid: Grid) -> list[dict]:
    """All combinations, the last parameter varying fastest."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


# --- moments ---------------------------------------------------------------------

class Moments(NamedTuple):
    """Count, means and sums of products of deviations of some columns."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    def deviations(self) -> np.ndarray:
        """Sample deviations; 0 for a single row."""
        return np.sqrt(np.diag(self.products) / max(1, self.n - 1))


def merged(parts: Iterable[Moments]) -> Moments | None:
    """Moments of all rows of ``parts``; None without rows."""
    out = None
    for part in parts:
        if out is None:
            out = part
            continue
        n, apart = out.n + part.n, part.mean - out.mean
        out = Moments(n, out.mean + apart * (part.n / n),
                      out.products + part.products + np.outer(apart, apart) * (out.n * part.n / n))
    return out


def moments(df: DataFrame, values: Column, by: Sequence[str] = ()) -> dict[tuple, Moments]:
    """Moments of an array of doubles per group of ``by``, few by nature; one pass, tasks emit sums alone."""
    by = list(by)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: dict[tuple, Moments] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            keys = list(zip(*(batch.column(c).to_pylist() for c in by))) or [()] * batch.num_rows
            places = {key: i for i, key in enumerate(dict.fromkeys(keys))}
            codes = np.fromiter(map(places.__getitem__, keys), np.int64, len(keys))
            for key, i in places.items():
                own = rows[codes == i] if len(places) > 1 else rows
                # About the first row: the moments of a constant are exact.
                away = own - own[0]
                shift = away.mean(axis=0)
                away -= shift
                part = Moments(len(own), own[0] + shift, away.T @ away)
                told[key] = merged([told[key], part]) if key in told else part
        yield pa.RecordBatch.from_pylist([
            {**dict(zip(by, key)), "n": m.n, "mean": m.mean.tolist(), "products": m.products.ravel().tolist()}
            for key, m in told.items()], schema)

    told = df.select(*by, values.alias("values"))
    types = [told.schema[c].dataType.simpleString() for c in by]
    arrow = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    schema = pa.schema([*((c, arrow[t]) for c, t in zip(by, types)), ("n", pa.int64()),
                        ("mean", pa.list_(pa.float64())), ("products", pa.list_(pa.float64()))])
    ddl = ", ".join([*(f"`{c}` {t}" for c, t in zip(by, types)), "n bigint, mean array<double>, products array<double>"])
    parts: dict[tuple, list[Moments]] = {}
    for r in told.mapInArrow(sums, ddl).collect():
        mean = np.array(r["mean"])
        parts.setdefault(tuple(r[c] for c in by), []).append(
            Moments(r["n"], mean, np.array(r["products"]).reshape(len(mean), -1)))
    return {key: merged(own) for key, own in parts.items()}


def moment_rows(spark: SparkSession, m: Moments) -> DataFrame:
    """(label, features, weight) with the moments ``m`` of features and, last, label.

    Two rows per principal axis of the standardised columns, as far to either side of the mean
    as gives the axis its variance, share the weight of all rows.
    """
    if not (np.isfinite(m.mean).all() and np.isfinite(m.products).all()):
        raise ValueError("features and labels must be finite numbers")
    spread = np.sqrt(np.diag(m.products) / m.n)
    unit = np.where(spread > 0, spread, 1.0)
    along, axes = np.linalg.eigh(m.products / m.n / np.outer(unit, unit))
    steps = np.sqrt(np.clip(along, 0, None) * len(along)) * axes * spread[:, None]
    rows = np.concatenate([m.mean + steps.T, m.mean - steps.T])
    table = pa.table({"label": rows[:, -1], "values": pa.array(rows[:, :-1].tolist(), pa.list_(pa.float64())),
                      "weight": np.full(len(rows), m.n / len(rows))})
    return spark.createDataFrame(table).coalesce(1).select(
        "label", array_to_vector("values").alias("features"), "weight")


def fits_by_moments(estimator: Estimator, columns: int) -> bool:
    """Whether a fit depends on the moments of its rows alone: unweighted least squares, solved by normal equations."""
    if columns > MAX_MOMENT_COLUMNS or estimator.isDefined("weightCol"):
        return False
    if isinstance(estimator, LinearRegression):
        return estimator.getSolver() in ("auto", "normal") and estimator.getLoss() == "squaredError"
    return (isinstance(estimator, GeneralizedLinearRegression) and estimator.getFamily() == "gaussian"
            and (not estimator.isDefined("link") or estimator.getLink() == "identity")
            and not estimator.isDefined("offsetCol"))


# --- vectors ---------------------------------------------------------------------

def _scaling(m: Moments | None) -> tuple[np.ndarray, np.ndarray]:
    """Means and factors that standardise; a constant becomes 0."""
    if m is None:
        raise ValueError("no training rows to scale by")
    with np.errstate(divide="ignore"):
        factors = 1 / m.deviations()
    return m.mean, np.where(np.isinf(factors), 0.0, factors)


def _features_of(m: Moments | None) -> Moments | None:
    """Moments without the last column, the label."""
    return m and Moments(m.n, m.mean[:-1], m.products[:-1, :-1])


def _scaled(m: Moments) -> Moments:
    """Moments once all columns but the label are standardised by themselves."""
    means, factors = _scaling(_features_of(m))
    away, stretch = np.append(means, 0.0), np.append(factors, 1.0)
    return Moments(m.n, (m.mean - away) * stretch, m.products * np.outer(stretch, stretch))


def _doubles(columns: Sequence[str]) -> Column:
    return F.array(*(F.col(c).cast("double") for c in columns))


def _features_and_label(features: list[str]) -> Column:
    return _doubles([*features, "label"])


def _vectors(df: DataFrame, features: list[str], keep: list[str],
             scaling: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``features`` as one vector, less means and times factors if given."""
    if scaling:
        df = df.select(*keep, *(
            ((F.col(c) - float(mean)) * float(factor)).alias(f"scaled_{i}")
            for i, (c, mean, factor) in enumerate(zip(features, *scaling))))
        features = [f"scaled_{i}" for i in range(len(features))]
    return VectorAssembler(inputCols=features, outputCol="features").transform(df).select(*keep, "features")


def with_vectors(df: DataFrame, features: list[str], scale: bool, keep: list[str]) -> DataFrame:
    """``features`` as one vector, standardised by mean and sample deviation of the training rows if asked."""
    if not scale:
        return _vectors(df, features, keep)
    told = moments(df.where(F.col("split") == "train"), _doubles(features))
    return _vectors(df, features, keep, _scaling(told.get(())))


def standard_scaled(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Features standardised by mean and sample deviation of the training rows; missing ones are an error."""
    told = moments(df.where(F.col("split") == "train"), _doubles(features))
    sound = reduce(and_, (F.col(c).isNotNull() & ~F.isnan(c) for c in features))
    checked = df.where(F.assert_true(sound, F.lit("a feature is missing")).isNull())
    return checked.select(*keep, *(
        ((F.col(c) - float(mean)) * float(factor)).alias(c) for c, mean, factor in zip(features, *_scaling(told.get(())))))


def training_table(df: DataFrame, features: list[str], scale: bool) -> DataFrame:
    """Vectors and labels of ``df`` stored in the shared folder by split.

    The windows behind ``df`` run once, for the first write. Vectors to be scaled need the
    training rows' moments first: their features are stored, then the scaled vectors.
    """
    keep = ["split", "label"]
    if not scale:
        return dealt(stored(_vectors(df, features, keep), "vectors", partition_by="split"))
    frame = stored(df.select(*keep, *features), "training", partition_by="split")
    return dealt(stored(with_vectors(frame, features, scale, keep), "vectors", partition_by="split"))


class ScaledFrame(NamedTuple):
    """Stored features by split with the training rows' moments, label last: for least squares and large logistic
    regressions, which need no vectors of their training rows."""

    frame: DataFrame
    features: list[str]
    train: Moments | None

    def vectors(self, rows: Column) -> DataFrame:
        """Split, label and scaled vectors of some rows. They are picked first: nothing else is assembled."""
        return _vectors(self.frame.where(rows), self.features, ["split", "label"], _scaling(_features_of(self.train)))

    def train_rows(self) -> DataFrame:
        """Weighted rows with the moments of the scaled training rows."""
        return moment_rows(self.frame.sparkSession, _scaled(self.train))

    def shares_passes(self, estimator: Estimator) -> bool:
        """Whether fits are logistic ones of many rows, of both classes."""
        return (self.train is not None and self.train.n > MAX_LOGISTIC_ROWS and 0 < self.train.mean[-1] < 1
                and fits_by_sums(estimator, len(self.features)))

    def logistic_models(self, estimator: LogisticRegression, points: Sequence[dict]) -> list[Model]:
        """A model per grid point from shared passes over the training rows."""
        return fit_grid_by_sums(
            estimator, points, self.frame.where(F.col("split") == "train"), _features_and_label(self.features),
            _scaling(_features_of(self.train)), self.train.mean[-1])


def scaled_frame(df: DataFrame, features: list[str]) -> ScaledFrame:
    """``df`` for linear models: one write, one pass for the moments."""
    frame = stored(df.select("split", "label", *features), "training", partition_by="split")
    told = moments(frame.where(F.col("split") == "train"), _features_and_label(features))
    return ScaledFrame(frame, features, told.get(()))


def dealt(table: DataFrame, max_rows: int = MAX_ROWS_PER_PART) -> DataFrame:
    """``table``, spread out where a scan would give a task more than ``max_rows`` rows on average.

    Scans deal out bytes: a column of two values takes next to none, and few tasks would get all rows.
    """
    parts = -(-table.count() // max_rows)
    return table.repartition(parts) if table.rdd.getNumPartitions() < parts else table


def side_by_side(parallel: int, train: DataFrame, max_rows: int = MAX_COPIED_ROWS) -> int:
    """How many fits that each copy ``train`` run at a time, ``parallel`` at most."""
    return max(1, min(parallel, max_rows // max(1, train.count())))


# --- grids -----------------------------------------------------------------------

class Fit(NamedTuple):
    """One grid point with its model and metrics."""

    point: dict
    model: Model
    metrics: dict


Score = Callable[[Sequence[Model]], list[dict]]


def fit_models(estimator: Estimator, points: Sequence[dict], train: DataFrame,
               parallel: int = PARALLEL_FITS) -> list[Model]:
    """A model per grid point, in grid order; ``parallel`` fits run side by side,
    each with its own copy of the training rows where the algorithm keeps one.

    Points of boosted trees that differ in iterations alone are stages of one boosting, which is run once."""
    def run(point: dict) -> Model:
        settings = {estimator.getParam(name): value for name, value in point.items()}
        return estimator.copy(settings).fit(train)

    if "weight" in train.columns:
        estimator = estimator.copy({estimator.getParam("weightCol"): "weight"})
    longest = [_longest(estimator, point, points) for point in points]
    own = [point for i, point in enumerate(longest) if point not in longest[:i]]
    with ThreadPool(max(1, min(parallel, len(own)))) as pool:
        fitted = pool.map(inheritable_thread_target(train.sparkSession)(run), own)
    return [model if long == point else first_trees(estimator, point, model) for point, long, model in (
        (point, long, fitted[own.index(long)]) for point, long in zip(points, longest))]


def _longest(estimator: Estimator, point: dict, points: Sequence[dict]) -> dict:
    """The point whose boosting goes through that of ``point``: the same but for more iterations."""
    if not isinstance(estimator, GBTClassifier) or "maxIter" not in point or estimator.isDefined("validationIndicatorCol"):
        return point
    return max((p for p in points if {**p, "maxIter": 0} == {**point, "maxIter": 0}), key=lambda p: p["maxIter"])


def first_trees(estimator: GBTClassifier, point: dict, model: GBTClassificationModel) -> GBTClassificationModel:
    """The model of ``point`` from one boosted further: a tree depends on those before it alone, and on its number."""
    own = estimator.copy({estimator.getParam(name): value for name, value in point.items()})
    gateway, java, count = SparkContext._gateway, model._java_obj, min(own.getMaxIter(), model.getNumTrees)
    made = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, count)
    weights = gateway.new_array(gateway.jvm.double, count)
    every = java.trees()
    for i in range(count):
        trees[i], weights[i] = every[i], model.treeWeights[i]
    return own._copyValues(GBTClassificationModel(made(own.uid, trees, weights, model.numFeatures, model.numClasses)))


def _by_moments(estimator: Estimator, train: DataFrame) -> DataFrame:
    """``train``, or few weighted rows of its moments where fits need no more."""
    first = train.select(F.size(vector_to_array("features")).alias("columns")).first()
    if first is None or not fits_by_moments(estimator, first["columns"]):
        return train
    label = F.array(F.col("label").cast("double"))
    told = moments(train, F.concat(vector_to_array("features"), label))
    return moment_rows(train.sparkSession, told[()])


def _predicted(models: Sequence[Model], later: DataFrame, raw: bool) -> DataFrame:
    """(grid_index, split, label, prediction, score) of every model on every row, in one pass."""
    df, told = later, []
    for i, model in enumerate(models):
        named = model.copy({model.getParam("predictionCol"): f"p_{i}"})
        entry = [F.lit(i).alias("grid_index"), F.col(f"p_{i}").alias("prediction")]
        if raw:
            named = named.copy({named.getParam("rawPredictionCol"): f"r_{i}",
                                named.getParam("probabilityCol"): ""})
            entry.append(vector_to_array(f"r_{i}")[1].alias("score"))
        df = named.transform(df)
        told.append(F.struct(*entry))
    return df.select("split", "label", F.inline(F.array(*told)))


def _side_by_side(rows: list[dict], count: int, names: Sequence[str]) -> list[dict]:
    """Metrics of the later splits as val_* and test_* values, by grid point."""
    sides = {"validation": "val", "test": "test"}
    out: list[dict] = [{} for _ in range(count)]
    for r in rows:
        out[r["grid_index"]] |= {f"{sides[r['split']]}_{name}": r[name] for name in names}
    return out


BY = ("grid_index", "split")


def classification_scores(later: DataFrame) -> Score:
    """Metrics of classifiers on the later splits: one scoring pass, one aggregation for
    the metrics and one tally of scores for the areas, whatever the number of models."""
    def score(models: Sequence[Model]) -> list[dict]:
        predicted = stored(_predicted(models, later, raw=True), "predicted")
        areas = area_under_roc(predicted, "score", by=BY)
        rows = classification_metrics(predicted, BY).join(areas, list(BY)).collect()
        return _side_by_side([r.asDict() for r in rows], len(models), (*CLASSIFICATION_METRICS, "auc"))

    return score


def regression_scores(later: DataFrame) -> Score:
    """Metrics of regressors on the later splits in one aggregation."""
    def score(models: Sequence[Model]) -> list[dict]:
        rows = regression_metrics(_predicted(models, later, raw=False), BY).collect()
        return _side_by_side([r.asDict() for r in rows], len(models), REGRESSION_METRICS)

    return score


def scored(points: Sequence[dict], models: Sequence[Model], score: Score) -> list[Fit]:
    """Grid points with their models, all scored together."""
    return [Fit(*parts) for parts in zip(points, models, score(models))]


def fit_grid(estimator: Estimator, points: Sequence[dict], train: DataFrame, score: Score,
             parallel: int = PARALLEL_FITS) -> list[Fit]:
    """A fit per grid point, all scored together."""
    return scored(points, fit_models(estimator, points, train, parallel), score)


def _results(spark: SparkSession, name: str, fits: list[Fit], metrics: list[str],
             extra: list[dict] | None = None) -> DataFrame:
    """Result rows: model, grid position, parameters, metrics."""
    extra = extra or [{}] * len(fits)
    parameters = list(fits[0].point)
    rows = [
        {"model_name": name, "grid_index": i, **fit.point, **fit.metrics, **more}
        for i, (fit, more) in enumerate(zip(fits, extra))
    ]
    numbers = [*fits[0].point, *metrics]
    schema = pa.schema([("model_name", pa.string()), ("grid_index", pa.int32()),
                        *((c, pa.float64()) for c in numbers)])
    # A row per grid point. Arrow rows need no Python worker to be read.
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema))


def _val_test(names: Sequence[str]) -> list[str]:
    return [f"{side}_{name}" for side in ("val", "test") for name in names]


class Search(NamedTuple):
    """Result rows of a grid search (best one flagged) and the best model."""

    results: DataFrame
    best_model: Model


def grid_search(
    name: str, estimator: Estimator, grid: Grid, table: DataFrame | ScaledFrame,
    classification: bool, parallel: int = PARALLEL_FITS, copies: bool = False,
) -> Search:
    """Fit every grid point on the training rows, score the later splits.

    The best is the largest validation F1 or the smallest validation RMSE. ``copies`` tells
    that each fit holds the training rows: fewer run at a time if there are many rows. Least
    squares are fitted on rows of equal moments; a training summary of theirs tells of those.
    Logistic regressions of many rows in a ``ScaledFrame`` share passes over them.
    """
    is_train, points = F.col("split") == "train", grid_points(grid)
    scores = classification_scores if classification else regression_scores
    if isinstance(table, ScaledFrame):
        later = table.vectors(~is_train)
    else:
        later = table.where(~is_train)
    if isinstance(table, ScaledFrame) and table.shares_passes(estimator):
        fits = scored(points, table.logistic_models(estimator, points), scores(later))
    else:
        if not isinstance(table, ScaledFrame):
            train = _by_moments(estimator, table.where(is_train).select("label", "features"))
        elif fits_by_moments(estimator, len(table.features)):
            train = table.train_rows()
        else:
            train = dealt(stored(table.vectors(is_train).select("label", "features"), "vectors"))
        if copies:
            parallel = side_by_side(parallel, train)
        fits = fit_grid(estimator, points, train, scores(later), parallel)
    if classification:
        names, metric = (*CLASSIFICATION_METRICS, "auc"), "val_f1"
    else:
        names, metric = REGRESSION_METRICS, "val_rmse"
    results = mark_best(
        _results(later.sparkSession, name, fits, _val_test(names)), metric, classification)
    pick = max if classification else min  # the first of equals, as in mark_best
    told = [fit for fit in fits if fit.metrics.get(metric) is not None]
    best = pick(told, key=lambda fit: fit.metrics[metric]) if told else fits[0]
    return Search(results, best.model)


# --- the models ------------------------------------------------------------------
# Linear models take a table of scaled vectors, trees one of plain vectors.

def logistic_grid(table: DataFrame | ScaledFrame, grid: Grid = LOGISTIC_GRID,
                  parallel: int = PARALLEL_FITS) -> Search:
    return grid_search("LogisticRegression", LogisticRegression(maxIter=MAX_ITER), grid,
                       table, classification=True, parallel=parallel)


def rf_classifier_grid(table: DataFrame, grid: Grid = RF_CLASSIFIER_GRID,
                       parallel: int = PARALLEL_FITS) -> Search:
    return grid_search("RandomForestClassifier", RandomForestClassifier(seed=SEED), grid,
                       table, classification=True, parallel=parallel, copies=True)


def gbt_classifier_grid(table: DataFrame, grid: Grid = GBT_CLASSIFIER_GRID,
                        parallel: int = PARALLEL_FITS) -> Search:
    return grid_search("GBTClassifier", GBTClassifier(seed=SEED), grid,
                       table, classification=True, parallel=parallel, copies=True)


def linear_regression_grid(table: DataFrame | ScaledFrame, grid: Grid = LINEAR_GRID,
                           parallel: int = PARALLEL_FITS) -> Search:
    return grid_search("LinearRegression", LinearRegression(maxIter=MAX_ITER), grid,
                       table, classification=False, parallel=parallel)


def _gaussian() -> Estimator:
    return GeneralizedLinearRegression(family="gaussian", link="identity")


def glr_grid(table: DataFrame | ScaledFrame, grid: Grid = GLR_GRID,
             parallel: int = PARALLEL_FITS) -> Search:
    return grid_search("GeneralizedLinearRegression", _gaussian(), grid,
                       table, classification=False, parallel=parallel)


def rf_regressor_grid(table: DataFrame, grid: Grid = RF_REGRESSOR_GRID,
                      parallel: int = PARALLEL_FITS) -> Search:
    return grid_search("RandomForestRegressor", RandomForestRegressor(seed=SEED), grid,
                       table, classification=False, parallel=parallel, copies=True)


# --- cross-validation ------------------------------------------------------------

def cross_validate(
    name: str, estimator: Estimator, grid: Grid, df: DataFrame, features: list[str],
    folds: int = FOLDS, parallel: int = PARALLEL_FITS,
) -> Search:
    """K-fold RMSE of each grid point on the training rows, then test metrics.

    ``df`` has the features, ``label``, ``split`` (train / test) and ``fold``.
    Vectors are scaled anew from the training part of every fold. Best is the
    smallest average RMSE. The fold is a hash of the row's key, so the folds do
    not move when the data is partitioned differently.

    One pass takes the moments of every fold; those of a training part, merged, scale its
    vectors and stand for its rows where the estimator needs no more.
    """
    points = grid_points(grid)
    inner = df.where(F.col("split") == "train")
    told = moments(inner, _features_and_label(features), ["fold"])

    def fitted(train: DataFrame, own: Moments | None, later: DataFrame, side: str) -> list[Fit]:
        scaling = _scaling(_features_of(own))
        if fits_by_moments(estimator, len(features)):
            rows = moment_rows(df.sparkSession, _scaled(own))
        else:
            rows = stored(_vectors(train, features, ["label"], scaling), "fold")
        vectors = _vectors(later.withColumn("split", F.lit(side)), features, ["split", "label"], scaling)
        return fit_grid(estimator, points, rows, regression_scores(vectors), parallel)

    sums = [0.0] * len(points)
    for fold in range(folds):
        mine = F.col("fold") == fold
        own = merged(m for (key,), m in told.items() if key != fold)
        fits = fitted(inner.where(~F.coalesce(mine, F.lit(False))), own, inner.where(mine), "validation")
        sums = [s + fit.metrics["val_rmse"] for s, fit in zip(sums, fits)]

    fits = fitted(inner, merged(told.values()), df.where(F.col("split") == "test"), "test")
    averages = [{"cv_rmse_avg": s / folds} for s in sums]
    columns = ["cv_rmse_avg", *(f"test_{m}" for m in REGRESSION_METRICS)]
    results = mark_best(
        _results(df.sparkSession, name, fits, columns, averages), "cv_rmse_avg", largest=False)
    return Search(results, fits[sums.index(min(sums))].model)


def linear_regression_cv(df: DataFrame, features: list[str], grid: Grid = LINEAR_GRID,
                         parallel: int = PARALLEL_FITS) -> Search:
    return cross_validate("LinearRegression", LinearRegression(maxIter=MAX_ITER), grid,
                          df, features, parallel=parallel)


def glr_cv(df: DataFrame, features: list[str], grid: Grid = GLR_GRID,
           parallel: int = PARALLEL_FITS) -> Search:
    return cross_validate("GeneralizedLinearRegression", _gaussian(), grid,
                          df, features, parallel=parallel)


def single_feature_line(df: DataFrame, feature: str) -> DataFrame:
    """Slope and intercept of an unregularised linear model of one feature.

    The fit reads its rows several times: they are stored, so that the windows behind ``df`` run once.
    """
    vectors = VectorAssembler(inputCols=[feature], outputCol="features").transform(
        stored(df.select(feature, "label"), "line"))
    model = LinearRegression(solver="normal").fit(vectors)
    return df.sparkSession.createDataFrame(pa.table({
        "feature": [feature], "slope": [float(model.coefficients[0])],
        "intercept": [float(model.intercept)]}))
