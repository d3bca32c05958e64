import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import functions as F

from barforge import constants as K
from barforge.functions.storage import stored
from barforge.operators import evaluate, models, prepare, split
from tests.bars import frame, random_bars

FEATURES = ["ret_1", "ret_5", "vol_10", "DateDaySin"]


@pytest.fixture(scope="module")
def bars(spark):
    # Dates run from mid-2014 over both default cut-offs.
    return frame(spark, random_bars({s: 420 for s in "abcdef"}, seed=9)).cache()


@pytest.fixture(scope="module")
def table(spark, bars):
    df = split.add_temporal_split(prepare.prepare_classification(bars))
    return models.training_table(df, FEATURES, scale=True)


@pytest.fixture(scope="module")
def regression_table(spark, bars):
    df = split.add_temporal_split(prepare.prepare_regression(bars))
    return models.training_table(df, FEATURES, scale=True)


def test_grid_points_vary_the_last_parameter_fastest():
    assert models.grid_points({"a": [1, 2], "b": [3, 4]}) == [
        {"a": 1, "b": 3}, {"a": 1, "b": 4}, {"a": 2, "b": 3}, {"a": 2, "b": 4}]
    sizes = [len(models.grid_points(g)) for g in (
        K.LOGISTIC_GRID, K.RF_CLASSIFIER_GRID, K.GBT_CLASSIFIER_GRID, K.LINEAR_GRID, K.GLR_GRID,
        K.RF_REGRESSOR_GRID)]
    assert sizes == [6, 4, 4, 4, 15, 2]


def test_scaling_uses_training_rows_only(spark):
    pdf = pd.DataFrame({"split": ["train"] * 4 + ["test"], "label": 0.0,
                        "x": [1.0, 2.0, 3.0, 4.0, 100.0]})
    got = models.standard_scaled(spark.createDataFrame(pdf), ["x"], ["split"]).toPandas()
    train = pdf["x"][:4]
    np.testing.assert_allclose(sorted(got["x"]), (pdf["x"] - train.mean()) / train.std())


def test_logistic_grid(table):
    search = models.logistic_grid(table, {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 1.0]})
    rows = search.results.orderBy("grid_index").collect()
    assert len(rows) == 4 and sum(r.is_best for r in rows) == 1
    for r in rows:
        for name in ("accuracy", "f1", "precision", "recall", "auc"):
            assert 0 <= r[f"val_{name}"] <= 1 and 0 <= r[f"test_{name}"] <= 1
    best = next(r for r in rows if r.is_best)
    assert best.val_f1 == max(r.val_f1 for r in rows)
    # The kept model is the best row's, and its area equals MLlib's exact one.
    predicted = search.best_model.transform(table.where("split = 'validation'"))
    area = BinaryClassificationEvaluator(numBins=0).evaluate(predicted)
    assert best.val_auc == pytest.approx(area, rel=1e-9)
    report = evaluate.class_report(predicted).first()
    assert (report.tp + report.tn) / report.total == pytest.approx(best.val_accuracy)


def test_ties_keep_the_first_grid_point(table):
    search = models.logistic_grid(table, {"regParam": [5.0, 6.0], "elasticNetParam": [1.0]})
    assert [r.is_best for r in search.results.orderBy("grid_index").collect()] == [True, False]


def test_tree_grids_repeat_exactly(table):
    grid = {"numTrees": [3], "maxDepth": [2, 3]}
    a, b = (models.rf_classifier_grid(table, grid).results.orderBy("grid_index").collect()
            for _ in range(2))
    assert a == b and len(a) == 2
    boosted = models.gbt_classifier_grid(table, {"maxDepth": [2], "maxIter": [2, 3]})
    assert boosted.results.count() == 2


def test_regression_grids(regression_table):
    for search in (
        models.linear_regression_grid(regression_table),
        models.glr_grid(regression_table),
        models.rf_regressor_grid(regression_table, {"numTrees": [3], "maxDepth": [2, 3]}),
    ):
        rows = search.results.orderBy("grid_index").collect()
        assert sum(r.is_best for r in rows) == 1
        best = next(r for r in rows if r.is_best)
        assert best.val_rmse == min(r.val_rmse for r in rows)
        assert all(r.test_rmse > 0 and r.val_mae <= r.val_rmse for r in rows)


def test_every_glr_point_has_its_own_fit(regression_table, monkeypatch):
    fitted = []
    real = GeneralizedLinearRegression.fit
    monkeypatch.setattr(GeneralizedLinearRegression, "fit", lambda self, *a: fitted.append(
        (self.getRegParam(), self.getMaxIter())) or real(self, *a))
    rows = models.glr_grid(regression_table, parallel=1).results.orderBy("grid_index").collect()
    assert fitted == [(r.regParam, r.maxIter) for r in rows] and len(fitted) == 15
    assert rows[0].val_rmse != rows[3].val_rmse


def test_a_grid_is_scored_as_each_model_alone(table):
    later = table.where("split <> 'train'")
    train = table.where("split = 'train'").select("label", "features")
    points = models.grid_points({"regParam": [0.01, 0.1], "elasticNetParam": [0.0]})
    fits = models.fit_grid(LogisticRegression(maxIter=20), points, train, models.classification_scores(later), parallel=2)
    alone = [models.classification_scores(later)([f.model])[0] for f in fits]
    assert [f.metrics for f in fits] == [pytest.approx(m) for m in alone]
    assert fits[0].metrics != fits[1].metrics


def test_cross_validation_equals_a_plain_loop(spark, bars):
    df = split.add_fold(split.add_hash_split(prepare.prepare_legacy(bars)), K.FOLDS).cache()
    grid = {"regParam": [0.01, 0.1], "elasticNetParam": [0.5]}
    rows = models.linear_regression_cv(df, K.LEGACY_FEATURES, grid).results.orderBy(
        "grid_index").collect()
    assert sum(r.is_best for r in rows) == 1
    train = df.where("split = 'train'").toPandas()
    errors = []
    for fold in range(K.FOLDS):
        inner, held = train[train.fold != fold], train[train.fold == fold]
        mean, std = inner[K.LEGACY_FEATURES].mean(), inner[K.LEGACY_FEATURES].std()

        def vectors(part):
            scaled = ((part[K.LEGACY_FEATURES] - mean) / std).values
            from pyspark.ml.linalg import Vectors
            return spark.createDataFrame(
                [(Vectors.dense(x), float(y)) for x, y in zip(scaled, part["label"])],
                ["features", "label"])

        model = LinearRegression(maxIter=100, regParam=0.01, elasticNetParam=0.5).fit(
            vectors(inner))
        guess = model.transform(vectors(held)).agg(
            F.sqrt(F.mean((F.col("label") - F.col("prediction")) ** 2))).first()[0]
        errors.append(guess)
    assert rows[0].cv_rmse_avg == pytest.approx(np.mean(errors), rel=1e-6)
    many = models.glr_cv(df, K.LEGACY_FEATURES, {"regParam": [0.01], "maxIter": [50, 100]})
    assert [r.is_best for r in many.results.orderBy("grid_index").collect()] == [True, False]


def test_single_feature_line(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, 200)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "label": 3 * x + 1 + rng.normal(0, .1, 200)}))
    row = models.single_feature_line(df, "x").first()
    pdf = df.toPandas()
    slope, intercept = np.polyfit(pdf["x"], pdf["label"], 1)
    assert (row.slope, row.intercept) == (pytest.approx(slope), pytest.approx(intercept))


def test_narrow_vectors_are_dealt_to_tasks_by_rows(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "train").otherwise("test").alias("split"), F.lit(1.0).alias("x"))
    stored = df.coalesce(1)
    assert models.dealt(stored, 4000).rdd.getNumPartitions() == 1
    spread = models.dealt(stored, 500)
    sizes = spread.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) <= 600 and spread.count() == 4000


def test_fits_that_copy_their_rows_run_side_by_side_while_they_fit(spark):
    train = spark.range(1000)
    assert [models.side_by_side(4, train, most) for most in (10_000, 2500, 1000, 1)] == [4, 2, 1, 1]


def test_single_feature_line_reads_its_rows_once(spark, monkeypatch):
    names = []
    monkeypatch.setattr(models, "stored", lambda df, name: names.append((name, df.columns)) or stored(df, name))
    df = spark.range(20).selectExpr("id * 1D AS x", "id * 2D + 1 AS label", "id AS other")
    row = models.single_feature_line(df, "x").first()
    assert names == [("line", ["x", "label"])] and row.slope == pytest.approx(2)


def _plain_rows(spark, n=400):
    rng = np.random.default_rng(4)
    a, b = rng.normal(1000, 3, n), rng.normal(0, .01, n)
    pdf = pd.DataFrame({"a": a, "b": b, "c": 5.0, "d": 2 * a, "label": .3 * a - 40 * b + rng.normal(0, 1, n)})
    pdf["split"], pdf["fold"] = np.where(np.arange(n) % 5 < 3, "train", np.where(np.arange(n) % 5 == 3, "validation", "test")), np.arange(n) % 3
    return spark.createDataFrame(pdf).withColumn("fold", F.col("fold").cast("int")).repartition(5)


def test_moments_of_parts_are_those_of_all_rows(spark):
    df = _plain_rows(spark)
    columns = ["a", "b", "c", "label"]
    told = models.moments(df, F.array(*columns), ["split", "fold"])
    whole, pdf = models.merged(told.values()), df.toPandas()
    assert len(told) == 9 and whole.n == 400
    np.testing.assert_allclose(whole.mean, pdf[columns].mean(), rtol=1e-13)
    np.testing.assert_allclose(whole.products / 399, pdf[columns].cov(), rtol=1e-9, atol=1e-12)
    assert whole.deviations()[2] == 0 and models.moments(df.limit(0), F.array("a")) == {}


@pytest.mark.parametrize("estimator, points", [
    (lambda: LinearRegression(maxIter=100), {"regParam": [0.01, 0.5], "elasticNetParam": [0.5, 1.0]}),
    (lambda: GeneralizedLinearRegression(family="gaussian", link="identity"), {"regParam": [0.005, 2.0], "maxIter": [50]})])
def test_fits_on_moments_equal_fits_on_rows(spark, estimator, points):
    df, estimator = _plain_rows(spark), estimator()
    names = ["a", "b", "c", "d"]
    table = models.training_table(df, names, scale=True)
    train = table.where("split = 'train'").select("label", "features")
    points = models.grid_points(points)
    slow = models.fit_models(estimator, points, train)
    search = models.grid_search("m", estimator, {k: sorted({p[k] for p in points}) for k in points[0]},
                                models.scaled_frame(df, names), classification=False)
    fast = models.fit_models(estimator, points, models.scaled_frame(df, names).train_rows())
    for one, other in zip(slow, fast):
        np.testing.assert_allclose(one.coefficients.toArray(), other.coefficients.toArray(), rtol=1e-6, atol=1e-9)
        assert one.intercept == pytest.approx(other.intercept, rel=1e-9)
    want = models.regression_scores(table.where("split <> 'train'"))(slow)
    got = [r.asDict() for r in search.results.orderBy("grid_index").collect()]
    assert [{k: g[k] for k in w} for g, w in zip(got, want)] == [pytest.approx(w, rel=1e-8) for w in want]


def test_fits_of_a_grid_read_their_rows_once(spark, monkeypatch):
    seen = []
    real = models.moments
    monkeypatch.setattr(models, "moments", lambda df, *a: seen.append(df.count()) or real(df, *a))
    fitted = []
    fit = GeneralizedLinearRegression.fit
    monkeypatch.setattr(GeneralizedLinearRegression, "fit", lambda self, df: fitted.append(df.count()) or fit(self, df))
    df = _plain_rows(spark)
    models.glr_grid(models.scaled_frame(df, ["a", "b"]), {"regParam": [.1, .2, .3], "maxIter": [50]}, parallel=1)
    assert seen == [240] and fitted == [6, 6, 6]
    models.glr_cv(df, ["a", "b"], {"regParam": [.1], "maxIter": [50, 100]}, parallel=1)
    assert seen == [240, 240] and fitted[3:] == [6] * 8


def test_other_fits_and_flawed_rows_are_not_fitted_by_moments(spark):
    assert not models.fits_by_moments(LinearRegression(solver="l-bfgs"), 2)
    assert not models.fits_by_moments(LinearRegression(loss="huber"), 2)
    assert not models.fits_by_moments(GeneralizedLinearRegression(family="poisson"), 2)
    assert not models.fits_by_moments(LinearRegression(), models.MAX_MOMENT_COLUMNS + 1)
    assert models.fits_by_moments(LinearRegression(), 2) and models.fits_by_moments(GeneralizedLinearRegression(), 2)
    df = _plain_rows(spark).withColumn("label", F.when(F.col("b") > 0, F.lit(float("nan"))).otherwise(F.col("label")))
    with pytest.raises(ValueError, match="finite"):
        models.linear_regression_grid(models.scaled_frame(df, ["a", "b"]))
