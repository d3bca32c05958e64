import pytest

from barforge import constants as K
from barforge.operators import models
from barforge.plans import exploration, modelling
from barforge.sources.results import read_results
from tests.bars import frame, random_bars


@pytest.fixture(scope="module")
def bars(spark):
    return frame(spark, random_bars({s: 420 for s in "abcd"}, seed=11)).cache()


def test_classification_job(spark, bars, tmp_path, monkeypatch):
    small = {
        "logistic_grid": {"regParam": [0.01], "elasticNetParam": [0.0, 0.5]},
        "rf_classifier_grid": {"numTrees": [2], "maxDepth": [2]},
        "gbt_classifier_grid": {"maxDepth": [2], "maxIter": [2]},
    }
    for name, grid in small.items():
        search = getattr(models, name)
        monkeypatch.setattr(models, name, lambda t, search=search, grid=grid, **options: search(t, grid, **options))
    outcome = modelling.classification_job(bars, str(tmp_path))
    board = read_results(spark, outcome.path).collect()
    assert len(board) == 5
    assert [r.val_f1 for r in board] == sorted((r.val_f1 for r in board), reverse=True)
    assert sum(r.is_best for r in board) == 4
    assert {r.model_name for r in board} == {"MajorityBaseline", *outcome.best_models}
    report = {r["split"]: r for r in outcome.reports["GBTClassifier"].collect()}
    best = next(r for r in board if r.model_name == "GBTClassifier")
    got = report["test"]
    assert (got.tp + got.tn) / got.total == pytest.approx(best.test_accuracy)


def test_regression_jobs(spark, bars, tmp_path):
    outcome = modelling.regression_job(bars, str(tmp_path))
    board = outcome.leaderboard.collect()
    assert len(board) == 1 + 4 + 15 and sum(r.is_best for r in board) == 3
    assert [r.val_rmse for r in board] == sorted(r.val_rmse for r in board)
    crossed = modelling.cross_validation_job(bars, str(tmp_path / "cv")).leaderboard.collect()
    assert len(crossed) == 4 + 15
    assert [r.test_rmse for r in crossed] == sorted(r.test_rmse for r in crossed)


def test_reports(spark, bars):
    for name, report in exploration.profile_reports(bars).items():
        assert report.count() > 0, name
    reports = exploration.split_reports(bars, minimums={"train": 10, "validation": 10, "test": 10})
    assert reports["label summary"].count() == 3
    assert reports["symbols per split"].count() == 3
    assert set(reports["coverage by history"].columns) >= {"threshold", "val_share"}
    assert [r.threshold for r in reports["coverage by history"].orderBy("threshold").collect()] == [
        *K.HISTORY_THRESHOLDS]
    assert reports["new symbols"].count() == 0
