import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier

from barforge.operators import models


def test_stages_of_one_boosting_equal_fits_of_their_own(spark, monkeypatch):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(1500, 3)), columns=["a", "b", "c"])
    pdf["label"] = (pdf.a * pdf.b + .5 * pdf.c + rng.normal(0, .5, 1500) > 0).astype(float)
    pdf["split"] = np.where(np.arange(1500) % 3 == 0, "test", "train")
    table = models.training_table(spark.createDataFrame(pdf).repartition(3), ["a", "b", "c"], scale=False)
    train = table.where("split = 'train'").select("label", "features")
    points = models.grid_points({"maxDepth": [2, 3], "maxIter": [2, 5, 3]})
    estimator = GBTClassifier(seed=42)
    alone = [estimator.copy({estimator.getParam(k): v for k, v in p.items()}).fit(train) for p in points]
    fitted, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: fitted.append((self.getMaxDepth(), self.getMaxIter())) or fit(self, df))
    shared = models.fit_models(estimator, points, train)
    assert sorted(fitted) == [(2, 5), (3, 5)]
    for one, other, point in zip(shared, alone, points):
        assert one.toDebugString.split("\n", 1)[1] == other.toDebugString.split("\n", 1)[1]
        assert one.treeWeights == other.treeWeights and one.getNumTrees == point["maxIter"] == one.getMaxIter()
        assert one.getMaxDepth() == point["maxDepth"] and one.numFeatures == 3
        later = table.where("split = 'test'")
        assert [r.rawPrediction for r in one.transform(later).collect()] == [r.rawPrediction for r in other.transform(later).collect()]
