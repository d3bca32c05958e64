import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from barforge.functions.rolling import add_rolling
from barforge.functions.rounding import round_columns, rounded
from barforge.operators import features, models
from tests.bars import frame, random_bars


def by_day():
    return Window.partitionBy("Symbol").orderBy("Date")


def by_frames(df):
    """The same columns by window functions, frame by frame."""
    for add in (features.add_simple_returns, features.add_volatility, features.add_moving_averages,
                features.add_gap_open, features.add_volume_features, features.add_range_features):
        df = add(df, by_day())
    return df


def bits(df, columns):
    told = df.select("Symbol", "Date", *columns).collect()
    return sorted(tuple(x.hex() if isinstance(x, float) else x for x in r) for r in told)


@pytest.mark.parametrize("batch", ["7", "10000"])
@pytest.mark.parametrize("odd", [False, True])
def test_rolled_features_equal_window_functions_to_the_last_bit(spark, odd, batch):
    df = frame(spark, random_bars({"a": 150, "b": 1, "c": 2, "d": 61, "e": 5}, seed=3))
    if odd:
        place = F.pmod(F.xxhash64("Symbol", "Date"), F.lit(19))
        flaws = F.when(place == 1, None).when(place == 2, float("nan")).when(place == 3, 0.0).when(place == 4, float("inf"))
        df = df.withColumns({c: flaws.otherwise(F.col(c)) for c in ("Close", "Volume")})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        want = by_frames(df)
        columns = [c for c in want.columns if c not in df.columns]
        got = features.add_market_features(df, by_day())
        assert str(bits(got, columns)) == str(bits(want, columns))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_market_features_go_through_no_moving_frame(spark):
    df = frame(spark, random_bars({"a": 80}))
    plan = features.add_market_features(df, by_day())._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and " -59" not in plan and "stddev" not in plan


def test_rows_out_of_order_are_an_error(spark, monkeypatch):
    monkeypatch.setattr("barforge.functions.rolling.F.row_number", lambda: F.max(F.lit(3)))
    rolled = add_rolling(spark.range(3).withColumn("x", F.lit(1.0)), Window.partitionBy("x").orderBy("id"), ["x"], ["m"],
                         lambda x: {"m": x.mean(2)}, 2)
    with pytest.raises(Exception, match="not in the order"):
        rolled.collect()


def test_rounding_equals_round(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([
        rng.normal(0, 1, 2000), rng.normal(0, 1e5, 2000), np.round(rng.normal(0, 50, 2000), 7), rng.integers(-10**7, 10**7, 2000) / 2e6,
        rng.normal(0, 1e11, 300), rng.normal(0, 1e-6, 300),
        [0.0, -0.0, -1e-9, 0.5e-6, 1.5e-6, -2.5e-6, 1.0000005, 2.6750005, 1e16, 1e300, -1e300, 5e-324, np.nan, np.inf, -np.inf]])
    df = spark.createDataFrame(pd.DataFrame({"n": range(len(values)), "x": values})).withColumn(
        "y", F.when(F.col("n") % 3 > 0, F.col("x")))
    want = df.select("n", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))
    assert str(sorted(round_columns(df, ["x", "y"], 6).collect())) == str(sorted(want.collect()))
    assert str(rounded(np.array([-1e-9]), 6)[0]) == "0.0"


def test_standard_scaled_makes_no_vectors_and_refuses_missing_features(spark):
    pdf = pd.DataFrame({"split": ["train"] * 3 + ["test"], "x": [1.0, 2.0, 4.0, 3.0]})
    told = models.standard_scaled(spark.createDataFrame(pdf), ["x"], ["split"])
    assert "vector" not in told._jdf.queryExecution().optimizedPlan().toString().lower()
    missing = spark.createDataFrame(pdf).withColumn("x", F.when(F.col("split") == "train", F.col("x")))
    with pytest.raises(Exception, match="a feature is missing"):
        models.standard_scaled(missing, ["x"], ["split"]).collect()
