"""Mergeable states (moments, sketches), drawdown episodes and grouping sets against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barforge.functions.moments import from_moments, merged_moments, moments
from barforge.functions.ranks import exact_quantiles
from barforge.functions.sketches import (
    QUANTILE_K, count_error, merged_sketches, rank_error, sketch_counts, sketch_quantiles, sketched,
)
from barforge.operators.episodes import drawdown_episodes
from barforge.operators.totals import TOTAL, grouped_totals
from tests.bars import frame, random_bars


def _values(offset, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({"g": rng.choice(["a", "b", "c"], n), "month": rng.integers(1, 7, n), "x": offset + rng.gamma(2.0, 3.0, n)})


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_moments_of_months_add_up(spark, offset):
    pdf = _values(offset)
    states = moments(frame(spark, pdf), "x", ["g", "month"])
    for merged, keys in ((merged_moments(states, ["g"]), ["g"]),
                         (merged_moments(merged_moments(states, ["month"])), []),
                         (merged_moments(merged_moments(states.orderBy(F.desc("month")), ["g"])), [])):
        for row in merged.select(*keys, "n", *from_moments()).collect():
            x = pdf[pdf.g == row.g].x if keys else pdf.x
            shifted = x - offset  # the same numbers without the offset
            assert row.n == len(x) and row.mean == pytest.approx(x.mean(), rel=1e-14)
            # With the offset, the inputs themselves have lost digits.
            tell = 1e-9 if not offset else 1e-5
            assert row.std == pytest.approx(shifted.std(), rel=tell)
            assert row.skewness == pytest.approx(shifted.skew(), rel=tell) and row.kurtosis == pytest.approx(shifted.kurt(), rel=tell)


def test_moments_of_few_and_missing_values(spark):
    rows = [("a", 1.0), ("a", None), ("b", float("nan")), ("c", 2.0), ("c", 4.0), (None, 5.0), ("d", 3.0), ("d", 3.0), ("d", 3.0), ("d", 3.0)]
    states = moments(spark.createDataFrame(rows, "g string, x double"), "x", ["g"])
    got = {r.g: r for r in states.select("g", "n", *from_moments()).collect()}
    assert {k: r.n for k, r in got.items()} == {"a": 1, "b": 0, "c": 2, None: 1, "d": 4}
    assert got["b"].mean is None and got["a"].std is None and got["c"].std == pytest.approx(2 ** 0.5)
    assert got["d"].std == 0 and got["d"].skewness is None and got["c"].skewness is None
    total = merged_moments(states).select("n", *from_moments()).first()
    assert (total.n, total.mean) == (8, 24 / 8) and merged_moments(states.limit(0)).first().n == 0


def test_sketches_of_months_merge_in_any_order(spark):
    pdf = _values(0.0, 40_000)
    pdf.loc[:50, "x"] = np.nan
    df = frame(spark, pdf).withColumn("id", F.floor(F.col("x") * 1000))
    states = sketched(df, ["g", "month"], ["x"], ["id", "month"], k=QUANTILE_K)
    probabilities = [0.01, 0.25, 0.5, 0.75, 0.99]
    clean = pdf.dropna()
    ids = np.floor(clean.x * 1000)
    for merged in (merged_sketches(states), merged_sketches(merged_sketches(states, ["g"])),
                   merged_sketches(merged_sketches(states.orderBy(F.desc("month")), ["month"]))):
        told = {r.probability: r.value for r in sketch_quantiles(merged, probabilities).collect()}
        for p, value in told.items():
            assert value in set(clean.x)  # a value of the data
            assert abs((clean.x <= value).mean() - p) <= rank_error()
        counts = sketch_counts(merged).first()
        assert abs(counts.id / ids.nunique() - 1) <= count_error() and counts.month == 6 and merged.first().n == 40_000


def test_sketched_ranks_hold_against_exact_quantiles(spark):
    pdf = _values(5.0, 20_000, seed=7)
    df = frame(spark, pdf)
    probabilities = [0.05, 0.5, 0.95]
    told = {(r.g, r.probability): r.value for r in sketch_quantiles(sketched(df, ["g"], ["x"]), probabilities, ["g"]).collect()}
    eps = rank_error()
    sides = exact_quantiles(df, ["x"], [p + s * eps for p in probabilities for s in (-1, 1)], ["g"]).collect()
    exact = {(r.g, round(r.probability, 9)): r.value for r in sides}
    for (g, p), value in told.items():
        assert exact[g, round(p - eps, 9)] <= value <= exact[g, round(p + eps, 9)]


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), (None, 1.0)], "g string, x double")
    states = sketched(df, ["g"], ["x"], ["x"])
    assert {r.g: r.x for r in sketch_counts(states, ["g"]).collect()} == {"a": 1, None: 1}  # NaN is a value to count
    assert [(r.g, r.value) for r in sketch_quantiles(states, [0.5], ["g"]).collect()] == [(None, 1.0)]
    assert sketch_quantiles(merged_sketches(states), [0.5]).first().value == 1.0
    none = merged_sketches(states.limit(0))
    assert sketch_quantiles(none, [0.5]).collect() == [] and sketch_counts(none).first().x == 0


def _episodes(pdf):
    """Row by row."""
    out = []
    for symbol, rows in pdf.sort_values(["Symbol", "Date"]).groupby("Symbol"):
        peak = None
        low = None
        for date, close in zip(rows.Date, rows.Close):
            if peak is None or close >= peak[1]:
                if low:
                    out.append((symbol, *peak, *low[:2], low[1] / peak[1] - 1, date, low[2]))
                peak, low = (date, close), None
            else:
                low = (low[0], low[1], low[2] + 1) if low and low[1] <= close else (date, close, low[2] + 1 if low else 1)
        if low:
            out.append((symbol, *peak, *low[:2], low[1] / peak[1] - 1, None, low[2]))
    return sorted(out, key=str)


@pytest.mark.parametrize("max_rows", [4, 9, 10 ** 6])
def test_episodes_equal_a_walk_through_the_history(spark, max_rows):
    pdf = random_bars({"a": 60, "b": 33, "c": 2}, seed=max_rows % 100)
    pdf["Close"] = (pdf.Close / 2).round() * 2  # ties and levels that come back
    got = drawdown_episodes(frame(spark, pdf), max_rows=max_rows)
    rows = sorted((tuple(r) for r in got.collect()), key=lambda r: str((r[0], pd.Timestamp(r[1]))))
    want = sorted(_episodes(pdf), key=lambda r: str((r[0], r[1])))
    assert len(rows) == len(want) > 4
    for a, b in zip(rows, want):
        assert a[0] == b[0] and [pd.Timestamp(a[i]) for i in (1, 3)] == [b[1], b[3]]
        assert (pd.Timestamp(a[6]) if a[6] else None) == b[6] and a[7] == b[7] and a[5] == pytest.approx(b[5])


def test_episodes_of_flat_and_missing_closes(spark):
    rows = [("a", "2020-01-0%d" % i, c) for i, c in enumerate([5.0, 5.0, None, float("nan"), 6.0], 1)] + [(None, "2020-01-01", 2.0), (None, "2020-01-02", 1.0),
                                                                                                       ("z", None, 1.0)]
    df = spark.createDataFrame(rows, "Symbol string, d string, Close double").selectExpr("Symbol", "cast(d as timestamp_ntz) as Date", "Close")
    got = drawdown_episodes(df).collect()
    assert [(r.Symbol, r.peak, r.trough, r.depth, r.recovery_date, r.n_rows) for r in got] == [(None, 2.0, 1.0, -0.5, None, 1)]
    assert drawdown_episodes(df.limit(0)).collect() == []


def test_totals_tell_missing_keys_from_totals(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), float(rng.randint(0, 3))) for _ in range(200)]
    df = spark.createDataFrame(rows, "a string, b int, v double")
    got = grouped_totals(df, ["a", "b"], [F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")]).collect()
    want = {}
    for a, b, v in rows:
        for level, key in ((0, (a, b)), (1, (a, None)), (2, (None, b)), (3, (None, None))):
            n, s = want.get((level, *key), (0, 0.0))
            want[level, *key] = n + 1, s + v
    assert {(r.level, r.a, r.b): (r.n, r.s) for r in got} == want and len(got) == len(want)
    named = grouped_totals(df, ["a", "b"], [F.count(F.lit(1)).alias("n")], named=True).collect()
    assert {(r.a, r.b) for r in named if r.level == 3} == {(TOTAL, TOTAL)}
    assert {(r.a, r.b) for r in named if r.level == 1} == {("x", TOTAL), ("y", TOTAL), (None, TOTAL)}
    only = grouped_totals(df, ["a", "b"], [F.count(F.lit(1)).alias("n")], sets=[["a"], []]).collect()
    assert sorted((r.level, r.n) for r in only)[-1] == (3, 200) and {r.level for r in only} == {1, 3}
    assert grouped_totals(df.limit(0), ["a"], [F.count(F.lit(1)).alias("n")]).collect() == []
