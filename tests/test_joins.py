"""As-of joins, range joins and sessions against brute force."""

import datetime as dt
import random

import pytest

from barforge.operators.asof import asof_join
from barforge.operators.sessions import add_sessions, session_windows
from barforge.operators.spans import range_join

DAY = dt.datetime(2020, 1, 1)


def at(minutes):
    return None if minutes is None else DAY + dt.timedelta(minutes=minutes)


def _trades(seed, n=120, keys=("a", "b", None)):
    rng = random.Random(seed)
    return [(rng.choice(keys) if rng.random() < 0.3 else "a", None if rng.random() < 0.05 else rng.randint(0, 60), i) for i in range(n)]


def _asof(left, right, strict, forward, tolerance):
    out = []
    for k, t, v in left:
        able = [(u, w) for j, u, w in right if None not in (k, t, j, u) and j == k and (
            (u > t or u == t and not strict) if forward else (u < t or u == t and not strict))]
        best = (min if forward else max)(able, default=None)
        if best and tolerance is not None and abs(best[0] - t) > tolerance:
            best = None
        out.append((k, t, v, *(best or (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("max_rows", [5, 10 ** 6])
@pytest.mark.parametrize("strict,forward,tolerance", [(False, False, None), (True, False, None), (False, True, None), (True, True, 3), (False, False, 1)])
def test_asof_equals_brute_force(spark, max_rows, strict, forward, tolerance):
    left, right = _trades(1), _trades(2, 90)
    frame = lambda rows: spark.createDataFrame(rows, "k string, t int, v int")
    got = asof_join(frame(left), frame(right), "t", ["k"], strict=strict, forward=forward, tolerance=tolerance, max_rows=max_rows)
    assert got.columns == ["k", "t", "v", "t_matched", "v_right"]
    assert sorted(map(tuple, got.collect()), key=str) == _asof(left, right, strict, forward, tolerance)


def test_asof_of_times_without_keys_and_of_empty_tables(spark):
    left = spark.createDataFrame([(at(m), m) for m in (0, 7, 90, None)], "t timestamp_ntz, x int")
    right = spark.createDataFrame([(at(m), str(m)) for m in (5, 6, 80)], "t timestamp_ntz, y string")
    told = {r.x: r.y for r in asof_join(left, right, "t", tolerance="INTERVAL 5 MINUTES").collect()}
    assert told == {0: None, 7: "6", 90: None, None: None}
    assert {r.x: r.y for r in asof_join(left, right, "t", max_rows=2).collect()} == {0: None, 7: "6", 90: "80", None: None}
    assert asof_join(left, right.limit(0), "t").where("y is null").count() == 4
    assert asof_join(left.limit(0), right, "t").collect() == []
    only = asof_join(left.select("t"), right.select("t"), "t")
    assert only.columns == ["t", "t_matched"] and only.where("t_matched is not null").count() == 2


def test_a_hot_key_of_an_asof_join_is_spread(spark):
    """Ten times ``max_rows``: blocks, none with more rows, and no window over the whole key."""
    left = spark.range(0, 40_000, 2).selectExpr("1 as k", "id as t")
    right = spark.range(0, 40_000, 10).selectExpr("1 as k", "id as t", "id as v")
    got = asof_join(left, right, "t", ["k"], max_rows=2400)
    assert got.where("v = t - t % 10").count() == 20_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "block" in plan and "CartesianProduct" not in plan


def _spans(seed, n, wide):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = rng.randint(0, 1000)
        length = rng.choice([0, 1, 3, 10, 50, wide])
        rows.append((rng.choice("xxxy") if rng.random() < 0.95 else None, None if rng.random() < 0.03 else a,
                     a + length if rng.random() < 0.95 else a - 1, i))
    return rows


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("max_rows", [4, 10 ** 6])
@pytest.mark.parametrize("kind", ["int", "double", "timestamp_ntz"])
def test_range_join_equals_theta_join(spark, by, closed, max_rows, kind):
    if kind != "int" and (by or max_rows == 4):
        pytest.skip("the numbers' cases cover it")
    left, right = _spans(1, 90, 400), _spans(2, 110, 700)
    left += left[:3]  # repeated rows
    scale = {"int": lambda v: v, "double": lambda v: None if v is None else v / 7, "timestamp_ntz": at}[kind]
    frame = lambda rows, s: spark.createDataFrame(
        [(k, scale(a), scale(b), i) for k, a, b, i in rows], f"k string, {s}0 {kind}, {s}1 {kind}, {s} int")
    ldf, rdf = frame(left, "l"), frame(right, "r")
    if not by:
        rdf = rdf.drop("k")
    got = range_join(ldf, rdf, ("l0", "l1"), ("r0", "r1"), by=by, closed=closed, max_rows=max_rows)
    touch = (lambda a, b: a <= b) if closed else (lambda a, b: a < b)
    want = sorted((i, j) for k, a, b, i in left for m, c, d, j in right
                  if None not in (a, c) and touch(a, b) and touch(c, d) and touch(a, d) and touch(c, b) and (not by or k == m is not None))
    assert sorted((r.l, r.r) for r in got.collect()) == want and len(want) > 100


def test_range_join_of_points_and_of_empty_tables(spark):
    points = spark.createDataFrame([(i,) for i in (1, 5, 5, 9)], "p int")
    spans = spark.createDataFrame([(1, 5), (5, 5), (6, 8)], "a int, b int")
    got = range_join(points, spans, ("p", "p"), ("a", "b"))
    assert sorted(map(tuple, got.collect())) == [(1, 1, 5), (5, 1, 5), (5, 1, 5), (5, 5, 5), (5, 5, 5)]
    assert range_join(points.limit(0), spans, ("p", "p"), ("a", "b")).collect() == []
    assert range_join(points.limit(0), spans.limit(0), ("p", "p"), ("a", "b")).collect() == []
    same = range_join(spans.selectExpr("3 as x", "3 as y"), spans.selectExpr("3 as a", "3 as b"), ("x", "y"), ("a", "b"))
    assert same.count() == 9  # all points alike
    with pytest.raises(ValueError, match="both"):
        range_join(spans, spans, ("a", "b"), ("a", "b"))


def test_range_join_has_no_product_and_far_values_fit(spark):
    a = spark.createDataFrame([(-1e18, -1e18 + 1), (0.0, 1e-9), (1e18, 1e18)], "a double, b double")
    b = spark.createDataFrame([(-1e18, -1e18), (0.0, 0.0), (5e17, 2e18)], "c double, d double")
    got = range_join(a, b, ("a", "b"), ("c", "d"))
    assert "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.a for r in got.collect()) == [-1e18, 0.0, 1e18]


@pytest.mark.parametrize("max_rows", [3, 7, 10 ** 6])
def test_sessions_equal_brute_force(spark, max_rows):
    rows = _trades(5, 200)
    got = add_sessions(spark.createDataFrame([(k, at(t), v) for k, t, v in rows], "k string, t timestamp_ntz, v int"), ["k"], "t",
                       "INTERVAL 2 MINUTES", max_rows=max_rows).collect()
    assert len(got) == len(rows)
    number, last = {}, {}
    want = {}
    for k, t, v in sorted((r for r in rows if r[1] is not None), key=lambda r: r[1]):
        if k not in last or t - last[k] > 2:
            number[k] = number.get(k, 0) + 1
        last[k] = t
        want[v] = number[k]
    assert {r.v: r.session for r in got} == {v: want.get(v) for _, _, v in rows}


def test_sessions_sum_up(spark):
    rows = [("a", float(t)) for t in (1, 2, 3, 9, 10, 30)] + [(None, 5.0), (None, 6.5), ("z", None)]
    df = spark.createDataFrame(rows, "u string, t double")
    for max_rows in (2, 100):
        got = sorted((tuple(r) for r in session_windows(df, ["u"], "t", 1.5, max_rows=max_rows).collect()), key=str)
        assert got == sorted([("a", 1, 1.0, 3.0, 3), ("a", 2, 9.0, 10.0, 2), ("a", 3, 30.0, 30.0, 1), (None, 1, 5.0, 6.5, 2)], key=str)
    assert session_windows(df.limit(0), ["u"], "t", 1.5).collect() == []
    assert session_windows(df, [], "t", 2.0).count() == 3
