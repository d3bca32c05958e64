import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barforge.llm import quality as Q


def test_statistics_of_whole_texts():
    s = dict(zip(Q.STATISTICS, Q.statistics("The cat!! THE\nThe cat!! THE\n\n%% 42")))
    assert s["distinct_words"] == pytest.approx(4 / 8) and s["repeats"] == pytest.approx(1 / 8)
    assert s["lines"] == pytest.approx(np.log1p(3)) and s["repeated_lines"] == pytest.approx(1 / 3)
    assert s["function_words"] == pytest.approx(4 / 8) and s["wordless"] == pytest.approx(1 / 8)
    assert s["marked_words"] == pytest.approx(3 / 8) and s["capital_words"] == pytest.approx(2 / 8)
    for empty in (None, ""):
        assert Q.statistics(empty) == [0.0] * len(Q.STATISTICS)
    assert len(Q.statistics(" ")) == len(Q.statistics("x " * 200_000)) == len(Q.STATISTICS)


def test_isotonic_equals_a_plain_search():
    rng = np.random.default_rng(0)
    for _ in range(20):
        v, w = rng.normal(size=6), rng.integers(1, 5, 6)
        got = Q.isotonic(v, w)
        assert (np.diff(got) >= -1e-12).all()
        # min-max formula of the isotonic regression
        mean = lambda a, b: (v[a:b + 1] * w[a:b + 1]).sum() / w[a:b + 1].sum()
        want = [max(min(mean(a, b) for b in range(i, 6)) for a in range(i + 1)) for i in range(6)]
        assert got == pytest.approx(want)


def test_features_approximate_the_kernel():
    d = len(Q.STATISTICS)
    rng = np.random.default_rng(1)
    many = 20_000
    m = Q.QualityModel(np.zeros(d), np.ones(d), rng.normal(0, 1 / np.sqrt(d), (d, many)), rng.uniform(0, 2 * np.pi, many),
                       *[np.empty(0)] * 3)
    x = rng.normal(size=(5, d))
    z = m.features(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * d))
    assert z @ z.T == pytest.approx(want, abs=0.05)


def _corpus(spark, n=800):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = [rng.choice(["the", "of", "house", "river", "and", "stone"]) for _ in range(rng.randint(20, 90))]
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else [words[0]] * len(words)
        rows.append((i, " ".join(words), "x"))
        if i % 3:
            labels.append((i, int(good), None))
    rows += [(n, None, "x"), (n, "", "x"), (None, "the house", None)]
    labels += [(1, None, None), (None, 1, None), (10**9, 0, None), labels[0]]
    return (spark.createDataFrame(rows, "doc_id long, text string, stats string"),
            spark.createDataFrame(labels, "doc_id long, quality int, y int"), rows)


def test_fit_equals_ridge_in_one_place(spark):
    docs, labels, rows = _corpus(spark)
    stats = docs.select("doc_id", Q.text_statistics(F.col("text")).alias("stats"))
    one = Q.fit_quality(stats.repartition(9), labels, features=24)
    other = Q.fit_quality(stats.coalesce(1), labels, features=24)
    assert one.weights == pytest.approx(other.weights, rel=1e-4, abs=1e-5)
    known = (stats.join(labels.groupBy("doc_id").agg(F.avg("quality").alias("t")).where("t is not null"), "doc_id")
             .where(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(5)) != 0).toPandas())
    z = one.features(np.array(known.stats.tolist()))
    ridge = 1e-4 * len(z) * np.eye(25)
    ridge[-1, -1] = 0
    assert one.weights == pytest.approx(np.linalg.solve(z.T @ z + ridge, z.T @ known.t), rel=1e-4, abs=1e-5)


def test_scores_tell_unlabelled_rows_apart(spark):
    docs, labels, rows = _corpus(spark)
    stats = docs.select("doc_id", Q.text_statistics(F.col("text")).alias("stats"))
    model = Q.fit_quality(stats, labels)
    got = docs.select("doc_id", "text", model.score_text(F.col("text")).alias("s")).collect()
    assert len(got) == len(rows) and all(0 <= r.s <= 1 for r in got)
    for r in got[:-3]:
        words = r.text.split()
        assert (r.s >= 0.5) == (not r.text.isupper() and len(set(words)) > 1), r


def test_texts_are_learnt_from_like_their_statistics(spark):
    docs, labels, rows = _corpus(spark)
    stats = docs.select("doc_id", Q.text_statistics(F.col("text")).alias("stats"))
    one, other = Q.fit_quality(stats, labels, features=24), Q.fit_texts(docs, labels, features=24)
    assert one.weights == pytest.approx(other.weights, rel=1e-4, abs=1e-5)
    assert one.raw == pytest.approx(other.raw, abs=1e-5) and one.calibrated == pytest.approx(other.calibrated)
    few = Q.fit_texts(docs, labels, max_rows=200)  # still tells the classes apart
    scores = {r.doc_id: r.s for r in docs.select("doc_id", few.score_text(F.col("text")).alias("s")).collect()}
    truth = {r.doc_id: r.quality for r in labels.where("quality is not null and doc_id < 800").collect()}
    assert np.mean([(scores[d] >= 0.5) == y for d, y in truth.items()]) > 0.95
    assert Q.fit_texts(docs, labels.limit(0)).scores(np.zeros((1, len(Q.STATISTICS)))).tolist() == [0.5]


def test_without_labels_and_without_rows(spark):
    docs, labels, _ = _corpus(spark, 10)
    stats = docs.select("doc_id", Q.text_statistics(F.col("text")).alias("stats"))
    model = Q.fit_quality(stats, labels.limit(0))
    assert {r[0] for r in docs.select(model.score_text(F.col("text"))).collect()} == {0.5}
    assert Q.fit_quality(stats.limit(0), labels).scores(np.zeros((2, len(Q.STATISTICS)))).tolist() == [0.5, 0.5]
    one = Q.fit_quality(stats, labels.where("doc_id = 2"))
    assert docs.select(one.score_text(F.col("text"))).count() == 13


def test_query_holds_a_third_out_and_ranks_it(spark):
    from barforge.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op8_quality"](spark, folder).collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == (r.score >= 0.5)
    truth = [(r.quality, got[r.doc_id]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    good = [g.score for y, g in truth if g.held_out and y == 1]
    bad = [g.score for y, g in truth if g.held_out and y == 0]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    right = np.mean([g.predicted == y for y, g in truth if g.held_out])
    assert auc > 0.95 and right > 0.93, (auc, right)
