import numpy as np
import pytest

from barforge.llm import whitening as W


def _symmetric(values, seed=0):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [
    np.linspace(5, 1, 20),
    [4, 3, 3 - 1e-9, 3 - 2e-9, 3 - 5e-9, 2, 1],  # closer than single precision tells
    [4, 3 + 1e-13, 3, 1],
    [2.0] * 5 + [1.0] * 4,  # equal
    [1.0] * 6,
    [1e8, 1, 1e-8, 0.0],
    [0.0, 0.0, 0.0],
])
def test_refinement_solves_clustered_eigenvalues(values):
    m = _symmetric(values)
    m = (m + m.T) / 2
    got, x = W.eigenvectors(m)
    scale = max(abs(np.array(values)).max(), 1e-300)
    assert got == pytest.approx(np.sort(values)[::-1], abs=4e-15 * scale * len(values))
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-14
    assert np.abs(m @ x - x * got).max() <= 2e-14 * scale


def test_close_eigenvectors_are_right_in_double_precision():
    """The columns of a pair 1e-9 apart, which single precision mixes at will."""
    values = np.array([3.0, 2.0, 2.0 - 1e-9, 1.0])
    m = _symmetric(values, 3)
    m = (m + m.T) / 2
    rough = np.linalg.eigh(m.astype(np.float32))[1][:, ::-1]
    got, x = W.refined_eigenvectors(m, rough)
    off = np.abs(x.T.astype(np.longdouble) @ m.astype(np.longdouble) @ x.astype(np.longdouble) - np.diag(got)).max()
    assert off < 2e-15 and np.abs(x.T @ x - np.eye(4)).max() < 1e-15
    plain = np.linalg.eigh(m)[1][:, ::-1]  # its error is that of double precision over the gap; the refined one's is not
    assert min(np.abs(x[:, 1] - plain[:, 1]).max(), np.abs(x[:, 1] + plain[:, 1]).max()) < 1e-5
    first = np.linalg.eigh(m)[1][:, ::-1][:, 0]
    assert min(np.abs(x[:, 0] - first).max(), np.abs(x[:, 0] + first).max()) < 1e-14


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string, n int, x string")


def _expected(rows, components=4, levels=256):
    kept = [(r[0], np.array(r[1], np.float32).astype(float)) for r in rows
            if r[1] is not None and len(r[1]) and None not in r[1] and np.isfinite(np.array(r[1], float)).all()]
    x = np.array([np.floor(levels * v) for _, v in kept]).astype(int)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    z = fit - s / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return kept, n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ vectors / np.sqrt(values), values / np.trace(z.T @ z / n)


def _rows(count=400, d=9, seed=1):
    rng = np.random.default_rng(seed)
    spread = np.diag(np.linspace(1, 0.2, d))
    return [(i, (rng.normal(size=d) @ spread).astype(np.float32).tolist(), "c", 1, "x") for i in range(count)]


def test_whitening_equals_one_place(spark):
    rows = _rows()
    rows += [rows[3]] * 300 + [(None, *rows[5][1:])]  # copies weigh once; a null id stays
    rows += [(1, None, None, None, None), (2, [], None, None, None), (3, [1.0] * 8 + [None], None, None, None),
             (4, [float("nan")] * 9, None, None, None), (5, [float("inf")] + [0.0] * 8, None, None, None)]
    got = W.whiten(_frame(spark, rows).repartition(7)).collect()
    kept, n, deviation, whitened, explained = _expected(rows)
    assert len(got) == 4 * len(kept) and {r.n for r in got} == {n}
    key = lambda i: -1 if i is None else i
    by = sorted(zip([key(i) for i, _ in kept], deviation.tolist(), whitened.tolist()))
    for k in range(4):
        mine = sorted((key(r.vec_id), r.deviation, r.whitened) for r in got if r.component == k + 1)
        assert [m[:2] for m in mine] == [b[:2] for b in by]
        a, b = np.array([m[2] for m in mine]), np.array([x[2][k] for x in by])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-10
        assert all(r.explained == pytest.approx(explained[k], rel=1e-10) for r in got if r.component == k + 1)
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-10


def test_partitions_do_not_matter(spark):
    df = _frame(spark, _rows(200))
    a, b = (sorted(map(tuple, W.whiten(df.repartition(k)).collect())) for k in (1, 13))
    assert np.allclose(np.array(a, float), np.array(b, float), rtol=1e-9, atol=1e-11)


def test_tables_without_variance(spark):
    df = _frame(spark, _rows(5))
    assert W.whiten(df.limit(0)).collect() == [] and W.whiten(df.limit(0)).columns == W.whiten(df).columns
    assert W.whiten(_frame(spark, [_rows(1)[0]] * 4)).collect() == []  # equal vectors: no component
    two = W.whiten(_frame(spark, [(1, [0.0, 1.0], None, None, None), (2, [1.0, 1.0], None, None, None), (2, [7.0], None, None, None)]))
    got = two.collect()  # one direction only; the odd length takes no part
    assert [(r.vec_id, r.component, r.n) for r in got] == [(1, 1, 2), (2, 1, 2)]
    assert [abs(r.whitened) for r in got] == [1, 1] and [r.deviation for r in got] == [256 ** 2] * 2


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(v), 1.0], None, None, None) for i, v in enumerate([2 ** 40, -2 ** 40, 3])]
    for r in W.whiten(_frame(spark, rows[2:] + [(9, [5.0, -2.0], None, None, None)]), levels=2 ** 20).collect():
        assert r.deviation > 0
    with pytest.raises(Exception, match="64 bits"):
        W.whiten(_frame(spark, rows)).collect()


def test_query_whitens_every_vector(spark):
    from barforge.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    got = QUERIES["op11_whitening"](spark, folder).toPandas()
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    kept, n, deviation, whitened, explained = _expected(list(table.itertuples(index=False)))
    assert len(got) == 4 * len(kept) and set(got.n) == {n} and got.identity_error.max() < 1e-10
    for k in range(4):
        mine = got[got.component == k + 1].sort_values("vec_id")
        order = np.argsort([i for i, _ in kept])
        assert (mine.deviation.to_numpy() == deviation[order]).all()
        a, b = mine.whitened.to_numpy(), whitened[order, k]
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        assert mine.explained.iat[0] == pytest.approx(explained[k], rel=1e-10)
