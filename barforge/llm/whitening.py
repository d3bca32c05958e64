"""Whiten vectors along the leading eigenvectors of their covariance.

Vectors are laid on a grid of whole numbers, x = floor(levels * entry), and the
covariance is that of the distinct x (the fit list), so that copies weigh once. Counts and
sums are exact; each partition centres its rows before it multiplies, and the partial
products, whose size depends on the number of dimensions alone, are added up row by row
of the matrix on the cluster.

**Eigenvectors.** Single-precision eigenvectors of the covariance are the start. Ogita and
Aishima's iteration corrects them by matrix products alone, here in extended precision:
from the errors of orthogonality R = I - X'X and of diagonality S = X'VX follows a
correction X E with E_ij = (S_ij + l_j R_ij) / (l_j - l_i). Where two eigenvalues lie too close
for their difference to be trusted, the columns form a cluster: the eigenproblem of the
cluster's small block, shifted by its mean eigenvalue, is solved by itself and the
columns are turned by its solution; the iteration then tells them apart by the block's
own scale, and only orthogonality is corrected for those that remain equal. Errors are
squared in every round, so few are needed.

**Rows.** A vector that is null, empty, or holds null or non-finite entries takes no part, nor
does one whose length is not the commonest (of equally common ones the largest). All others,
repeated rows and null ids included, come out once for each component. Components
whose eigenvalue is zero to rounding do not exist: equal vectors have none, and
an empty table none. Entries beyond the range of whole 64-bit numbers, also of their
deviations, are an error.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from barforge.functions.storage import stored

MOST = 2 ** 63 - 1
EXTENDED = np.longdouble


def whole_vectors(vectors: DataFrame, vector: str, levels: int, *keep: str) -> DataFrame:
    """Rows that take part: the columns ``keep`` and ``x``, array<bigint>."""
    entries = F.col(vector)
    sound = F.coalesce(F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    sized = vectors.where(sound & (F.size(entries) > 0))
    length = sized.groupBy(F.size(entries).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    x = F.transform(entries, lambda c: F.floor(c.cast("double") * float(levels)).cast("bigint"))
    return sized.where(F.size(entries) == (length.d if length else 0)).select(*keep, x.alias("x"))


def _matrix(rows: pa.Array) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def _added(partial: DataFrame, size: int) -> np.ndarray:
    """Rows (i, part, v) of partial matrices added up by i, in the order of their parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), _matrix(batch.column("v")) if batch.num_rows else ()):
                sums[i] = sums[i] + row if i in sums else row
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))], ["i", "v"])

    in_order = partial.repartition("i").sortWithinPartitions("part", "i")
    total = np.zeros((size, size))
    for row in in_order.mapInArrow(run, "i int, v array<double>").collect():
        total[row.i] = row.v
    return total


def _products(fit: DataFrame, size: int, centred) -> np.ndarray:
    """Z'Z over the fit list, Z being ``centred`` of a partition's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                z = centred(_matrix(batch.column("x")))
                total += z.T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size, dtype=np.int32)), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "v"])

    partial = fit.mapInArrow(run, "i int, v array<double>").withColumn("part", F.spark_partition_id())
    return _added(partial, size)


def _totals(fit: DataFrame, size: int) -> tuple[int, list[int], int]:
    """Rows, exact sums by dimension, and the largest entry without its sign."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                most = [int(max(abs(int(c.min())), abs(int(c.max())))) for c in x.T]
                if max(most) * len(x) <= MOST:
                    sums = [int(s) for s in x.sum(axis=0)]
                else:
                    sums = [sum(map(int, column)) for column in x.T]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(size, dtype=np.int32)), pa.array([str(s) for s in sums]), pa.array([str(m) for m in most]),
                     pa.array(np.full(size, len(x), np.int64))], ["i", "s", "m", "n"])

    wide = "decimal(38,0)"
    rows = (fit.mapInArrow(run, "i int, s string, m string, n bigint").groupBy("i")
            .agg(F.sum(F.col("s").cast(wide)).cast(wide).alias("s"), F.max(F.col("m").cast(wide)).alias("m"), F.sum("n").alias("n"))
            .orderBy("i").collect())
    return rows[0].n, [int(r.s) for r in rows], max(int(r.m) for r in rows)


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Runs of eigenvalues, falling, in which neighbours are at most ``width`` apart."""
    cuts = np.flatnonzero(np.abs(np.diff(values)) > width) + 1
    return np.split(np.arange(len(values)), cuts)


def _pairs(s: np.ndarray, r: np.ndarray, values: np.ndarray, width) -> np.ndarray:
    """The correction E; pairs closer than ``width`` (a number or a matrix) stay orthogonal only."""
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > width
    return np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)


def refined_eigenvectors(matrix: np.ndarray, start: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, from rough ones in ``start``.

    Works in extended precision with matrix products; ends once a round corrects less
    than double precision shows.
    """
    v = matrix.astype(EXTENDED)
    x = start.astype(EXTENDED)
    one = np.eye(len(v), dtype=EXTENDED)
    norm = float(np.abs(matrix).sum(axis=1).max()) or 1.0
    values = np.zeros(len(v), EXTENDED)

    def errors_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        r, s = one - x.T @ x, x.T @ (v @ x)
        return (r + r.T) / 2, (s + s.T) / 2  # else rounding, divided by small gaps, would turn columns unevenly

    before = np.inf
    for _ in range(rounds):
        r, s = errors_of(x)
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        errors = float(np.linalg.norm((s - np.diag(values)).astype(float)) + norm * np.linalg.norm(r.astype(float)))
        width = np.full((len(v), len(v)), 2 * errors, EXTENDED)
        solved = False
        for own in _clusters(values.astype(float), 2 * errors):
            if len(own) < 2:
                continue
            # The block by itself, shifted and at its own scale.
            shift = values[own].mean()
            block = x[:, own]
            small = block.T @ (v @ block - shift * block)
            size = float(np.abs(small).max())
            if size > 8 * np.finfo(float).eps * norm:
                turn = np.linalg.eigh((-(small + small.T) / (2 * size)).astype(float))[1].astype(EXTENDED)
                x[:, own] = block @ turn
                solved = True
                small = turn.T @ small @ turn
            rest = x[:, own].T @ x[:, own] - np.eye(len(own), dtype=EXTENDED)
            off = small - np.diag(np.diag(small))
            width[np.ix_(own, own)] = 2 * (float(np.linalg.norm(off.astype(float))) + size * float(np.linalg.norm(rest.astype(float))))
        if solved:
            r, s = errors_of(x)
            values = np.diag(s) / (1 - np.diag(r))
        width = np.maximum(width, 64 * np.finfo(EXTENDED).eps * norm)
        e = _pairs(s, r, values, width)
        x = x + x @ e
        most = float(np.abs(e).max())
        if not solved and (most < np.finfo(float).eps / 4 or most > before / 2):
            break  # done, or what is left is the rounding of very close eigenvalues
        before = most
    for _ in range(rounds):  # orthogonality holds whatever the gaps
        r, _ = errors_of(x)
        x = x + x @ (r / 2)
        if np.abs(r).max() < np.finfo(float).eps / 4:
            break
    order = np.argsort(-values, kind="stable")
    return values[order].astype(float), x[:, order].astype(float)


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; each one's largest entry is positive."""
    scale = float(np.abs(matrix).max()) or 1.0
    rough = np.linalg.eigh((matrix / scale).astype(np.float32))[1][:, ::-1]
    values, x = refined_eigenvectors(matrix / scale, rough)
    largest = x[np.abs(x).argmax(axis=0), np.arange(len(x))]
    return values * scale, x * np.where(largest < 0, -1, 1)


@dataclass(frozen=True)
class Whitening:
    """Center, directions and scales; its size depends on the number of dimensions alone."""

    rows: int  # of the fit list
    sums: list[int]
    largest: int  # entry without its sign
    covariance: np.ndarray
    values: np.ndarray  # eigenvalues of the components kept, falling
    directions: np.ndarray  # dimensions x components
    identity_error: float = 0.0

    @property
    def explained(self) -> np.ndarray:
        """Share of the total variance by component."""
        return self.values / np.trace(self.covariance)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        center = np.array([float(EXTENDED(s) / self.rows) for s in self.sums])
        return (x - center) @ self.directions / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum of (rows * x - sums)^2 of each row, exactly."""
        bound = (self.rows * self.largest + max(map(abs, self.sums)))
        if bound * bound * len(self.sums) <= MOST:
            return ((self.rows * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1)
        wide = ((self.rows * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1)
        if max(wide) > MOST:
            raise OverflowError("a deviation does not fit into 64 bits")
        return wide.astype(np.int64)

    def rows_of(self, x: Column) -> Column:
        """struct<deviation, whitened: array of the components> of a column of whole vectors."""
        kind = pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

        def run(rows: pa.Array) -> pa.Array:
            if not len(rows):
                return pa.array([], kind)
            m = _matrix(rows)
            return pa.StructArray.from_arrays(
                [pa.array(self.deviations(m)), pa.array(self.whitened(m.astype(float)).tolist(), pa.list_(pa.float64()))],
                fields=list(kind))

        return F.arrow_udf(run, "struct<deviation:bigint,whitened:array<double>>")(x)


def fit_whitening(vectors: DataFrame, vector: str = "embedding", levels: int = 256, components: int = 4) -> Whitening | None:
    """Fit to the distinct whole vectors; None where no row takes part."""
    fit = stored(whole_vectors(vectors, vector, levels).distinct(), "fit-list")
    first = fit.first()
    if first is None:
        return None
    size = len(first.x)
    rows, sums, largest = _totals(fit, size)
    center = np.array([float(EXTENDED(s) / rows) for s in sums])
    covariance = _products(fit, size, lambda x: x - center) / rows
    values, directions = eigenvectors((covariance + covariance.T) / 2)
    kept = min(components, int((values > size * np.finfo(float).eps * max(values[0], 0)).sum()) if values[0] > 0 else 0)
    fitted = Whitening(rows, sums, largest, covariance, values[:kept], directions[:, :kept])
    if not kept:
        return fitted
    measured = _products(fit, kept, lambda x: fitted.whitened(x)) / rows
    return Whitening(rows, sums, largest, covariance, fitted.values, fitted.directions,
                     float(np.abs(measured - np.eye(kept)).max()))


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", levels: int = 256, components: int = 4) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per row and component.

    Other columns of ``vectors`` are not read.
    """
    model = fit_whitening(vectors, vector, levels, components)
    if model is None:
        model = Whitening(1, [0], 0, np.ones((1, 1)), np.empty(0), np.empty((1, 0)))
    rows = whole_vectors(vectors, vector, levels, F.col(id).alias("__id"))
    told = F.array(*(F.struct(F.lit(k + 1).alias("component"), F.lit(float(share)).alias("explained"))
                     for k, share in enumerate(model.explained)))
    if not len(model.values):
        told = F.array().cast("array<struct<component:int,explained:double>>")
    return (rows.select("__id", model.rows_of(F.col("x")).alias("row"))
            .select("__id", "row", F.inline(told))
            .select(F.col("__id").alias(id), "component", F.lit(model.rows).cast("bigint").alias("n"), F.col("row.deviation").alias("deviation"),
                    F.col("row.whitened")[F.col("component") - 1].alias("whitened"), "explained",
                    F.lit(model.identity_error).alias("identity_error")))
