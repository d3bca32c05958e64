"""Rolling aggregates of many frames, told in one pass over rows that a window has put in order.

Spark's moving frames go through all their rows anew for each row. Here a batch of rows is shifted
against itself: frame by frame the same operations in the same order, so results are those of the window functions
to the last bit. A row's number in its group says which of the rows before it are of its group, so
neither keys nor order need be known; the last rows of a batch are handed to the next.
"""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, WindowSpec, functions as F, types as T

ROW = "row_in_order"


class Shifted:
    """A column of doubles, its missing values marked, and each row's number in its group.

    The first ``back`` rows are there to be looked back at; results are of the others.
    """

    def __init__(self, values: np.ndarray, known: np.ndarray, row: np.ndarray, back: int):
        self.values, self.known, self.row, self.first = values, known, row, back

    def back(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The value ``k`` rows before each row, and whether its group has one there that is not missing."""
        own = slice(self.first - k, len(self.row) - k)
        return self.values[own], self.known[own] & (self.row[self.first:] > k)

    def _over(self, size: int, told: Callable) -> tuple[np.ndarray, np.ndarray]:
        """``told`` of each row's last ``size`` values, oldest first, and which of them there are (None: all)."""
        if not self.known.all():
            return told([self.back(k) for k in reversed(range(size))])
        n = len(self.row) - self.first
        values, known = told([(self.values[self.first - k:self.first - k + n], None) for k in reversed(range(size))])
        # The first rows of a group have fewer.
        row = self.row[self.first:]
        short = np.flatnonzero(row < size)
        if len(short):
            values[short], known[short] = told([
                (self.values[self.first + short - k], row[short] > k) for k in reversed(range(size))])
        return values, known

    def mean(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        def told(frame):
            total, count = np.zeros(len(frame[0][0])), np.zeros(len(frame[0][0]))
            for values, there in frame:
                total += values if there is None else np.where(there, values, 0.0)
                count += 1 if there is None else there
            return total / np.maximum(count, 1), count > 0

        return self._over(size, told)

    def _extreme(self, size: int, better: Callable, worst: float) -> tuple[np.ndarray, np.ndarray]:
        def told(frame):
            best, some = np.full(len(frame[0][0]), worst), np.zeros(len(frame[0][0]), bool)
            for values, there in frame:
                best = better(best, values if there is None else np.where(there, values, worst))
                some |= True if there is None else there
            return best, some

        return self._over(size, told)

    def largest(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """NaN is larger than any number."""
        return self._extreme(size, np.maximum, -np.inf)

    def smallest(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        least, some = self._extreme(size, np.fmin, np.inf)
        numbers = Shifted(self.values, self.known & ~np.isnan(self.values), self.row, self.first)
        if (numbers.known != self.known).any():  # where all there is is NaN, it is the least
            least = np.where(some & ~numbers._extreme(size, np.fmin, np.inf)[1], np.nan, least)
        return least, some

    def deviation(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Sample deviation, by the same updates as Spark's; missing for a single value."""
        def told(frame):
            count, mean, squares = (np.zeros(len(frame[0][0])) for _ in range(3))
            for values, there in frame:
                count += 1 if there is None else there
                away = values - mean
                if there is not None:
                    away = np.where(there, away, 0.0)
                step = away / np.maximum(count, 1)
                mean += step
                squares += away * (away - step)
            return np.sqrt(squares / np.maximum(count - 1, 1)), count > 1

        return self._over(size, told)


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    known = column.is_valid().to_numpy(zero_copy_only=False)
    return column.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False), known


Columns = dict[str, tuple[np.ndarray, np.ndarray]]


def add_rolling(df: DataFrame, window: WindowSpec, inputs: Sequence[str], names: Sequence[str],
                add: Callable[..., Columns], back: int) -> DataFrame:
    """``df`` with the double columns ``names`` that ``add`` tells from ``inputs``, ``Shifted`` each.

    ``back`` is how many rows before a row its values look at; ``add`` gets that many before the first.
    """
    numbered, own = df.withColumn(ROW, F.row_number().over(window)), df.columns

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Before the first row are rows of no group.
        row = np.zeros(back, np.int64)
        kept = [(np.zeros(back), np.ones(back, bool))] * len(inputs)
        for batch in batches:
            if not batch.num_rows:
                continue
            row = np.concatenate([row[-back:], batch.column(ROW).to_numpy(zero_copy_only=False)])
            # The window's rows come group by group, in order.
            if ((row[back:] != row[back - 1:-1] + 1) & (row[back:] != 1)).any():
                raise ValueError("rows are not in the order of their window")
            kept = [tuple(map(np.concatenate, zip((v[-back:] for v in held), _values(batch.column(c)))))
                    for c, held in zip(inputs, kept)]
            with np.errstate(all="ignore"):
                found = add(*(Shifted(*held, row, back) for held in kept))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in own), *(pa.array(found[c][0], mask=~found[c][1]) for c in names)], [*own, *names])

    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.DoubleType()) for c in names)])
    return numbered.mapInArrow(told, schema)
