"""Score texts for toxicity: logistic regression by FTRL-proximal over hashed word grams.

A text is the set of its words, pairs of neighbouring words and skip-grams (pairs of
words with one or two between them), each hashed to one of 2 ** ``bits`` coordinates.
Every coordinate has a learning rate of its own, which falls with the squared gradients
it has seen, and the L1 term keeps a coordinate at zero until its gradients agree. What
remains are the few weights that are sent to the tasks that score.

Learning is distributed by mixing: labelled rows are dealt by a hash of their text to parts
of about ``rows_per_part`` rows; each part runs through its rows in a fixed order from
the same state, the parts' changes are averaged by coordinate, and the next pass starts
from there. A part holds the state of all coordinates (17 bytes each), never its rows.
A coordinate is learnt from once its part has met it ``least`` times. Of a pass, only coordinates
are handed on whose sum of gradients has come half way to a weight that is not zero; the
others begin anew, so what is sent and kept is a small multiple of the model.

Nothing but the text enters a score or the order of learning. A null text is scored as
an empty one: by the constant alone. Labels of one document are averaged; null labels
and labels of unknown documents count for nothing; repeated rows of a document are learnt
from once. Without labelled rows every score is 0.5.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from barforge.functions.storage import stored

# ASCII letters and digits and all bytes beyond make up words, A-Z lower-cased; the rest separates them.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or bytes([c]).isalnum() else 32 for c in range(256))
SKIPS = (1, 2, 3)  # distance of the second word of a pair: neighbours, one and two words between
MOST_CACHED = 1 << 17  # hashes of words kept by a task


class _Hashes(dict):
    """Hashes of words; forgets them when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_CACHED:
            self.clear()
        got = self[word] = xxh64_intdigest(word)
        return got


class Grams:
    """Coordinates of texts; keeps the hashes of words it has met."""

    def __init__(self, bits: int):
        self.bits = bits
        self._known = _Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct coordinates of a whole text as int32; none for null or empty."""
        words = (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()
        h = np.fromiter(map(self._known.__getitem__, words), np.uint64, len(words))
        grams = [_mixed(h)]
        for skip in SKIPS:
            grams.append(_mixed(h[:-skip] * np.uint64(2 * skip + 1) + (h[skip:] ^ (h[skip:] >> np.uint64(29)))))
        every = (np.concatenate(grams) >> np.uint64(64 - self.bits)).astype(np.int32)
        every.sort()
        return every[np.concatenate(([True], every[1:] != every[:-1]))] if len(every) else every


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Rates:
    """Parameters of the learner: rate, its start, L1 and L2."""

    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def telling(self, z: np.ndarray) -> np.ndarray:
        """Coordinates worth handing on: at least half way to a weight that is not zero."""
        return np.abs(z) >= self.l1 / 2

    def constant(self, z: float, n: float) -> float:
        """The weight of the constant, which L1 and L2 leave free."""
        return -z * self.alpha / (self.beta + n ** 0.5)


@dataclass
class State:
    """What the learner knows of every coordinate, the constant behind them."""

    z: np.ndarray
    n: np.ndarray
    met: np.ndarray  # times a coordinate was met in this part, up to 255

    @classmethod
    def of(cls, size: int, index: np.ndarray, z: np.ndarray, n: np.ndarray, least: int) -> "State":
        state = cls(np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1, np.uint8))
        state.z[index], state.n[index] = z, n
        state.met[index] = least  # known coordinates are learnt from at once
        return state

    def learn(self, grams: np.ndarray, y: float, rates: Rates, least: int) -> None:
        """One row: the coordinates that are set, and its label, 0 to 1."""
        self.met[grams] += self.met[grams] < 255
        on = grams[self.met[grams] >= least]
        z, n = self.z[on], self.n[on]
        w = rates.weights(z, n)
        free = rates.constant(self.z[-1], self.n[-1])
        g = sigmoid(w.sum() + free) - y
        root = np.sqrt(n + g * g)
        self.z[on] = z + g - (root - np.sqrt(n)) / rates.alpha * w
        self.n[on] = n + g * g
        root = (self.n[-1] + g * g) ** 0.5
        self.z[-1] += g - (root - self.n[-1] ** 0.5) / rates.alpha * free
        self.n[-1] += g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass(frozen=True)
class ToxicityModel:
    """Weights that are not zero, by coordinate, and the constant."""

    bits: int
    index: np.ndarray
    weights: np.ndarray
    constant: float

    def scores(self, texts: Iterable[str | None], grams: Grams, dense: np.ndarray) -> np.ndarray:
        return sigmoid(np.array([dense[grams(t)].sum() for t in texts]) + self.constant)

    def dense(self) -> np.ndarray:
        every = np.zeros(1 << self.bits, np.float32)
        every[self.index] = self.weights
        return every

    def score(self, text: Column) -> Column:
        """Probability of a text column's rows to be toxic, 0 to 1."""
        model, held = self, []  # what a task builds once

        def run(texts: pa.Array) -> pa.Array:
            if not held:
                held.extend([Grams(model.bits), model.dense()])
            return pa.array(model.scores((t.as_py() for t in texts), *held) if len(texts) else [], pa.float64())

        return F.arrow_udf(run, "double")(text)


def _learn(start: tuple[np.ndarray, np.ndarray, np.ndarray], bits: int, rates: Rates, least: int):
    """Changes of one pass, part by part: rows (i, z, n) weighted by the part's rows."""
    size = 1 << bits

    def changes(state: State, rows: int) -> pa.RecordBatch:
        told = rates.telling(state.z)
        told[start[0]] = told[size] = True
        state.z[start[0]] -= start[1]
        state.n[start[0]] -= start[2]
        on = np.flatnonzero(told)
        return pa.RecordBatch.from_arrays(
            [pa.array(on.astype(np.int32)), pa.array(state.z[on] * rows), pa.array(state.n[on] * rows)], ["i", "z", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(bits)
        now, state, rows = None, None, 0
        for batch in batches:
            for p, y, text in zip(*(batch.column(c) for c in ("part", "y", "text"))):
                if p.as_py() != now:
                    if rows:
                        yield changes(state, rows)
                    state = None  # before the next one is made
                    now, state, rows = p.as_py(), State.of(size, *start, least), 0
                state.learn(grams(text.as_py()), y.as_py(), rates, least)
                rows += 1
        if rows:
            yield changes(state, rows)

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic",
                 bits: int = 22, passes: int = 8, least: int = 4, rates: Rates = Rates(),
                 rows_per_part: int = 5000, max_rows: int = 40_000) -> ToxicityModel:
    """Learn from the texts of ``docs`` that ``labels`` (id, label of 0 to 1) mark.

    At most about ``max_rows`` labelled documents are learnt from, chosen by a hash. The state of the coordinates handed on, not the rows, comes to the driver.
    """
    truth = labels.groupBy(F.col(id).alias("__id")).agg(F.avg(label).alias("y")).where("__id is not null and y is not null")
    marked = truth.count()
    if marked > max_rows:
        truth = truth.where(F.pmod(F.xxhash64(F.lit(7), "__id"), F.lit(1 << 20)) < int((1 << 20) * max_rows / marked))
    # At most about ``max_rows`` pairs of numbers are broadcast, so texts that are not learnt from stay where they are.
    known = docs.select(F.col(id).alias("__id"), F.col(text).alias("text")).join(F.broadcast(truth), "__id")
    known = known.withColumn("key", F.xxhash64(F.lit(13), F.coalesce("text", F.lit("")))).dropDuplicates(["__id", "key"])
    parts = max(1, -(-min(marked, max_rows) // rows_per_part))
    dealt = (known.withColumn("part", F.pmod(F.shiftright("key", 20), F.lit(parts)).cast("int")).select("part", "key", "y", "text")
             .repartition(parts, "part").sortWithinPartitions("part", "key", "y"))
    # Texts, not their grams, which take more room than it takes time to make them again.
    learnt = stored(dealt, "labelled-texts", partition_by="part").select("part", "y", "text")

    size = 1 << bits
    index, z, n = np.empty(0, np.int32), np.empty(0), np.empty(0)
    total = learnt.select("part").count()
    for _ in range(passes if total else 0):
        summed = (learnt.mapInArrow(_learn((index, z, n), bits, rates, least), "i int, z double, n double")
                  .groupBy("i").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toPandas().sort_values("i"))
        every = np.union1d(index, summed.i.to_numpy())
        new_z, new_n = np.zeros(len(every)), np.zeros(len(every))
        for at, dz, dn in ((index, z, n), (summed.i.to_numpy(), summed.z.to_numpy() / total, summed.n.to_numpy() / total)):
            places = np.searchsorted(every, at)
            new_z[places] += dz
            new_n[places] += dn
        on = rates.telling(new_z) | (every == size)
        index, z, n = every[on].astype(np.int32), new_z[on], new_n[on]
    if not total:
        return ToxicityModel(bits, index, np.empty(0, np.float32), 0.0)
    free = index == size
    weights = np.where(free, 0, rates.weights(z, n))
    on = weights != 0
    return ToxicityModel(bits, index[on], weights[on].astype(np.float32),
                         rates.constant(z[free][0], n[free][0]) if free.any() else 0.0)


def held_out(id: str = "doc_id") -> Column:
    """Rows that labels are never learnt from: crc32 of the id's text is a multiple of five."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 5 == 0, F.lit(False))
