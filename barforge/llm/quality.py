"""Score texts for quality: kernel ridge regression over document statistics.

Every whole text becomes a few statistics (lengths, shares of character classes,
repetition, function words). Random Fourier features of the standardised
statistics approximate a Gaussian kernel; each partition of the labelled rows sums
its part of the normal equations, and the sums, whose size depends on the number of
features alone, are solved for ridge weights. A part of the labelled rows is kept
back to calibrate: its raw scores are counted in fixed bins, and the isotonic
regression over the bins maps raw scores to probabilities.

Nothing but the text enters a score. A null text is scored as an empty one. Label
rows of one document are averaged; null labels and labels of unknown documents
count for nothing. Without labelled rows every score is 0.5. Without rows to
calibrate on, raw scores are clipped to 0..1.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from barforge.functions.storage import stored
from barforge.llm.words import FUNCTION_WORDS

STATISTICS = (
    "characters", "words", "word_length", "long_words", "upper", "digits", "symbols", "stops", "other_marks",
    "non_ascii", "spaces", "distinct_words", "repeats", "commonest_word", "function_words", "marked_words",
    "wordless", "capital_words", "lines", "line_length", "repeated_lines", "ended_lines",
)

_UPPER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_SYMBOLS, _STOPS, _MARKS = b"#$%&*+/<=>@\\^_`{|}~", b".,;:?", b"!\"'()-[]"
_SPACES, _HIGH = b" \t\n\r\x0b\f", bytes(range(128, 256))


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of ``STATISTICS``."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = text.encode()
    size = len(raw)

    def share(chars: bytes) -> float:
        return (size - len(raw.translate(None, chars))) / size

    words = raw.split()
    lowered = raw.lower().split()
    n = len(words)
    counts = Counter(lowered)
    lines = [line for line in text.split("\n") if line.strip()]
    per = 1 / max(1, n)
    return [
        np.log1p(size), np.log1p(n),
        sum(map(len, words)) * per, sum(len(w) > 15 for w in words) * per,
        share(_UPPER), share(_DIGITS), share(_SYMBOLS), share(_STOPS), share(_MARKS), share(_HIGH), share(_SPACES),
        len(counts) * per, sum(map(eq, lowered, lowered[1:])) * per,
        max(counts.values(), default=0) * per,
        sum(c for w, c in counts.items() if w.strip(_STOPS + _MARKS) in _FUNCTION_BYTES) * per,
        sum(c for w, c in counts.items() if w[-1:] in _TAILS) * per,
        sum(c for w, c in counts.items() if not w.strip(_SYMBOLS + _STOPS + _MARKS)) * per,
        sum(w.isupper() for w in words) * per,
        np.log1p(len(lines)), np.log1p(size / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(line.rstrip()[-1:] in ".!?:;\"" for line in lines) / max(1, len(lines)),
    ]


_FUNCTION_BYTES = frozenset(w.encode() for w in FUNCTION_WORDS)
_TAILS = frozenset(bytes([b]) for b in _SYMBOLS + b"!")


def text_statistics(text: Column) -> Column:
    """array<double> of a text column."""
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>")(text)


@dataclass(frozen=True)
class QualityModel:
    """Everything a score needs; its size depends on the number of features alone."""

    center: np.ndarray
    spread: np.ndarray
    directions: np.ndarray  # statistics x features
    phases: np.ndarray
    weights: np.ndarray  # features and a constant; empty: nothing was learnt
    raw: np.ndarray  # knots of the calibration
    calibrated: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features of rows of statistics, and a constant."""
        x = np.clip((stats - self.center) / self.spread, -6, 6)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(z), 1))])

    def raw_scores(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated scores, 0 to 1; a hundredth is the raw score, to order equal steps."""
        if not len(self.weights):
            return np.full(len(stats), 0.5)
        raw = self.raw_scores(stats)
        clipped = np.clip(raw, 0, 1)
        if not len(self.raw):
            return clipped
        return 0.99 * np.interp(raw, self.raw, self.calibrated) + 0.01 * clipped

    def score(self, stats: Column) -> Column:
        """Scores of a column of statistics."""
        def run(rows: pa.Array) -> pa.Array:
            if not len(rows):
                return pa.array([], pa.float64())
            return pa.array(self.scores(_matrix(rows)), pa.float64())

        return F.arrow_udf(run, "double")(stats)

    def score_text(self, text: Column) -> Column:
        return self.score(text_statistics(text))


def _matrix(rows: pa.Array) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` in weighted squares."""
    blocks: list[list[float]] = []  # mean, weight, length
    for v, w in zip(values, weights):
        blocks.append([float(v), float(w), 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w2, n = blocks.pop()
            last = blocks[-1]
            blocks[-1] = [(last[0] * last[1] + m * w2) / (last[1] + w2), last[1] + w2, last[2] + n]
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def fit_quality(stats: DataFrame, labels: DataFrame, *, id: str = "doc_id", label: str = "quality",
                features: int = 256, penalty: float = 1e-4, keep_back: int = 5, bins: int = 1000,
                seed: int = 11) -> QualityModel:
    """Learn from ``stats`` (id, stats) and ``labels`` (id, label of 0 to 1).

    One in ``keep_back`` labelled rows calibrates. The labelled rows' statistics are written
    once; every partition of them sums its normal equations, whose number of rows is fixed,
    and these sums are added up by entry.
    """
    truth = labels.groupBy(F.col(id).alias(id)).agg(F.avg(label).alias("y")).where("y is not null")
    known = stored(stats.select(id, "stats").join(truth, id).select(
        "stats", "y", (F.pmod(F.xxhash64(F.lit(seed), F.col(id)), F.lit(keep_back)) == 0).alias("back")), "labelled-statistics")
    d = len(STATISTICS)
    sums = known.where("not back").agg(
        F.count("*").alias("n"),
        F.array(*(F.avg(F.col("stats")[i]) for i in range(d))).alias("center"),
        F.array(*(F.stddev_pop(F.col("stats")[i]) for i in range(d))).alias("spread")).first()
    rng = np.random.default_rng(seed)
    none = np.empty(0)
    if not sums.n:
        return QualityModel(np.zeros(d), np.ones(d), np.zeros((d, features)), np.zeros(features), none, none, none)
    spread = np.array(sums.spread)
    model = QualityModel(
        np.array(sums.center), np.where(spread > 1e-9, spread, 1.0),
        # A kernel as wide as the typical distance of standardised rows.
        rng.normal(0, 1 / np.sqrt(d), (d, features)), rng.uniform(0, 2 * np.pi, features), none, none, none)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            if batch.num_rows:
                z = model.features(_matrix(batch.column("stats")))
                y = batch.column("y").to_numpy(zero_copy_only=False)
                total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(features + 1, dtype=np.int32)), pa.array(total.tolist(), pa.list_(pa.float64()))],
            ["i", "sums"])

    learnt = known.where("not back").select("stats", "y")
    rows = (learnt.mapInArrow(equations, "i int, sums array<double>")
            .select("i", F.posexplode("sums").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
            .toPandas())
    total = np.zeros((features + 1, features + 2))
    total[rows.i, rows.j] = rows.v
    ridge = penalty * sums.n * np.eye(features + 1)
    ridge[-1, -1] = 0  # the constant is free
    model = replace(model, weights=np.linalg.solve(total[:, :-1] + ridge, total[:, -1]))

    def raw(rows: pa.Array) -> pa.Array:
        return pa.array(model.raw_scores(_matrix(rows)) if len(rows) else [], pa.float64())

    back = known.where("back").select("y", F.arrow_udf(raw, "double")(F.col("stats")).alias("raw"))
    counted = (
        back.select("y", "raw", F.floor(F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0)) * (bins / 3)).alias("bin"))
        .groupBy("bin").agg(F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count("*").alias("n"))
        .orderBy("bin").toPandas())
    if len(counted):
        model = replace(model, raw=counted.raw.to_numpy(),
                        calibrated=isotonic(counted.y.to_numpy(), counted.n.to_numpy()))
    return model


def fit_texts(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality",
              max_rows: int = 400_000, **options) -> QualityModel:
    """Learn from the texts of ``docs`` that ``labels`` mark; of other texts no statistics are taken.

    Of more than ``max_rows`` labelled documents about that many are learnt from, chosen by a hash. So
    their ids can be broadcast, and no text is shuffled.
    """
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).select(id, label)
    marked = known.agg(F.count_distinct(id)).first()[0]
    if marked > max_rows:
        known = known.where(F.pmod(F.xxhash64(F.lit(17), F.col(id)), F.lit(1 << 20)) < int((1 << 20) * max_rows / marked))
    ids = F.broadcast(known.select(id).distinct())
    stats = docs.select(id, text).join(ids, id, "left_semi").select(id, text_statistics(F.col(text)).alias("stats"))
    return fit_quality(stats, known, id=id, label=label, **options)


def held_out(id: str = "doc_id") -> Column:
    """Rows that labels are never learnt from: crc32 of the id's text leaves 1 by three."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 3 == 1, F.lit(False))
