"""SimHash fingerprints, and links between near ones through pivot distance tables.

A fingerprint takes the majority of each bit over the hashes of a text's word
shingles. Two fingerprints link where at most ``max_bits`` bits differ.

**Pivot tables.** The 64 bits are cut into segments, and in each segment the
Hamming distances to several reference fingerprints are computed: a row of
coordinates for every fingerprint. With twice as many segments as ``max_bits``
a linked pair agrees in at least half of them, and there all its coordinates
are equal. So the fingerprints are dealt out by the coordinates of every choice
of that many segments: no linked pair is missed. Within such a bucket a pair is
discarded if any coordinate differs by more than ``max_bits`` (the triangle
inequality), and survivors are verified bit by bit.

Equal fingerprints are one row throughout, so exact copies never form pairs. A
bucket of many different fingerprints is cut into chunks, each pair of chunks
being a block of its own, so no task gets a whole bucket. A block emits only a
forest of its links: as many rows as members at most, with the same
reachability as all links.

A null or empty text has fingerprint zero, which links like any other.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from barforge.functions.storage import stored
from barforge.llm.components import component_labels

SEED = 42  # of the shingle hash
REFERENCE_SEED = 7
ROWS_AT_ONCE = 1 << 16


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """Hashes of all word shingles, repeats included; fewer words make one shingle.

    Words are runs without ASCII white space, A-Z lower-cased.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += 1 + len(word)
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    return np.array([xxh64_intdigest(joined[s:e], SEED)
                     for s, e in zip(starts, ends[width - 1:])], np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """Bit i is 1 if it is set in over half of the shingle hashes; signed 64 bits."""
    hashes = shingle_hashes(text or "", width)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), ROWS_AT_ONCE):
        part = hashes[at:at + ROWS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def simhash(text: Column, width: int = 3) -> Column:
    """Fingerprint of a text column as bigint."""
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), width) for t in texts], pa.int64())

    return F.arrow_udf(run, "bigint")(text)


@dataclass(frozen=True)
class Pivots:
    """Reference fingerprints by segment, and what follows for candidates."""

    max_bits: int
    per_segment: int = 8

    @property
    def segments(self) -> list[tuple[int, int]]:
        """First bit and width of each segment."""
        n = max(1, 2 * self.max_bits)
        edges = [round(i * 64 / n) for i in range(n + 1)]
        return [(a, b - a) for a, b in zip(edges, edges[1:])]

    @property
    def choices(self) -> list[tuple[int, ...]]:
        """Sets of segments of which a linked pair shares at least one whole."""
        n = len(self.segments)
        return list(combinations(range(n), n - self.max_bits))

    def distances(self, fingerprints: np.ndarray) -> np.ndarray:
        """The pivot table: a row per fingerprint, a column per reference."""
        return _distances(fingerprints, tuple(self.segments), self.per_segment)

    def keys(self, fingerprints: np.ndarray) -> np.ndarray:
        """Bucket numbers: a row per fingerprint, a column per choice of segments."""
        table = self.distances(fingerprints).astype(np.uint64)
        m = self.per_segment
        out = np.empty((len(fingerprints), len(self.choices)), np.uint64)
        for j, choice in enumerate(self.choices):
            mixed = np.full(len(fingerprints), j + 1, np.uint64)
            for s in choice:
                for c in range(s * m, (s + 1) * m):
                    mixed = (mixed ^ table[:, c]) * np.uint64(0x9E3779B97F4A7C15)
                    mixed ^= mixed >> np.uint64(29)
            out[:, j] = mixed
        return out.view(np.int64)


@lru_cache(maxsize=8)
def _references(segments: tuple[tuple[int, int], ...], per_segment: int) -> list[tuple[np.uint64, np.ndarray]]:
    rng = np.random.default_rng(REFERENCE_SEED)
    out = []
    for first, width in segments:
        mask = np.uint64(((1 << width) - 1) << first)
        bits = rng.integers(0, 2, (per_segment, 64), dtype=np.uint8)
        refs = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
        out.append((mask, refs & mask))
    return out


def _distances(fps: np.ndarray, segments: tuple[tuple[int, int], ...], per_segment: int) -> np.ndarray:
    fps = fps.view(np.uint64)
    columns = [np.bitwise_count((fps & mask) ^ ref).astype(np.int8)
               for mask, refs in _references(segments, per_segment) for ref in refs]
    return np.stack(columns, axis=1)


def _forest(fps: np.ndarray, side: np.ndarray | None, pivots: Pivots) -> Iterator[tuple[int, int]]:
    """Links among members (between two sides, if given) that keep what reaches what."""
    table = pivots.distances(fps)
    bits = fps.view(np.uint64)
    rest = np.arange(len(fps))
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            able = np.abs(table[rest] - table[x]).max(axis=1) <= pivots.max_bits
            if side is not None:
                able &= side[rest] != side[x]
            able[able] = np.bitwise_count(bits[rest[able]] ^ bits[x]) <= pivots.max_bits
            near, rest = rest[able], rest[~able]
            for y in near:
                yield int(fps[y]), int(fps[x])
            todo.extend(near)


def _link_blocks(pivots: Pivots):
    """Links of the blocks of a partition, whose rows come sorted by key, low, high."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links_of(block: pd.DataFrame) -> list[tuple[int, int]]:
        cross = block.low.iat[0] != block.high.iat[0]
        side = (block.chunk.to_numpy() == block.low.to_numpy()) if cross else None
        return list(_forest(block.fp.to_numpy(), side, pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of a block that may go on in the next batch
        for batch in batches:
            rows = batch.to_pandas()
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            if not len(rows):
                continue
            number = rows[["key", "low", "high"]].diff().ne(0).any(axis=1).cumsum()
            last = number == number.iat[-1]
            held = rows[last]
            out = [p for _, block in rows[~last].groupby(number[~last], sort=False) for p in links_of(block)]
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in out], schema)
        if held is not None and len(held):
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in links_of(held)], schema)

    return run


def near_links(fingerprints: DataFrame, max_bits: int = 3, chunk_rows: int = 2048) -> DataFrame:
    """Links (a, b) that join all fingerprints within ``max_bits`` bits, directly or in steps.

    ``fingerprints`` has the bigint column ``fp``; nulls take no part. A bucket of
    more than ``chunk_rows`` members is dealt out as pairs of chunks.
    """
    pivots = Pivots(max_bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            keys = pivots.keys(fps)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(fps, keys.shape[1]))], ["key", "fp"])

    # Partitions given by number are not merged: small rows, but much work for each.
    parts = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = fingerprints.select("fp").where("fp is not null").distinct().repartition(parts, "fp")
    dealt = distinct.mapInArrow(deal, "key bigint, fp bigint")
    shared = dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / chunk_rows).cast("int")
    blocks = (
        dealt.join(shared, "key")
        .select("key", "fp", chunks.alias("chunks"), F.pmod(F.xxhash64("fp"), chunks).cast("int").alias("chunk"))
        .select("key", "fp", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
                "chunk", "fp")
        .repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high")
    )
    return blocks.mapInArrow(_link_blocks(pivots), "a bigint, b bigint")


def _components(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component) of every distinct fingerprint."""
    distinct = fingerprints.select("fp").distinct()
    labels = component_labels(near_links(distinct, max_bits))
    return distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text",
                    width: int = 3, max_bits: int = 3) -> DataFrame:
    """(id, fp, component_id) per row: fingerprint, smallest id reachable over links.

    Rows keep their number: repeated rows come out repeated. A null id names no
    component; where all ids of a component are null, its component_id is null.
    Other columns of ``docs`` are not read.
    """
    marked = stored(docs.select(F.col(id).alias(id), simhash(F.col(text), width).alias("fp")), "fingerprints")
    least = marked.groupBy("fp").agg(F.min(id).alias("least_id"))
    classes = stored(_components(marked, max_bits).join(least, "fp"), "classes")
    named = classes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return marked.join(classes.join(named, "component").select("fp", "component_id"), "fp").select(
        id, "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text",
                         width: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns.

    The row with the smallest id stays (a null id goes after all others), between equal
    ids the one with the smaller hash of its text; of repeated rows one stays.
    """
    key = F.struct(F.col(id).isNull().alias("no_id"), F.col(id).alias("id"), F.xxhash64(text).alias("text_key"))
    marked = stored(docs.select(key.alias("key"), simhash(F.col(text), width).alias("fp")), "fingerprints")
    least = marked.groupBy("fp").agg(F.min("key").alias("key"))
    kept = _components(marked, max_bits).join(least, "fp").groupBy("component").agg(F.min("key").alias("key"))
    # Plain equality of columns that are never null: the join's partitioning serves the window, too.
    kept = kept.select(F.col("key.no_id").alias("__no_id"), F.coalesce(F.col("key.id").cast("string"), F.lit("")).alias("__id"),
                       F.col("key.text_key").alias("__text_key"))
    names = docs.columns
    keyed = docs.select(
        "*", F.col(id).isNull().alias("__no_id"), F.coalesce(F.col(id).cast("string"), F.lit("")).alias("__id"),
        F.xxhash64(text).alias("__text_key"))
    on = ["__no_id", "__id", "__text_key"]
    repeat = F.row_number().over(Window.partitionBy(*on).orderBy(F.lit(1)))
    return keyed.join(kept, on, "left_semi").withColumn("__repeat", repeat).where("__repeat = 1").select(*names)
