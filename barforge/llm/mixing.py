"""Mix sources to target weights in words, dealt over shards by a splitting tree.

1. Every source gets a target of words: its weight's share of all words, but at
   most ``cap`` times its own; what is cut off is shared again by weight.
2. A source is taken in passes: whole ones while the target allows, and a partial
   one over a keyed permutation of its rows, up to the row at which the words
   taken come nearest to the target.
3. Each pass is cut into blocks of the permutation. A binary tree over the shards
   deals out the sources' block quotas: at each node the left half's share is
   drawn from the multivariate hypergeometric distribution, so every quota is used
   up exactly and each shard's mixture is that of the whole, within chance.
4. A shard takes its quota as the next blocks of each source's permutation, which
   no other shard gets, and sorts its rows by a keyed hash.

All choices follow from a row's own hash and one small row per source, so texts are
moved only when shards are written. Reruns and recomputed tasks agree.

Rows of null source are a source of their own, the last. Rows of null text have no
words; rows without words are repeated like the others and take nothing. Rows equal
in id and text share their fate. A table without words has targets of zero.
"""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from barforge.functions.storage import stored

MAX_SOURCES = 100_000  # sources are weighed one by one: the driver reads a row of each
MAX_QUOTAS = 20_000_000  # of sources in shards, 8 bytes each; shards grow beyond
RANK_BITS = 60
LEVEL_BITS = 10
URN = 10 ** 9  # numpy draws from fewer than that; of more, see _marked


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([len(t.as_py().encode().split()) if t.is_valid else 0 for t in texts], pa.int64())

    return F.arrow_udf(run, "bigint")(text)


def target_words(sizes: Sequence[int], weights: Sequence[float], cap: float) -> list[float]:
    """Shares of all words by weight, none above ``cap`` times its own words."""
    targets = [0.0] * len(sizes)
    total, free = sum(sizes), [i for i, n in enumerate(sizes) if n]
    left = float(total)
    while free:
        weight = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / weight > cap * sizes[i]]
        for i in over or free:
            targets[i] = float(cap * sizes[i]) if over else left * weights[i] / weight
        if not over:
            break
        left = total - sum(targets)
        free = [i for i in free if i not in set(over)]
    return targets


def _marked(draw: np.random.Generator, good: int, bad: int, sample: int, tries: int = 1 << 16) -> int:
    """How many of ``sample`` drawn from ``good + bad`` are good, for urns of any size.

    If every one were drawn by a coin of its own, the good ones drawn would be distributed
    so among the cases in which ``sample`` are drawn in all: coins are thrown until they are.
    That takes about the square root of ``sample`` throws, by binomial counts.
    """
    if good + bad < URN:
        return int(draw.hypergeometric(good, bad, sample))
    if not good or not bad or sample in (0, good + bad):
        return min(good, sample)
    coin = sample / (good + bad)
    while True:
        heads = draw.binomial(good, coin, tries)
        hits = np.flatnonzero(heads + draw.binomial(bad, coin, tries) == sample)
        if len(hits):
            return int(heads[hits[0]])


def _share(draw: np.random.Generator, own: np.ndarray, sample: int) -> np.ndarray:
    """A draw of ``sample`` from ``own`` by the multivariate hypergeometric distribution."""
    taken = np.zeros_like(own)
    rest = int(own.sum())
    for i, n in enumerate(own.tolist()):
        if rest < URN:
            taken[i:] = draw.multivariate_hypergeometric(own[i:], sample, method="marginals") if rest else 0
            break
        taken[i] = _marked(draw, n, rest - n, sample)
        rest, sample = rest - n, sample - int(taken[i])
    return taken


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Quotas of each shard: a row per shard, a column per source; columns add up to ``quotas``."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(first: int, last: int, own: np.ndarray) -> None:
        if last - first == 1:
            out[first] = own
            return
        middle = (first + last) // 2
        total = int(own.sum())
        share = round(total * (middle - first) / (last - first))
        left = _share(np.random.default_rng([seed, first, last]), own, share)
        split(first, middle, left)
        split(middle, last, own - left)

    split(0, shards, np.asarray(quotas, np.int64))
    return out


@dataclass(frozen=True)
class Mixture:
    """What was decided for every source; ``sources`` has one row each, in their order."""

    sources: pd.DataFrame  # source, source_size, target, passes, cut, blocks
    borders: np.ndarray  # per source: number of its blocks up to and with each shard
    id: str
    source: str
    text: str
    seed: int

    @property
    def shards(self) -> int:
        return self.borders.shape[1]

    def _decided(self, rows: DataFrame, rank: Column) -> DataFrame:
        """Rows with the struct ``__mix``: their source's decisions, rank and copies."""
        spark = rows.sparkSession
        schema = "number int, source string, source_size bigint, target double, passes int, cut bigint, blocks bigint"
        told = spark.createDataFrame(
            [(i, *r) for i, r in enumerate(self.sources.itertuples(index=False, name=None))], schema)
        told = told.select(F.col("source").alias("__source"), F.struct("*").alias("__told"))
        joined = rows.join(F.broadcast(told), rows[self.source].eqNullSafe(told["__source"]))
        copies = F.col("__told.passes") + (rank < F.col("__told.cut")).cast("int")
        return joined.withColumn("__mix", F.struct("__told.*", rank.alias("rank"), copies.alias("copies"))).drop(
            "__source", "__told")

    def plan(self, sized: DataFrame) -> DataFrame:
        """id, size, source_size, target, copies per row of ``sized`` (id, source, size, rank)."""
        return self._decided(sized, F.col("rank")).select(
            self.id, "size", F.col("__mix.source_size"), F.col("__mix.target"), F.col("__mix.copies"))

    def mixed(self, docs: DataFrame) -> DataFrame:
        """The mixture: a row per copy, with ``shard`` and ``copy`` (which replace columns so
        named), each shard in one partition and in its order."""
        borders, seed = self.borders, self.seed

        def shard_of(number: pa.Array, block: pa.Array) -> pa.Array:
            n, b = number.to_numpy(zero_copy_only=False), block.to_numpy(zero_copy_only=False)
            out = np.empty(len(n), np.int32)
            for i in np.unique(n):
                out[n == i] = np.searchsorted(borders[i], b[n == i], side="right")
            return pa.array(out)

        mix = F.col("__mix")
        # Copy 0 is the partial pass, in the order that the cut was made in.
        copies = F.filter(F.sequence(F.lit(0), mix.passes), lambda c: (c > 0) | (mix.rank < mix.cut))
        again = F.shiftrightunsigned(F.xxhash64(mix.rank, "copy"), 64 - RANK_BITS)
        own = F.when(F.col("copy") == 0, mix.rank).otherwise(again)
        partial = F.when(mix.cut > 0, _block(mix.cut - 1, mix.blocks) + 1).otherwise(0)
        block = F.when(F.col("copy") == 0, _block(own, mix.blocks)).otherwise(
            partial + (F.col("copy") - 1) * mix.blocks + _block(own, mix.blocks))
        names = [c for c in docs.columns if c not in ("shard", "copy")]
        rows = self._decided(docs.select(*names), rank_of(self.id, self.text, seed))
        return (
            rows.withColumn("copy", F.explode(copies))
            .withColumn("shard", F.arrow_udf(shard_of, "int")(mix.number, block))
            .withColumn("__order", F.xxhash64(F.lit(seed + 1), mix.rank, "copy"))
            .repartition("shard").sortWithinPartitions("shard", "__order")
            .select(*names, "shard", "copy")
        )


def _block(rank: Column, blocks: Column) -> Column:
    """Which of ``blocks`` equal ranges of ranks holds the rank."""
    return F.shiftright(F.shiftright(rank, RANK_BITS - 32) * blocks, 32)


def rank_of(id: str, text: str, seed: int) -> Column:
    """A row's place in its source's permutation: 60 bits of an MD5, the same in any engine."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id).cast("string"), F.lit("")),
                               F.coalesce(F.md5(text), F.lit(""))))
    return F.conv(F.substring(digest, 1, RANK_BITS // 4), 16, 10).cast("bigint")


def _cuts(sized: DataFrame, source: str, sources: list, partial: list[float]) -> list[int]:
    """Ranks below which the partial passes take rows: the words come nearest to ``partial``.

    Refines ``LEVEL_BITS`` of rank a round: words per range are summed, and only rows of the
    one range in which a source's sum crosses its aim go on to the next round.
    """
    spark = sized.sparkSession
    open_ = {i: (0, p) for i, p in enumerate(partial) if p > 0}
    cuts = [0] * len(sources)
    shift = RANK_BITS
    while open_:
        above, shift = shift, max(0, shift - LEVEL_BITS)
        told = spark.createDataFrame([(i, sources[i], at, aim) for i, (at, aim) in open_.items()],
                                     "i int, `__source` string, at bigint, aim double")
        rows = sized.join(F.broadcast(told), sized[source].eqNullSafe(told["__source"]))
        if above < RANK_BITS:
            rows = rows.where(F.shiftright("rank", above) == F.col("at"))
        ranges = rows.groupBy("i", "aim", F.shiftright("rank", shift).alias("range")).agg(
            F.sum("size").alias("words"), F.min("rank").alias("low"), F.max("rank").alias("high"))
        upto = F.sum("words").over(Window.partitionBy("i").orderBy("range"))
        crossed = (ranges.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words"))
                   .where("upto >= aim AND before < aim").collect())
        for r in crossed:
            aim = open_.pop(r.i)[1] - r.before
            if r.low < r.high:
                open_[r.i] = (r.range, aim)
            else:  # one rank is left: its words go to the nearer side
                cuts[r.i] = r.low + int(r.words - aim < aim)
        for i in set(open_) - {r.i for r in crossed}:  # the sum never reaches the aim: take all
            cuts[i] = (1 << RANK_BITS) - 1
            del open_[i]
    return cuts


def fit_mixture(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3, *,
                id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 20,
                block_rows: int = 64, shard_words: int = 500_000) -> tuple[Mixture, DataFrame]:
    """Decide the mixture of ``docs``, and the table (id, source, size, rank) it rests on.

    ``weights`` repeat over the sources in code point order, null last. A shard has
    about ``shard_words`` words, a block about ``block_rows`` rows of one source. Shards
    become larger where sources times shards would exceed ``MAX_QUOTAS``.
    """
    sized = stored(docs.select(
        F.col(id).alias(id), F.col(source).cast("string").alias(source), word_count(F.col(text)).alias("size"),
        rank_of(id, text, seed).alias("rank")), "sizes")
    totals = sized.groupBy(source).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    found = totals.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources to weigh")
    found = sorted(found, key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [int(r.words) for r in found]
    names = [r[0] for r in found]
    targets = target_words(sizes, [weights[i % len(weights)] for i in range(len(found))], cap)
    passes = [int(t // n) if n else 0 for t, n in zip(targets, sizes)]
    cuts = _cuts(sized, source, names, [t - p * n for t, p, n in zip(targets, passes, sizes)])
    blocks = [-(-r.n // block_rows) for r in found]
    partial = [((c - 1 >> RANK_BITS - 32) * b >> 32) + 1 if c else 0 for c, b in zip(cuts, blocks)]
    quotas = np.array([p * b + q for p, b, q in zip(passes, blocks, partial)], np.int64)
    shards = max(1, min(-(-int(sum(targets)) // shard_words), MAX_QUOTAS // max(1, len(found))))
    dealt = split_quotas(quotas, shards, seed)
    table = pd.DataFrame({"source": pd.Series(names, dtype=object), "source_size": sizes, "target": targets,
                          "passes": passes, "cut": cuts, "blocks": blocks})
    return Mixture(table, np.cumsum(dealt, axis=0).T.copy(), id, source, text, seed), sized


def mix_plan(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3, **options) -> DataFrame:
    """id, size, source_size, target and copies per row of ``docs``."""
    mixture, sized = fit_mixture(docs, weights, cap, **options)
    return mixture.plan(sized)


def words_taken(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3, **options) -> DataFrame:
    """id, size, source_size, target and words taken per row of ``docs``, counted in the dealt mixture.

    Rows equal in id, source and text share the words of their copies evenly; rows of no
    copy have 0.
    """
    mixture, sized = fit_mixture(docs, weights, cap, **options)
    id, source, text = mixture.id, mixture.source, mixture.text
    dealt = mixture.mixed(docs.select(F.col(id).alias(id), F.col(source).cast("string").alias(source), F.col(text).alias(text)))
    counted = dealt.select(
        F.col(id).alias("__id"), F.col(source).alias("__from"), rank_of(id, text, mixture.seed).alias("__rank"),
        word_count(F.col(text)).alias("words")).groupBy("__id", "__from", "__rank").agg(F.sum("words").alias("words"))
    alike = sized.groupBy(F.col(id).alias("__id"), F.col(source).alias("__from"), F.col("rank").alias("__rank")).agg(
        F.count("*").alias("rows"))

    def same(a: DataFrame, b: DataFrame, names: Sequence[str]) -> Column:
        return (a["__rank"] == b[names[2]]) & a["__id"].eqNullSafe(b[names[0]]) & a["__from"].eqNullSafe(b[names[1]])

    shares = counted.join(alike, same(counted, alike, ("__id", "__from", "__rank"))).select(
        counted["__id"], counted["__from"], counted["__rank"], F.expr("words div rows").alias("taken"))
    rows = mixture._decided(sized, F.col("rank"))
    return rows.join(shares, same(shares, rows, (id, source, "rank")), "left").select(
        rows[id], "size", F.col("__mix.source_size"), F.col("__mix.target"), F.coalesce("taken", F.lit(0)).alias("taken"))


def mix_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3, **options) -> DataFrame:
    """The mixed rows of ``docs`` by shard, shuffled within each."""
    return fit_mixture(docs, weights, cap, **options)[0].mixed(docs)
