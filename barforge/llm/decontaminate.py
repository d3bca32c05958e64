"""Find passages of a benchmark in documents: SimHash of item-sized windows.

1. **Windows.** A passage that is similar enough to an item holds four fifths of
   its word shingles, so at least one of every fourth shingle of the item (the
   anchors). Every place of a document where an anchor stands puts a window there,
   as long as the item and aligned by the anchor. No similar passage lacks a window.
2. **Fingerprints.** Items and windows get a SimHash of their shingles, repeats
   weighing as often as they occur.
3. **Multi-index.** A fingerprint is cut into blocks; within ``radius`` bits at
   least one block differs in at most ``radius // blocks``, so items are indexed by
   every block value that near, and windows of the same length look their blocks
   up: every pair within the radius is found. At similarity 0.8 about 10 of 64 bits
   differ, with a deviation of 3; the default radius lies three deviations above.
4. **Verification.** Survivors are compared by the exact similarity of their
   shingle multisets (sum of smaller counts over sum of larger counts).

All of it is SQL expressions. Anchors are a literal set, used in portions; tables
of the benchmark are broadcast below a counted number of rows and joined by a
shuffle above it.

Items of fewer words than a shingle are not searched, nor are null or empty ones.
An item of more than ``max_item_words`` words is searched in equal parts, each of
them a find. A null or empty document holds nothing. Documents are told apart by id
and text; repeated rows of both are one.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from barforge.functions.storage import stored
from barforge.llm.words import plain_words

ANCHOR_STEP = 4  # of an item's shingles, one in so many is an anchor; above 0.2 of all at 0.8
BLOCKS = 8
BLOCK_BITS = 64 // BLOCKS
ANCHORS_AT_ONCE = 20_000
MAX_ANCHORS = 5_000_000  # read by the driver, 8 bytes each
BROADCAST_ROWS = 500_000


def _checked(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def _hash_at(words: str, i: str, width: int) -> str:
    return f"xxhash64({', '.join(f'get({words}, {i} + {j})' for j in range(width))})"


def _shingle_hashes(words: str, width: int) -> str:
    return f"transform(sequence(0, size({words}) - {width}), i -> {_hash_at(words, 'i', width)})"


def _let(name: str, value: str, body: str) -> Column:
    """``body`` with ``name`` bound to ``value``, which is computed once a row wherever it is moved to."""
    return F.expr(f"transform(array({value}), {name} -> {body})[0]")


def _fingerprint(hashes: str) -> Column:
    """Majority of each bit over an array of hashes."""
    return _let("own", hashes, """aggregate(sequence(0, 63), 0L, (fp, b) -> fp | shiftleft(cast(
        2 * size(filter(own, h -> (shiftright(h, b) & 1L) = 1L)) > size(own) as bigint), b))""")


def _blocks(fp: str) -> str:
    return f"transform(sequence(0, {BLOCKS - 1}), b -> cast(shiftright({fp}, b * {BLOCK_BITS}) & {2 ** BLOCK_BITS - 1}L as int))"


def _near_values(flips: int) -> list[int]:
    """Values of a block with at most ``flips`` ones."""
    return [v for v in range(2 ** BLOCK_BITS) if v.bit_count() <= flips]


def _shingles(words: str, width: int) -> str:
    return f"transform(sequence(1, size({words}) - {width - 1}), i -> array_join(slice({words}, i, {width}), ' '))"


def _similarity(a: str, b: str, width: int) -> Column:
    """Sum of smaller counts of the shingles of two word arrays over the sum of larger counts."""
    both = """aggregate(array_distinct(p.a), 0, (n, s) -> n + least(
        size(filter(p.a, x -> x = s)), size(filter(p.b, x -> x = s))))"""
    shared = f"transform(array({both}), n -> cast(n as double) / (size(p.a) + size(p.b) - n))[0]"
    return _let("p", f"named_struct('a', {_shingles(a, width)}, 'b', {_shingles(b, width)})", shared)


def benchmark_parts(benchmark: DataFrame, *, item: str = "item_id", text: str = "text", width: int = 5,
                    max_item_words: int = 128) -> DataFrame:
    """(item, part, length, words, hashes, fp, part_key) of every searched part of an item."""
    words = benchmark.select(F.col(item).alias(item), plain_words(F.col(text)).alias("all")).where(
        F.size("all") >= width)
    parts = words.withColumn("parts", F.ceil(F.size("all") / max_item_words).cast("int")).select(
        item, "all", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    cut = parts.select(item, "part", F.expr(
        "slice(all, cast(part * size(all) div parts as int) + 1,"
        " cast((part + 1) * size(all) div parts as int) - cast(part * size(all) div parts as int))").alias("words"))
    hashed = cut.distinct().withColumn("hashes", F.expr(_shingle_hashes("words", width)))
    return hashed.select(
        item, "part", F.size("words").alias("length"), "words", "hashes", _fingerprint("hashes").alias("fp"),
        F.xxhash64(item, "part", "words").alias("part_key"))


def _windows(docs: DataFrame, anchors: list[int], postings: DataFrame, longest: int, id: str, text: str,
             width: int) -> DataFrame:
    """(id, text_key, start, length, words) around the places of some anchors."""
    placed = f"""transform(
        filter(if(size(w) >= {width}, sequence(0, size(w) - {width}), cast(array() as array<int>)),
               i -> {_hash_at('w', 'i', width)} in ({', '.join(map(str, anchors))})),
        i -> struct(i as pos, {_hash_at('w', 'i', width)} as hash, greatest(i - {longest}, 0) as first,
                    slice(w, greatest(i - {longest}, 0) + 1, {2 * longest}) as near))"""
    seeds = (
        docs.select(F.col(id).alias(id), F.xxhash64(text).alias("text_key"), plain_words(F.col(text)).alias("w"))
        # Outer: else the optimizer would compute the array a second time, to filter by its size.
        .select(id, "text_key", F.explode_outer(F.expr(placed)).alias("s")).where("s is not null")
        .select(id, "text_key", "s.*")
    )
    return (
        seeds.join(postings, "hash").withColumn("start", F.expr("pos - at"))
        .select(id, "text_key", "start", "length", F.expr(
            "slice(near, greatest(start, 0) - first + 1, length + least(start, 0))").alias("words"))
        # Windows of the same words are one, the first: a repeated passage is verified once.
        .where(F.size("words") >= width).groupBy(id, "text_key", "length", "words").agg(F.min("start").alias("start"))
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text",
               item: str = "item_id", item_text: str = "text", width: int = 5, similarity: float = 0.8,
               radius: int = 20, max_item_words: int = 128) -> DataFrame:
    """(id, text_key, item, part, start, length, bits, similarity): the best passage of
    every document and part of an item that reaches ``similarity``.

    ``start`` counts words from 0, and is negative where an item's first words are
    cut off; ``bits`` is the fingerprints' distance.
    """
    if similarity <= 1 - 1 / ANCHOR_STEP:
        raise ValueError(f"anchors are enough only above a similarity of {1 - 1 / ANCHOR_STEP}")
    parts = stored(benchmark_parts(benchmark, item=item, text=item_text, width=width,
                                   max_item_words=max_item_words), "benchmark")
    size = parts.agg(F.count("*").alias("n"), F.max("length").alias("longest")).first()
    postings = parts.select("length", F.posexplode("hashes").alias("at", "hash")).where(
        f"at % {ANCHOR_STEP} = 0").distinct()
    distinct = postings.select("hash").distinct()
    n = distinct.count()
    if n > MAX_ANCHORS:
        raise ValueError(f"more than {MAX_ANCHORS} anchors: search the benchmark in portions")
    anchors = sorted(r[0] for r in distinct.collect()) or [0]
    postings = _checked(postings, postings.count())
    windows = reduce(DataFrame.unionByName, (
        _windows(docs, anchors[i:i + ANCHORS_AT_ONCE], postings, size.longest or 1, id, text, width)
        for i in range(0, len(anchors), ANCHORS_AT_ONCE)))
    marked = windows.withColumn("fp", _fingerprint(_shingle_hashes("words", width)))
    flips = radius // BLOCKS
    index = (
        parts.select("length", "part_key", F.col("fp").alias("item_fp"), F.posexplode(F.expr(_blocks("fp"))).alias("block", "own"))
        .select("length", "part_key", "item_fp", "block", F.explode(F.expr(
            f"transform(array({', '.join(map(str, _near_values(flips)))}), m -> own ^ m)")).alias("value"))
    )
    near = (
        marked.select("*", F.posexplode_outer(F.expr(_blocks("fp"))).alias("block", "value"))
        .join(_checked(index, size.n * BLOCKS * len(_near_values(flips))), ["length", "block", "value"])
        .withColumn("bits", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))).where(F.col("bits") <= radius)
        # A pair may meet in several blocks: the first that is near enough speaks for it.
        .where(F.expr(f"block = array_position(transform(zip_with({_blocks('fp')}, {_blocks('item_fp')}, (x, y) -> x ^ y),"
                      f" d -> bit_count(d) <= {flips}), true) - 1"))
    )
    told = parts.select("part_key", item, "part", F.col("words").alias("item_words"))
    compared = (
        near.select(id, "text_key", "start", "length", "bits", "words", "part_key")
        .join(_checked(told, size.n), "part_key")
        .withColumn("similarity", _similarity("words", "item_words", width)).where(F.col("similarity") >= similarity)
    )
    best = F.max_by(F.struct("start", "length", "bits", "similarity"), F.struct("similarity", -F.col("start")))
    return (compared.groupBy(id, "text_key", item, "part").agg(best.alias("best"))
            .select(id, "text_key", item, "part", "best.*"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without those that hold a benchmark passage; all other rows as they are."""
    leaks = stored(find_leaks(docs, benchmark, id=id, text=text, **options).select(
        F.col(id).alias("__id"), F.col("text_key").alias("__key")).distinct(), "leaks")
    found = _checked(leaks, leaks.count())
    same = docs[id].eqNullSafe(found["__id"]) & (F.xxhash64(docs[text]) == found["__key"])
    return docs.join(found, same, "left_anti")
