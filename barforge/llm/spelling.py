"""Group spelling variants: words one edit apart, found by composing automata.

The vocabulary is a minimised acceptor A. Composed with a transducer T that copies
but for one inserted, deleted or replaced character, and with A again, it accepts just
the pairs of near words. A path of the composition copies until the edit, so both
acceptors are in one state (two where a character is inserted) until then, and afterwards it
walks the common language of two states.

**Partitions.** No task gets the whole acceptor. Pairs are sorted by the length of their
shorter word and by the place of the edit (the length of the common prefix). A group
fixes a length, a span of places, and what a path has read when it comes to the span: the
characters before it, and, for the acceptor read from its other end, those behind it.
A word of length L is in four groups: its first half fixed or its second, with words of
its length and one longer, and one shorter. A group of more than ``max_words`` words
is split: its span is halved, and each half fixes more characters. Every near pair has one
length and one place, so it is found in one group only. A group emits sums for its words,
not its pairs.

A null text has no words; a null id counts as the empty string. Repeated rows count
repeatedly. Words of any length are held.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from barforge.functions.history import lookup
from barforge.functions.storage import stored
from barforge.llm.words import LOWER, UPPER

RUN = r"[A-Za-zÀ-ÿ]+"
KEYS = ["len", "low", "high", "before", "behind"]


class Acceptors:
    """Minimised acceptors in one set of states: states with the same language are one."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}

    def _state(self, arcs: dict[str, int], final: bool) -> int:
        key = (final, *arcs.items())
        got = self._known.get(key)
        if got is None:
            got = self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return got

    def build(self, words: list[str]) -> int | None:
        """Start state of the acceptor of sorted, distinct words; None for no words."""
        if not words:
            return None
        path: list[tuple[dict[str, int], bool]] = [({}, False)]  # states of the last word, not yet shared
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                state = self._state(*path.pop())
                path[-1][0][last[len(path) - 1]] = state

        for word in words:
            same, most = 0, min(len(last), len(word))
            while same < most and last[same] == word[same]:
                same += 1
            close(same)
            path.extend(({}, False) for _ in range(len(word) - same))
            path[-1] = (path[-1][0], True)
            last = word
        close(0)
        return self._state(*path.pop())

    def common(self, a: int, b: int, but: str = "") -> list[str]:
        """Strings that both states accept; those beginning with ``but`` are left out."""
        found, todo = [], [(a, b, "")]
        while todo:
            a, b, read = todo.pop()
            if self.final[a] and self.final[b]:
                found.append(read)
            mine, other = self.arcs[a], self.arcs[b]
            for c in mine if len(mine) <= len(other) else other:
                if c in mine and c in other and (read or c != but):
                    todo.append((mine[c], other[c], read + c))
        return found


def near_pairs(short: list[str], long: list[str], places: int) -> Iterator[tuple[str, str]]:
    """Pairs of ``short`` with one character replaced, and of ``short`` and ``long`` with one
    inserted, the common prefix being shorter than ``places``. Both lists are sorted and distinct;
    the words of ``short`` have one length, those of ``long`` one more."""
    acceptors = Acceptors()
    start, other = acceptors.build(short), acceptors.build(long)
    if start is None:
        return
    arcs = acceptors.arcs
    replaced: dict[int, list[tuple[str, str]]] = {}  # by state, where the edit is next
    inserted: dict[tuple[int, int], list[tuple[str, str]]] = {}
    todo: list[tuple[int, int | None, str]] = [(start, other, "")]
    while todo:
        a, b, read = todo.pop()
        if a not in replaced:
            out = list(arcs[a].items())
            replaced[a] = [(c + s, d + s) for i, (c, p) in enumerate(out) for d, q in out[i + 1:] for s in acceptors.common(p, q)]
        for s, t in replaced[a]:
            yield read + s, read + t
        if b is not None:
            if (a, b) not in inserted:
                inserted[a, b] = [(s, c + s) for c, q in arcs[b].items() for s in acceptors.common(a, q, but=c)]
            for s, t in inserted[a, b]:
                yield read + s, read + t
        if len(read) + 1 < places:
            longer = arcs[b] if b is not None else {}
            todo.extend((q, longer.get(c), read + c) for c, q in arcs[a].items())


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words by word: how many in a group, and the best of them. Rows come sorted by group and word."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in (*KEYS, "word", "n")))

    def told(key: tuple, words: dict[str, int]) -> list[tuple]:
        size, low, high, before, behind = key
        cut, keep = len(before), -len(behind) or None
        middles: tuple[list[str], list[str]] = ([], [])
        for w in words:
            middles[len(w) - size].append(w[cut:keep])
        near: dict[str, list] = {}

        def add(word: str, other: str) -> None:
            n = words[other]
            held = near.get(word)
            if held is None:
                near[word] = [1, n, other]
            else:
                held[0] += 1
                if n > held[1] or n == held[1] and other < held[2]:
                    held[1:] = n, other

        for s, t in near_pairs(*map(sorted, middles), places=high - low + 1):
            s, t = before + s + behind, before + t + behind
            add(s, t)
            add(t, s)
        return [(w, *x) for w, x in near.items()]

    def emitted(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["word", "n_near", "best_n", "best"])

    now, words, out = None, {}, []
    for *key, word, n in rows():
        if key != now:
            if len(words) > 1:
                out += told(tuple(now), words)
            now, words = key, {}
            if len(out) > 5000:
                yield emitted(out)
                out = []
        words[word] = n
    if len(words) > 1:
        out += told(tuple(now), words)
    if out:
        yield emitted(out)


def _fixed(length: Column, low: Column, high: Column) -> Column:
    """A group as a struct: places ``low`` to ``high`` of pairs whose shorter word has ``length``."""
    behind = F.greatest(length - 1 - high, F.lit(0))
    return F.struct(
        length.cast("int").alias("len"), low.cast("int").alias("low"), high.cast("int").alias("high"),
        F.substring("word", F.lit(1), low).alias("before"),
        F.when(behind > 0, F.substring("word", F.char_length("word") - behind + 1, behind)).otherwise("").alias("behind"))


def _halves(length: Column, low: Column, high: Column) -> list[Column]:
    middle = F.floor((low + high + 1) / 2).cast("int")
    return [_fixed(length, low, middle - 1), _fixed(length, middle, high)]


def near_words(vocabulary: DataFrame, max_words: int = 8192) -> DataFrame:
    """(word, n_near, best_n, best) of the words with near ones in ``vocabulary`` (word, n; words distinct).

    ``best`` is the near word of largest n, of equals the first in code-point order.
    """
    long = F.char_length("word").cast("int")
    classes = vocabulary.where("word <> ''").select("word", "n", F.explode(F.array(long, long - 1)).alias("len")).where("len > 0")
    open_ = classes.select("word", "n", F.explode(F.array(*_halves(F.col("len"), F.lit(0), F.col("len")))).alias("g"))
    ready = None
    while True:
        open_ = open_.select("word", "n", "g.*")
        splits = F.col("high") > F.col("low")
        hot = stored(open_.where(splits).groupBy(KEYS).agg(F.count("*").alias("words")).where(F.col("words") > max_words), "hot-groups")
        none = hot.isEmpty()
        done = open_ if none else open_.join(lookup(hot), KEYS, "left_anti")
        ready = done if ready is None else ready.unionByName(done)
        if none:
            break
        split = open_.join(lookup(hot), KEYS, "left_semi")
        open_ = stored(split.select("word", "n", F.explode(F.array(*_halves(F.col("len"), F.col("low"), F.col("high")))).alias("g")), "split-groups")
    parts = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (ready.repartition(parts, *KEYS).sortWithinPartitions(*KEYS)
             .mapInArrow(_near_words, "word string, n_near bigint, best_n bigint, best string"))
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("first.n")).alias("best_n"), F.col("first.word").alias("best"))


def vocabulary(docs: DataFrame, id: str = "doc_id", text: str = "text", min_length: int = 7, min_rows: int = 2,
               typo_every: int = 31) -> DataFrame:
    """(word, n) of the runs of letters, A-Z lower-cased, with a letter deleted where the hash of
    document and run says so; words of ``min_length`` code points or more that occur ``min_rows`` times or more."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    name = F.coalesce(F.col(id).cast("string"), F.lit(""))
    runs = docs.select(name.alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    long = F.char_length("run")
    runs = runs.where(long >= min_length).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % long).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, long))
    words = runs.select(F.when(F.col("h") % typo_every == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_rows))


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of the words in ``forms`` (word, form): the end of the chain of forms.

    Every round follows the chains twice as far; a chain has fewer than 64 steps, as counts grow along it.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "chains")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stored(now.join(then, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "chains")
        now = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return now


def group_variants(words: DataFrame, times: int = 10, max_words: int = 8192) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n; words distinct).

    A word's form is its near word of largest n if that is at least ``times`` its own;
    its root is reached by following forms to the last.
    """
    words = stored(words.select("word", "n"), "vocabulary")
    near = near_words(words, max_words).withColumnRenamed("word", "of")
    is_form = F.col("best_n") >= F.lit(times) * F.col("n")
    told = stored(words.join(near, F.col("word") == F.col("of"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "near-words")
    roots = _rooted(told.where("form is not null")).select(F.col("word").alias("of"), "root")
    return told.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id: str = "doc_id", text: str = "text", times: int = 10) -> DataFrame:
    """Variants among the words of ``docs``; other columns are not read."""
    return group_variants(vocabulary(docs, id, text), times)
