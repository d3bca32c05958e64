import random
import re
from collections import Counter

import pytest

from barforge.llm import decontaminate as D


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def shingles(words):
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def slow_leaks(docs, items, least=0.8):
    """(doc, item) with the best similarity over every item-sized window, cut at the ends."""
    out = {}
    for d, text in docs:
        words = words_of(text)
        for item, item_text in items:
            target = words_of(item_text)
            if len(target) < 5:
                continue
            want = shingles(target)
            if not any(tuple(words[i:i + 5]) in want for i in range(len(words) - 4)):
                continue
            best = 0
            for s in range(-len(target), len(words)):
                have = shingles(words[max(0, s):s + len(target)])
                best = max(best, sum((have & want).values()) / (sum((have | want).values()) or 1))
            if best >= least:
                out[d, item] = round(best, 9)
    return out


def _corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["été", "ß", "The"]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, prose(rng.randint(12, 45))) for i in range(12)]
    docs = []
    for d in range(120):
        words = prose(rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            passage = list(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                passage[rng.randrange(len(passage))] = "changed"
            if rng.random() < 0.2:
                passage = passage[:-2]
            at = rng.randint(0, len(words))
            words[at:at] = passage
        docs.append((d, "".join(w.upper() + rng.choice([" ", ", ", "!\n", " -- "]) if rng.random() < .3 and w.isascii() else w + " " for w in words)))
    return docs, [(i, " ".join(w)) for i, w in items]


@pytest.mark.parametrize("portion", [20_000, 7])
def test_leaks_equal_every_window(spark, monkeypatch, portion):
    monkeypatch.setattr(D, "ANCHORS_AT_ONCE", portion)
    if portion == 7:
        monkeypatch.setattr(D, "BROADCAST_ROWS", 0)  # the way of large benchmarks
    docs, items = _corpus()
    got = D.find_leaks(
        spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, length int, words string"),
        spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, fp int")).collect()
    want = slow_leaks(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == want
    assert len(want) > 20 and len(got) == len(want)
    assert any(v < 1 for v in want.values()) and all(r.bits <= 20 for r in got)


def test_an_insertion_is_found(spark):
    item = [f"v{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(["a b c"] + item[:37] + ["new"] + item[37:] + ["d"])), (2, " ".join(item[:25]))],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in D.find_leaks(docs, bench).collect()] == [(1, 9)]


def test_long_items_go_in_parts(spark):
    item = [f"v{i}" for i in range(300)]
    docs = spark.createDataFrame([(1, " ".join(item[95:205]))], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    got = D.find_leaks(docs, bench, max_item_words=128).collect()
    assert [(r.part, r.start, r.length, r.similarity) for r in got] == [(1, 5, 100, 1.0)]


def test_nulls_repeats_and_empty_tables(spark):
    item = " ".join(f"v{i}" for i in range(20))
    long = "word " * 50_000 + item
    rows = [(None, item), (1, item), (1, item), (1, "clean text of this id"), (2, None), (3, ""), (4, long), (5, "v1 v2 v3 v4")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, `__id` string").drop("__id")
    bench = spark.createDataFrame([(7, item), (7, item), (8, None), (9, "too short"), (None, "")], "item_id long, text string")
    got = D.find_leaks(docs, bench).collect()
    assert sorted((repr(r.doc_id), r.item_id) for r in got) == [("1", 7), ("4", 7), ("None", 7)]
    kept = D.decontaminate(docs, bench)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, "clean text of this id"), (2, None), (3, ""), (5, "v1 v2 v3 v4")], key=lambda r: r[0])
    assert kept.columns == ["doc_id", "text"]
    assert D.decontaminate(docs, bench.limit(0)).count() == len(rows)
    assert D.find_leaks(docs.limit(0), bench).count() == 0


def test_too_low_a_similarity_is_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="anchors"):
        D.find_leaks(docs, docs.withColumnRenamed("doc_id", "item_id"), similarity=0.7)


def test_query_on_the_small_tables(spark):
    from barforge.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    read = lambda n, i: [(r[i], r.text) for r in spark.read.parquet(f"{folder}/{n}.parquet").collect()]
    got = QUERIES["op3_decontamination"](spark, folder).collect()
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == slow_leaks(read("documents", "doc_id"), read("benchmark", "item_id"))


def test_a_passage_that_repeats_is_one_find(spark):
    item = [f"v{i}" for i in range(40)]
    docs = [(1, " ".join(["a"] + item * 30)), (2, " ".join(item[:20] + ["x"] + item[20:]))]
    bench = [(9, " ".join(item))]
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == slow_leaks(docs, bench) == {(1, 9): 1.0}
    assert got[0].start == 1  # the first of equal ones
