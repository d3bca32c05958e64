import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from barforge.llm import simhash as S
from barforge.llm.components import component_labels


def slow_fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or (
        [" ".join(words)] if words else [])
    h = [xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows, max_bits):
    """Smallest id reachable over all pairs."""
    fps = [f for _, f in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (id_, _), c in zip(rows, label):
        if id_ is not None:
            least[c] = min(id_, least.get(c, id_))
    return sorted(((id_, f, least.get(c)) for (id_, f), c in zip(rows, label)), key=repr)


def test_fingerprint_equals_the_contract_word_by_word():
    rng = random.Random(3)
    words = ["The", "cat", "ÉTÉ", "été", "a\x0bb", "x\x1cy", "non break", "\t", "\n\n", "sat", "\x85", "Z"]
    texts = [None, "", "   ", "one", "Two words", "a b c"]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(200)]
    for t in texts:
        assert S.fingerprint(t) & (2**64 - 1) == slow_fingerprint(t), t


def test_large_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    want = S.fingerprint(text)
    monkeypatch.setattr(S, "ROWS_AT_ONCE", 64)
    assert S.fingerprint(text) == want


@pytest.mark.parametrize("max_bits", [0, 1, 3, 5])
def test_a_linked_pair_shares_a_bucket_and_passes_the_table(max_bits):
    rng = np.random.default_rng(max_bits)
    pivots = S.Pivots(max_bits)
    a = rng.integers(0, 2**64, 300, dtype=np.uint64)
    flips = np.zeros(300, np.uint64)
    for i in range(300):
        for bit in rng.choice(64, max_bits, replace=False):
            flips[i] |= np.uint64(1) << np.uint64(bit)
    b = a ^ flips
    assert (pivots.keys(a.view(np.int64)) == pivots.keys(b.view(np.int64))).any(axis=1).all()
    gap = np.abs(pivots.distances(a.view(np.int64)) - pivots.distances(b.view(np.int64)))
    assert gap.max() <= max_bits


def _texts(rng, groups=25, size=6):
    rows = []
    for g in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(30, 150))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"n{rng.randint(0, 99)}"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("chunk_rows", [2048, 2])
def test_components_equal_all_pairs(spark, chunk_rows, monkeypatch):
    rng = random.Random(5)
    rows = _texts(rng) + [(900, None), (901, ""), (899, " \n"), (None, ""), (7, "w1 w2"), (7, "w1 w2"), (None, "alone here")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, component_id int")
    real = S.near_links
    monkeypatch.setattr(S, "near_links", lambda f, b: real(f, b, chunk_rows))
    got = S.near_duplicates(docs).collect()
    want = slow_components([(i, slow_fingerprint(t)) for i, t in rows], 3)
    assert sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got), key=repr) == want
    assert len({r.component_id for r in got}) < len({r.fp for r in got})


def test_one_row_of_each_component_stays(spark):
    rows = _texts(random.Random(9), groups=8) + [(900, None), (901, ""), (None, " "), (None, "alone here"), (None, "alone here"), (7, "w1 w2"),
                                                 (7, "w1 w2"), (7, "other words of the same id")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    fps = [(i, slow_fingerprint(t)) for i, t in rows]
    numbered = [(k if i is None else i, f) for k, (i, f) in enumerate(fps, 10_000)]
    labels = [None] * len(rows)
    for k, (_, f) in enumerate(fps):
        near = [j for j in range(k) if bin(fps[j][1] ^ f).count("1") <= 3]
        labels[k] = k
        for j in near:
            labels = [labels[k] if x == labels[j] else x for x in labels]
    want = []
    for c in set(labels):
        own = [rows[k] for k in range(len(rows)) if labels[k] == c]
        want.append(min((i is None, i or 0) for i, _ in own))
    got = S.drop_near_duplicates(docs)
    assert got.columns == ["doc_id", "text", "fp"]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == sorted(want)
    assert len(want) < len({f for _, f in numbered})


def test_empty_table(spark):
    assert S.drop_near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_chain_and_a_hub_are_one_component_each(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    hub = [(500, i) for i in range(501, 700)]
    links = spark.createDataFrame(chain + hub + [(3, 3), (None, 4), (141, 140)], "a long, b long")
    got = {r.node: r.component for r in component_labels(links).collect()}
    assert got == {**{i: 100 for i in range(100, 142)}, **{i: 500 for i in range(500, 700)}}


def test_query_on_the_small_tables(spark):
    from barforge.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, slow_fingerprint(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op2_simhash"](spark, folder).collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=repr) == slow_components(docs, 3)
    assert all(len(r.fingerprint) == 16 for r in got)
