import random
import re
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import pytest

from barforge.llm import spelling as S
from barforge.llm.oracles import ORACLES
from barforge.llm.queries import QUERIES
from compare import _normal


def _near(u, v):
    if u == v or abs(len(u) - len(v)) > 1:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    short, long = sorted((u, v), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _brute(counts, times=10):
    words = sorted(counts)
    near = {w: [] for w in words}
    for u, v in combinations(words, 2):
        if _near(u, v):
            near[u].append(v)
            near[v].append(u)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def _random_words(seed, n=150, letters="aab", low=1, high=6):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)})


def test_acceptors_are_minimal_and_accept_their_words():
    a = S.Acceptors()
    start = a.build(["taps", "tops"])
    assert a.common(start, start) == ["tops", "taps"] and len(a.arcs) == 5
    assert a.build([]) is None and a.build([""]) is not None
    other = a.build(["laps", "tap", "taps"])
    assert a.common(start, other) == ["taps"]


@pytest.mark.parametrize("seed", range(30))
def test_composition_equals_all_pairs(seed):
    words = _random_words(seed, 60, "aabc", 4, 5)
    short, long = ([w for w in words if len(w) == k] for k in (4, 5))
    for places in (1, 2, 3, 5):
        got = list(S.near_pairs(short, long, places))
        prefix = lambda u, v: next((i for i, (x, y) in enumerate(zip(u, v)) if x != y), min(len(u), len(v)))
        want = {(u, v) for u, v in combinations(short, 2) if _near(u, v) and prefix(u, v) < places}
        want |= {(u, v) for u in short for v in long if _near(u, v) and prefix(u, v) < places}
        assert len(got) == len(set(got)) and {tuple(sorted(p)) for p in got} == {tuple(sorted(p)) for p in want}


@pytest.mark.parametrize("max_words", [1, 7, 10_000])
def test_variants_equal_all_pairs_however_groups_are_split(spark, max_words):
    rng = random.Random(max_words)
    counts = {w: rng.choice([1, 2, 3, 20, 30, 300, 4000]) for w in _random_words(5, 250, "aabé", 1, 9)}
    counts |= {"hot" + w: rng.choice([1, 10, 100]) for w in _random_words(6, 200, "ab", 2, 7)}
    counts |= {w + "hot": rng.choice([1, 10, 100]) for w in _random_words(7, 100, "ab", 2, 7)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {tuple(r) for r in S.group_variants(df, max_words=max_words).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == _brute(counts)


def _vocabulary(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def _hard_rows():
    rng = random.Random(3)
    base = ["keyboard", "Straße", "straßenbahn", "ÉCOLEs", "überraschung", "naïveté×÷", "windows", "aaaaaaa", "aaaaaaaa"]
    rows = []
    for i in range(900):
        rows.append((i % 700, " ".join(rng.choice(base) if rng.random() < 0.8 else rng.choice(base)[1:] + "x" for _ in range(8))))
    return rows + [(None, "keyboard keyboarb keyboard"), (5, None), (6, ""), (7, "1234 -- ..."), (8, "q" * 30_000 + " " + "q" * 30_000),
                   (9, "q" * 29_999 + "r " + "q" * 29_999 + "r"), rows[0]]


def test_words_of_hard_texts(spark):
    rows = _hard_rows()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    want = _vocabulary(rows)
    assert {r.word: r.n for r in S.vocabulary(df).collect()} == want
    got = {tuple(r) for r in S.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == _brute(want) and any(r[1] for r in got)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.spelling_variants(df).collect() == []
    assert S.spelling_variants(df).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_chains_of_forms_end_at_their_root(spark):
    words = {"a" * 8: 10 ** 7, "a" * 7 + "b": 10 ** 6, "a" * 6 + "cb": 10 ** 5, "a" * 5 + "dcb": 10 ** 4, "aaaaedcb": 100, "aaafedcb": 2}
    got = {r.word: (r.form, r.root) for r in S.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    names = list(words)
    assert got == {w: (names[i - 1] if i else None, names[0]) for i, w in enumerate(names)}


def test_hard_texts_equal_their_sql(spark, tmp_path):
    spark.createDataFrame([r for r in _hard_rows() if len(r[1] or "") < 1000], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = QUERIES["op12_spelling"](spark, str(tmp_path)).toPandas()
    want = con.execute(ORACLES["op12_spelling"]).df()
    assert len(got) and sorted(got.columns) == sorted(want.columns) and _normal(got) == _normal(want)
