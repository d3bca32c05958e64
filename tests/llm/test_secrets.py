import hashlib
import math
import random
import re
from collections import Counter

from barforge.llm import secrets as S


def slow_known(text):
    """The contract word by word."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], S.ORDER[s[0]]))


def test_known_shapes_equal_the_plain_rules():
    rng = random.Random(4)
    parts = ["password=", "API_KEY: '", "token", " = \"", "AKIA", "ABCDEFGH12345678", "0123456789abcdef" * 2, "é", "\n",
             "short", "secret:abc", "secret:abcdefgh", "x", " ", "Passwd='", "ſecret=abcdefghij", "toKen=abcdefghij"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        got = [s for s in S.secret_spans(text) if s[0] in ("assign", "access", "hex")]
        assert got == slow_known(text), text


def test_hot_stretches_equal_entropies_of_every_window():
    rng = random.Random(8)
    for _ in range(60):
        run = "".join(rng.choice("abcdefghij0123"[: rng.randint(2, 14)]) for _ in range(rng.randint(0, 60)))
        hot = set()
        for i in range(len(run) - 11):
            n = Counter(run[i:i + 12])
            if -sum(c / 12 * math.log2(c / 12) for c in n.values()) >= 2.8 - 1e-9:
                hot.update(range(i, i + 12))
        got = [p for b, e in S.hot_stretches(run, 12, 2.8) for p in range(b, e)]
        assert got == sorted(hot)


def test_entropy_finds_unnamed_keys_and_leaves_words_alone():
    rng = random.Random(1)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(40))
    spans = S.secret_spans(f"before {key} after")
    assert [s[0] for s in spans] == ["entropy_base64"]
    assert spans[0][1] <= 12 and spans[0][2] >= 42
    for clean in ("Donaudampfschifffahrtsgesellschaft1 aaaaaaaaaaaaaaaaaaaaaaaa1",
                  "id 123e4567-e89b-12d3-a456-426614174000 here",
                  "commit 3f786850e387550fdab836",
                  "0123456789abcdefghijklmnopqrstuvwxyz", "4111111111111111222233334444"):
        assert [s for s in S.secret_spans(clean) if s[0].startswith("entropy")] == [], clean


def test_rows_nulls_and_clashing_names(spark):
    long = "word " * 60_000 + "token='" + "Ab1" * 10 + "'"
    rows = [(1, "password=abcdefgh1", "x"), (None, None, None), (3, "", "y"), (3, "", "y"), (5, long, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets string")
    got = S.scan_secrets(docs).collect()
    assert [[tuple(s) for s in r.secrets] for r in got] == [S.secret_spans(r[1]) for r in rows]
    assert [r.doc_id for r in got] == [1, None, 3, 3, 5]
    clean = [r.text for r in S.redact_secrets(docs).collect()]
    assert clean[:4] == [S.REDACTED, None, "", ""] and clean[4].endswith(S.REDACTED + "'")
    assert S.scan_secrets(docs.limit(0)).count() == 0


def test_query_equals_the_plain_rules(spark):
    from barforge.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op7_secrets"](spark, folder).collect():
        known = slow_known(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(s[0] == k for s in known) for k in ("assign", "access", "hex"))
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in known)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


KEY = "q7Zp0Lw3Vx9Tb1Rk5Ns8Hd2Gf4Jc6Mya"


def test_an_allowed_match_clears_only_itself():
    uuid = "123e4567-e89b-12d3-a456-426614174000"
    for before, after in ((f"/v1/{uuid}/", ""), ("backup_samples/", ""), ("", f"/{uuid}"), ("a/example/", "/xxxx")):
        text = f"see {before}{KEY}{after} end"
        at = text.index(KEY)
        assert any(b <= at + 8 and e >= at + len(KEY) - 8 for _, b, e in S.secret_spans(text)), text
        clean = S.redacted(text)
        assert S.REDACTED in clean and all(KEY[i:i + 8] not in clean for i in range(len(KEY) - 7)), clean
        assert uuid not in text or uuid in clean
    rng = random.Random(3)
    run = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(20_000))
    assert len(S.redacted(run + "xxxx" + run)) < 200
    for clean in (f"id {uuid} here", "0123456789abcdefghijklmnopqrstuvwxyz", f"commit {KEY}xxxx", "sample_" * 9 + "1"):
        assert S.redacted(clean) == clean


def test_what_overlaps_a_span_is_masked_too():
    for inner in ("0123e4567f89b12d3a456c42661417400", "AKIAB7CD9EF2GH4J", "0a1b2c3d4e5f60718293a4b5c6d7e8f9"):
        text = f"see {KEY}{inner}{KEY[::-1]} end"
        clean = S.redacted(text)
        assert clean.startswith("see ") and clean.endswith(" end") and S.REDACTED in clean
        assert len(clean) < 30, clean
        at, stop = text.index(KEY), text.index(" end")
        covered = {p for _, b, e in S.secret_spans(text) for p in range(b, e)}
        assert len(covered) >= stop - at - 12, text  # the whole token, not just what lies within it


def slow_spans(text):
    """Every window of every class for itself, and every allowed place."""
    spans = slow_known(text)
    known, out = list(spans), []
    allowed = set()
    for p in S.ALLOWED:
        for c in re.finditer(r"[A-Za-z0-9+/_=-]+", text):
            allowed.update(i for m in p.finditer(text, *c.span()) for i in range(*m.span()))
    for c in re.finditer(r"[A-Za-z0-9+/_=-]+", text):
        if len(c[0]) < 20 or S.DIGEST_BEFORE.search(text[max(0, c.start() - 24):c.start()]):
            continue
        for kind, chars, bits in (("entropy_hex", "0123456789abcdefABCDEF", 2.9), ("entropy_base64", None, 3.75)):
            hot = []
            for i in range(c.start(), c.end() - 19):
                window = text[i:i + 20]
                if allowed.isdisjoint(range(i, i + 20)) and (chars is None or set(window) <= set(chars)):
                    if -sum(n / 20 * math.log2(n / 20) for n in Counter(window).values()) >= bits - 1e-9:
                        # Windows join where they touch within one run of allowed characters.
                        if hot and i <= hot[-1][1] and allowed.isdisjoint(range(hot[-1][0], i + 20)) and (
                                chars is None or set(text[hot[-1][0]:i + 20]) <= set(chars)):
                            hot[-1][1] = i + 20
                        else:
                            hot.append([i, i + 20])
            out += [(kind, b, e) for b, e in hot if re.search("[0-9]", text[b:e]) and re.search("[A-Za-z]", text[b:e])]
    spans += [s for s in out if not any(b <= s[1] and s[2] <= e for _, b, e in known)]
    return sorted(spans, key=lambda s: (s[1], S.ORDER[s[0]]))


def test_spans_equal_those_of_every_window():
    rng = random.Random(5)
    parts = [KEY, KEY[:9], "password=", "AKIA" + "B7CD" * 4, "0a1b2c3d" * 4, "4f9", " ", "example", "/", "\n", "commit ", "xxxx",
             "123e4567-e89b-12d3-a456-426614174000", "0123456789", "-", "DEADbeef97531"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        assert S.secret_spans(text) == slow_spans(text), text


def test_many_finds_in_one_text_take_linear_time():
    import time

    rng = random.Random(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    pieces = ["password=" + "".join(rng.choices(letters, k=12)) + " " + "".join(rng.choices(letters, k=40)) for _ in range(20_000)]
    took = []
    for n in (2_500, 20_000):
        start = time.perf_counter()
        assert len(S.secret_spans("\n".join(pieces[:n]))) >= 1.9 * n
        took.append(time.perf_counter() - start)
    assert took[1] < 20 * took[0] + 0.5
    # One candidate of many hexadecimal stretches.
    long = "/".join("".join(rng.choices("0123456789abcdef", k=24)) for _ in range(20_000))
    start = time.perf_counter()
    assert len(S.secret_spans(long)) > 15_000
    assert time.perf_counter() - start < 30
