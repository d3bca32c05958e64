import random
import re

import pytest

from barforge.llm import licenses as L
from barforge.llm.queries import QUERIES


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_places(text, templates):
    words, out = words_of(text), []
    for t in templates:
        part = t.split()
        out += [i for i in range(len(words) - len(part) + 1) if words[i:i + len(part)] == part]
    return sorted(out)


def _texts(n=120, seed=3):
    rng = random.Random(seed)
    parts = ["Under the MIT License", "under the mit\nlicence", "Apache License, Version 2.0", "CC-BY-NC 4.0", "cc by", "nc",
             "GNU General Public License, version 3", "the", "mit", "license", "été", "under", "apache", "version 2",
             "K", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"]
    return [rng.choice([" ", ", ", "\n"]).join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("rare_words", [1, 8])
def test_phrases_are_found_at_every_place(spark, rare_words):
    texts = _texts() + [None, "", "x " * 40_000 + "CC BY NC"]
    docs = spark.createDataFrame([(i % 50, t, "y") for i, t in enumerate(texts)], "doc_id int, text string, licenses string")
    got = L.scan_licenses(docs, rare_words=rare_words).collect()
    assert len(got) == len(texts)
    phrases = [t.text for t in L.PHRASES]
    want = sorted((len(words_of(t)), slow_places(t, phrases)) for t in texts)
    assert sorted((r.n_words, sorted(p.start for p in r.licenses if p.base)) for r in got) == want
    assert sum(len(w[1]) for w in want) > 100


def test_templates_need_their_key_phrase_and_most_rare_words(spark):
    mit = next(t.text for t in L.TEMPLATES if t.label == "mit" and t.keys)
    changed = mit.replace("deal", "work").replace("person", "body")
    texts = [mit, "We say: " + changed.upper() + "!", mit.replace("hereby", "not"), "permission is hereby granted free of charge",
             "GNU general public license, version 3 applies", "gnu public license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [(p.label, p.start) for p in r.licenses] for r in L.scan_licenses(docs).collect()}
    assert got == {0: [("mit", 0)], 1: [("mit", 2)], 2: [], 3: [], 4: [("gpl-3", 0)], 5: []}


def test_counts_of_documents(spark):
    docs = spark.createDataFrame([("the MIT the mit",), ("mit",), (None,), ("",)], "text string")
    assert L.document_counts(docs, ["mit", "the", "gnu"]) == {"mit": 2, "the": 1}


def test_empty_table_and_no_templates(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    assert L.scan_licenses(docs.limit(0)).count() == 0
    assert [(r.n_words, r.licenses) for r in L.scan_licenses(docs, ()).collect()] == [(2, [])]


def test_query_equals_the_plain_rules(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    named = {t.text: t.label for t in L.PHRASES}
    got = QUERIES["op9_licenses"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        places = {p: slow_places(texts[r.doc_id], [p]) for p in named}
        starts = sorted(sum(places.values(), []))
        assert (r.n_words, r.n_base) == (len(words_of(texts[r.doc_id])), len(starts))
        assert (r.first_word, r.last_word) == ((starts[0], starts[-1]) if starts else (None, None))
        base = sorted({named[p] for p, s in places.items() if s})
        assert r.base_labels == ",".join(base) and set(base) <= set(r.labels.split(",") if r.labels else [])
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
