import pytest

import corpus_pipeline as P
from barforge.llm import mixing, secrets
from tests.llm.test_decontaminate import slow_leaks
from tests.llm.test_simhash import slow_components, slow_fingerprint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows, written and read as the checks do."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for k, (_, stage) in enumerate(P.STAGES):
        made = stage(spark, docs, FOLDER)
        if k < len(P.STAGES) - 1:
            assert made.columns == docs.columns and made.dtypes == docs.dtypes
        made.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs.collect())
    return out


def test_quality_keeps_good_rows_and_rejects_junk(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1]}
    assert kept <= {r.doc_id for r in stages[0]}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in kept for d in good) >= 0.95 * len(good)
    assert sum(d in kept for d in bad) <= 0.3 * len(bad)


def test_one_document_of_each_group_of_copies_stays(stages):
    rows = slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in stages[1]], 3)
    assert sorted(r.doc_id for r in stages[2]) == sorted({r[2] for r in rows})


def test_documents_with_benchmark_passages_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaks = {d for d, _ in slow_leaks([(r.doc_id, r.text) for r in stages[2]], items)}
    assert leaks and sorted(r.doc_id for r in stages[3]) == sorted({r.doc_id for r in stages[2]} - leaks)
    before = {r.doc_id: r for r in stages[2]}
    assert all(before[r.doc_id] == r for r in stages[3])


def test_secrets_are_masked_and_nothing_else(stages):
    after = {r.doc_id: r for r in stages[4]}
    assert len(after) == len(stages[3])
    for r in stages[3]:
        assert after[r.doc_id].text == secrets.redacted(r.text) and after[r.doc_id].n_chars == len(after[r.doc_id].text)


def test_the_mixture_holds_the_planned_copies(spark, stages):
    docs = spark.createDataFrame(stages[4])
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(docs).collect()}
    got = {}
    for r in stages[5]:
        got.setdefault(r.doc_id, []).append(r.copy)
    assert {d: len(c) for d, c in got.items()} == {d: n for d, n in plan.items() if n}
    assert all(len(set(c)) == len(c) for c in got.values())


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(repr, P.run(spark, FOLDER).collect())) == sorted(map(repr, stages[5]))


def test_rows_that_are_hard_to_handle(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing names and empty tables pass all stages."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard string, stats string"
    rows = [(1, None, None, None, None, "a", "b"), (None, "", "en", "s", 0, None, None), (2, "word " * 30_000, "en", "s", 1, "a", None),
            (3, "the house of the river", "en", "s", 1, "a", None), (3, "the house of the river", "en", "s", 1, "a", None)]
    for name, data in (("all", rows), ("none", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        got = P.run(spark, folder).collect()
        assert {r.doc_id for r in got} <= {1, 2, 3, None} and bool(got) == bool(data)
