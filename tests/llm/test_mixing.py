from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barforge.llm import mixing as M


def test_targets_are_capped_and_reshared():
    assert M.target_words([100, 100, 100], (5, 2, 1), 3) == pytest.approx([187.5, 75, 37.5])
    got = M.target_words([10, 10, 1000, 0], (5, 2, 1), 3)
    assert got == pytest.approx([30, 30, 960, 0]) and sum(got) == pytest.approx(1020)
    assert M.target_words([], (), 3) == [] and M.target_words([0, 0], (1, 1), 3) == [0, 0]


def test_the_tree_uses_up_every_quota_and_keeps_proportions():
    quotas = np.array([5000, 0, 1200, 3])
    dealt = M.split_quotas(quotas, 13, seed=1)
    assert (dealt.sum(axis=0) == quotas).all() and (dealt >= 0).all()
    assert np.ptp(dealt.sum(axis=1)) <= 13
    assert np.abs(dealt[:, 0] / dealt.sum(axis=1) - 5000 / 6203).max() < 0.1
    assert (M.split_quotas(quotas, 13, seed=1) == dealt).all()
    assert (M.split_quotas(quotas, 13, seed=2) != dealt).any()


def _docs(spark, n=600):
    rng = np.random.default_rng(0)
    rows = [(i, "w " * int(rng.integers(1, 60)), [None, "a", "b", "é", "Z"][min(4, int(rng.integers(0, 9)))], "x")
            for i in range(n)]
    rows += [(n, None, "a", "x"), (None, "w w", None, "x"), (n + 1, "", "b", None), (5, "w", "only", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string"), rows


def test_words_taken_come_near_targets(spark):
    docs, rows = _docs(spark)
    got = M.mix_plan(docs).collect()
    assert len(got) == len(rows)
    names = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    sizes = Counter()
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    targets = dict(zip(names, M.target_words([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 3)))
    source = {(r[0], len((r[1] or "").split())): r[2] for r in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id, r.size]
        assert (r.source_size, r.target) == (sizes[s], targets[s]) and 0 <= r.copies <= 3
        taken[s] += r.size * r.copies
    for s in names:
        assert abs(taken[s] - targets[s]) <= 60, s
    assert sorted(got, key=repr) == sorted(M.mix_plan(docs.repartition(7)).collect(), key=repr)


def test_cuts_equal_running_sums(spark, monkeypatch):
    monkeypatch.setattr(M, "LEVEL_BITS", 5)
    docs, _ = _docs(spark)
    mixture, sized = M.fit_mixture(docs)
    by = defaultdict(list)
    for r in sized.collect():
        by[r.source].append((r["rank"], r["size"]))
    for row in mixture.sources.itertuples():
        aim, upto, best = row.target - row.passes * row.source_size, 0, 0
        ranked = sorted(by[row.source])
        for rank, n in ranked:
            if abs(upto + n - aim) < abs(upto - aim):
                best = upto + n
            upto += n
        assert sum(n for rank, n in ranked if rank < row.cut) == best


def test_shards_hold_all_copies_and_follow_the_tree(spark):
    docs, _ = _docs(spark)
    mixture, sized = M.fit_mixture(docs, shard_words=1500, block_rows=4)
    copies = {(r.doc_id, r["size"]): r.copies for r in mixture.plan(sized).collect()}
    out = mixture.mixed(docs)
    assert out.columns == ["doc_id", "text", "source", "size", "shard", "copy"]
    rows = out.collect()
    seen = Counter((r.doc_id, len((r.text or "").split())) for r in rows)
    assert seen == Counter({k: n for k, n in copies.items() if n})
    assert len({(r.doc_id, r.text, r.copy) for r in rows}) == len(rows)
    assert mixture.shards > 5 and {r.shard for r in rows} == set(range(mixture.shards))
    per = Counter(r.shard for r in rows)
    assert max(per.values()) < 2.2 * min(per.values())
    assert rows == mixture.mixed(docs.repartition(5)).collect()
    by_shard = [r.doc_id for r in rows if r.shard == 0]
    assert by_shard != sorted(by_shard, key=lambda i: (i is None, i or 0))


def test_empty_table_and_tables_without_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix_plan(empty).count() == 0 and M.mix_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r.copies for r in M.mix_plan(blank).collect()] == [0, 0]


def test_too_many_sources_are_refused(spark, monkeypatch):
    monkeypatch.setattr(M, "MAX_SOURCES", 2)
    with pytest.raises(ValueError, match="sources"):
        M.mix_plan(_docs(spark)[0])


def test_shards_grow_where_quotas_would_be_too_many(spark, monkeypatch):
    docs, _ = _docs(spark)
    assert M.fit_mixture(docs, shard_words=100)[0].shards > 50
    monkeypatch.setattr(M, "MAX_QUOTAS", 60)
    assert M.fit_mixture(docs, shard_words=100)[0].shards == 10


def test_words_are_counted_in_the_dealt_mixture(spark, monkeypatch):
    docs, rows = _docs(spark)
    docs = docs.unionByName(docs.where("doc_id < 20"))
    plan = M.mix_plan(docs, shard_words=1500, block_rows=4).collect()
    want = Counter((r.doc_id, r["size"], r.source_size, r.target, r["size"] * r.copies) for r in plan)
    assert Counter(map(tuple, M.words_taken(docs, shard_words=1500, block_rows=4).collect())) == want
    whole = M.Mixture.mixed
    monkeypatch.setattr(M.Mixture, "mixed", lambda self, docs: whole(self, docs).where("shard <> 1"))
    kept = {r[0] for r in M.words_taken(docs, shard_words=1500, block_rows=4).where("taken > 0").collect()}
    assert kept < {k[0] for k in want if k[4]}


def test_the_query_follows_the_dealt_mixture(spark, monkeypatch):
    from barforge.llm.queries import QUERIES

    monkeypatch.setattr(M.Mixture, "mixed", lambda self, docs: docs.select("*", *(F.lit(0).alias(c) for c in ("shard", "copy"))).limit(0))
    assert {r.taken for r in QUERIES["op1_mixing"](spark, "/root/testdata/sf0.001").collect()} == {0}


def test_quotas_of_more_than_a_billion_blocks_are_split(monkeypatch):
    quotas = np.array([600_000_000, 0, 600_000_000, 7, 3_000_000_000_000])
    dealt = M.split_quotas(quotas, 5, seed=3)
    assert (dealt.sum(axis=0) == quotas).all() and (dealt >= 0).all() and np.ptp(dealt.sum(axis=1)) <= 5
    assert np.abs(dealt[:, 0] / 120_000_000 - 1).max() < 0.001
    assert (M.split_quotas(quotas, 5, seed=3) == dealt).all()


def test_draws_from_large_urns_are_distributed_like_small_ones(monkeypatch):
    monkeypatch.setattr(M, "URN", 0)
    draw = np.random.default_rng(4)
    good, bad, sample, n = 30, 50, 24, 4000
    got = [M._marked(draw, good, bad, sample, tries=64) for _ in range(n)]
    p, total = good / (good + bad), good + bad
    spread = sample * p * (1 - p) * (total - sample) / (total - 1)
    assert abs(np.mean(got) - sample * p) < 4 * (spread / n) ** 0.5
    assert abs(np.var(got) / spread - 1) < 0.12
    for good, bad, sample, want in ((0, 5, 3, 0), (5, 0, 3, 3), (4, 5, 9, 4), (4, 5, 0, 0)):
        assert M._marked(draw, good, bad, sample) == want
    assert M._share(draw, np.array([3, 0, 9, 2]), 6).sum() == 6
