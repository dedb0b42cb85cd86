from __future__ import annotations

from collections import defaultdict

import pytest
from helpers import NASTY, SF, space_words, table

from sparkloom.llm import mixing
from sparkloom.llm.queries import op2_mixing


def expected_targets(rows):
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len(space_words(text))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free, left, out = set(order), float(sum(size.values())), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * size[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            out[s] = 3.0 * size[s]
            free.remove(s)
        left -= sum(3 * size[s] for s in over)
    return size, out


def check(rows, got):
    size, target = expected_targets(rows)
    assert sorted((repr(r.doc_id), r.size) for r in got) == sorted((repr(d), len(space_words(t))) for d, t, _ in rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6


def test_query_meets_targets_and_repeats(spark):
    rows = table("documents", columns="doc_id, text, source")
    got = op2_mixing(spark, SF).collect()
    check(rows, got)
    assert sorted(map(repr, got)) == sorted(map(repr, op2_mixing(spark, SF).collect()))


def test_edges(spark):
    rows = [(i, t, "b") for i, t in enumerate(NASTY)] + [(None, "x y z", None), (5, "a b", None)]
    rows += [(7, "same row here", "a")] * 50 + [(100 + i, "w " * (i % 9 + 1), "A") for i in range(300)] + [(9, None, "empty")]
    docs = spark.createDataFrame([(d, t, s, 1) for d, t, s in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix(docs, block=4).collect()
    check(rows, got)
    assert mixing.mix(docs.limit(0)).count() == 0
    full = mixing.mix_documents(docs, block=4)
    assert full.columns[:4] == docs.columns
    assert sorted(repr((r.doc_id, r.mix_size, r.mix_copies)) for r in full.collect()) == sorted(
        repr((r.doc_id, r.size, r.copies)) for r in got)


def test_draws_are_unbiased(spark):
    rows = [(i, "w " * (1 + i % 5), "a" if i < 60 else "b") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
    hits = defaultdict(float)
    for seed in range(12):
        for r in mixing.mix(docs, seed=seed, block=64).collect():
            hits[r.source, r.size] += r.taken / 12
    size, target = expected_targets(rows)
    for (s, n), t in hits.items():
        share = sum(1 for d, x, q in rows if q == s and len(space_words(x)) == n) * n / size[s]
        assert t == pytest.approx(target[s] * share, rel=0.45)


def test_join_and_window_share_one_exchange(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mixing.mix_documents(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert plan.count("Exchange hashpartitioning") == 2  # documents and units, once each
