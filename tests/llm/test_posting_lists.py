"""Nearest vectors: recall against brute force, exact scores, the graph, balance, edges."""

from __future__ import annotations

import numpy as np
import pytest
from helpers import table

from sparkloom.llm import posting_lists
from sparkloom.llm.posting_lists import CentroidGraph, Settings, balanced_centroids, nearest
from sparkloom.llm.queries import op11_nearest_vectors

SF1 = "/root/testdata/sf0.1"


def usable(rows):
    """Vectors of ``(id, vector)`` rows by id, after the rules of the docstring."""
    kept = [(i, np.array(v, np.float64)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    sizes = [len(v) for _, v in kept]
    most = max(set(sizes), key=lambda n: (sizes.count(n), n)) if sizes else 0
    out = {}
    for i, v in kept:
        if len(v) == most:
            out.setdefault(i, []).append(v)
    return out


def brute(rows, every, k):
    vectors = usable(rows)
    out = []
    for q in vectors:
        if q % every == 0:
            own = min(vectors[q], key=list)
            far = sorted((min(float(np.sqrt(((own - v) ** 2).sum())) for v in vs), i) for i, vs in vectors.items() if i != q)
            out += [(q, r, i, d) for r, (d, i) in enumerate(far[:k], 1)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def same(found, want):
    return [x[:3] for x in found] == [x[:3] for x in want] and np.allclose([x[3] for x in found], [x[3] for x in want], rtol=1e-13, atol=0)


def test_query_recall_and_scores(spark):
    rows = table("embeddings", SF1, "vec_id, embedding")
    want = brute(rows, 100, 10)
    df = op11_nearest_vectors(spark, SF1)
    assert dict(df.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    found = got(df)
    assert len(found) == len(want)
    true = {(q, i) for q, _, i, _ in want}
    assert np.mean([(q, i) in true for q, _, i, _ in found]) >= 0.95
    vectors = usable(rows)
    for q, _, i, d in found:
        assert q != i and d == pytest.approx(np.sqrt(((vectors[q][0] - vectors[i][0]) ** 2).sum()), rel=1e-13)
    for q in {f[0] for f in found}:
        own = [(d, i) for x, _, i, d in found if x == q]
        assert own == sorted(own) and [r for x, r, _, _ in found if x == q] == list(range(1, 11))


def clustered(n=3000, d=12, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(40, d)) * 5
    return [(i, (centers[int(rng.integers(0, 40))] + rng.normal(size=d)).tolist()) for i in range(n)]


def test_clustered_vectors_with_many_lists(spark):
    rows = clustered()
    want = brute(rows, 20, 7)
    cfg = Settings(k=7, list_rows=20, sample_rows=1500, replicas=3, probes=16, ratio=1.6, degree=6, block=8)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    index = posting_lists.build(frame, cfg=cfg)
    assert index.lists > 50 and index.blocks > 1
    assert {r.first for r in index.postings().select("first").distinct().collect()} == {i for i, _ in rows}  # every row
    found = got(posting_lists.search(index, index.rows.filter("vec_id % 20 = 0")))
    true = {x[:1] + x[2:3] for x in want}
    assert len(found) == len(want) and np.mean([x[:1] + x[2:3] in true for x in found]) >= 0.95


def test_copies_ties_and_a_hot_vector(spark):
    rng = np.random.default_rng(1)
    base = [rng.normal(size=4).round(1).tolist() for _ in range(30)]
    rows = [(i, base[0] if i % 3 == 0 else base[int(rng.integers(0, 30))]) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    want = brute(rows, 10, 10)
    cfg = Settings(list_rows=100, block=3, probes=64, ratio=100.0)
    assert same(got(nearest(frame, every=10, cfg=cfg)), want)
    index = posting_lists.build(frame, cfg=cfg)
    assert index.postings().groupBy("list", "block").count().agg({"count": "max"}).first()[0] <= 30
    asked = index.rows.filter("vec_id % 10 = 0").select("vec_id", "key")
    found = spark.createDataFrame([(k.key, [(0.0, i) for i in range(11)]) for k in asked.select("key").distinct().collect()],
                                  "query binary, found array<struct<score:double,vec_id:long>>")
    spread = posting_lists._answers(asked, found, 10, share=4)
    assert spread.count() == 10 * asked.count()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0]), (200, [1.0, 1.0]), (200, [1.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [1.0, None]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (10, [-0.0, 3.0]), (11, [0.0, 3.0]),
            (12, [2.0, 0.0]), (12, [0.0, 1.0]), (300, [0.0, -2.0]), (300, [5.0, 5.0]), (-100, [1.0, 0.0]), (0, [4.0, 4.0])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, key string, rank int")
    found = got(nearest(frame))
    assert same(found, brute(rows, 100, 10)) and {x[0] for x in found} == {100, 200, 300, -100, 0}
    assert nearest(frame.limit(0)).count() == 0
    assert nearest(frame.filter("vec_id = 3")).count() == 0
    assert nearest(frame.filter("vec_id = 100")).count() == 0  # no candidate but itself


def test_balanced_centroids():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(900, 6)), rng.normal(size=(100, 6)) * 0.01 + 9])
    for lists in (1, 2, 7, 50):
        assert balanced_centroids(x, lists).shape == (lists, 6)
    c = balanced_centroids(x, 50)
    assert 4 <= (np.linalg.norm(c - 9, axis=1) < 1).sum() <= 6  # a tenth of the rows, a tenth of the lists
    assert len(balanced_centroids(x[:1], 5)) == 1


@pytest.mark.parametrize("n, beam", [(1, 5), (2, 1), (30, 64), (700, 20)])
def test_graph_search_finds_nearest_centroids(n, beam):
    rng = np.random.default_rng(n)
    c = rng.normal(size=(n, 8))
    c[n // 2 :] += 50  # a graph in two components
    q = np.concatenate([rng.normal(size=(300, 8)), rng.normal(size=(20, 8)) + 50])
    lists, far = CentroidGraph(c, 8).nearest(q, beam)
    true = np.sqrt(((q[:, None] - c[None]) ** 2).sum(2))
    near = min(beam, n // 2 or 1)
    assert lists.shape == (320, beam) and (lists[:, min(beam, n) :] == -1).all()
    hit = [len(set(a[:near].tolist()) & set(np.argsort(t)[:near].tolist())) / near for a, t in zip(lists, true)]
    assert np.mean(hit) > 0.95
    kept = lists >= 0
    assert np.allclose(far[kept], np.take_along_axis(true, np.maximum(lists, 0), 1)[kept], atol=1e-3)
    assert (far[:, 1:] >= far[:, :-1])[kept[:, 1:]].all()
