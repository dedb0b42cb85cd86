"""Batched kNN (M11, M12, A17, T5, T6) against a brute-force Python scorer."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions.text import tokens_letters
from sparkloom.operators import knn
from sparkloom.operators import vocab as V

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def _corpus(n=60, seed=3):
    rng = np.random.default_rng(seed)
    docs = []
    for d in range(n):
        group = d % 3
        pool = WORDS[group * 4: group * 4 + 4] + WORDS[:2]
        docs.append((d, " ".join(rng.choice(pool, size=int(rng.integers(3, 12))))))
    cats = [(d, f"c{d % 3}") for d in range(n)] + [(d, "extra") for d in range(0, n, 7)]
    return docs, cats


QUERIES = [(0, "alpha beta gamma"), (1, "epsilon zeta zeta"), (2, "iota kappa mu mu"),
           (3, "nothing known here"), (4, "alpha")]


def _tok(t):
    return re.sub("[^a-zA-Z]", " ", t).lower().split()


def _brute(docs, cats, queries, k, cosine=False, vocab_k=20000):
    c = Counter(w for _, t in docs for w in _tok(t))
    voc = {w for w, _ in sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:vocab_k]}
    n = len(docs)
    dfreq = Counter(w for _, t in docs for w in set(_tok(t)) if w in voc)

    def vec(t):
        ws = [w for w in _tok(t) if w in voc]
        return {w: cnt / len(ws) * math.log(n / dfreq[w]) for w, cnt in Counter(ws).items()}

    dvec = {d: vec(t) for d, t in docs}
    out = {}
    for q, t in queries:
        qv = vec(t)
        if not qv:
            continue
        rows = []
        for d, cat in cats:
            if d not in dvec:
                continue
            s = sum(qv[w] * dvec[d].get(w, 0.0) for w in qv)
            if cosine:
                nq = math.sqrt(sum(v * v for v in qv.values()))
                nd = math.sqrt(sum(v * v for v in dvec[d].values()))
                s = s / (nq * nd) if nq and nd else 0.0
            rows.append((-round(s, 9), cat, d))
        top = sorted(rows)[:k]
        votes = Counter(cat for _, cat, _ in top)
        out[q] = sorted(votes.items(), key=lambda kv: (-kv[1], kv[0]))
    return out


def _spark_votes(df):
    out = {}
    for r in df.orderBy("query_id", "vote_rank").collect():
        out.setdefault(r["query_id"], []).append((r["category"], r["votes"]))
    return out


@pytest.fixture(scope="module")
def frames(spark):
    docs, cats = _corpus()
    return (docs, cats, spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(cats, "doc_id long, category string"),
            spark.createDataFrame(QUERIES, "query_id long, text string"))


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_knn_text_equals_brute_force(spark, frames, metric):
    docs, cats, ddf, cdf, qdf = frames
    got = _spark_votes(knn.knn_text(None, ddf, cdf, qdf, k=10, metric=metric))
    assert got == _brute(docs, cats, QUERIES, 10, cosine=metric == "cosine")
    assert 3 not in got  # a query without a dictionary word has no result


def _vectors(ddf, cdf, qdf):
    model = V.TfIdfModel.fit(ddf, tokens_letters("text"), 20000)
    dvec = model.transform(ddf, tokens_letters("text")).select("doc_id", "pos", F.col("tfidf").alias("w"))
    cand = knn.long_to_arrays(dvec, "doc_id").join(cdf, "doc_id").select(
        F.col("doc_id").alias("id"), "category", "idx", "val")
    return cand, model.transform(qdf, tokens_letters("text"), "query_id").select(
        "query_id", "pos", F.col("tfidf").alias("w"))


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_many_blocks_equal_one(spark, frames, metric):
    """More query cells than a block holds, and more candidates."""
    cand, qvec = _vectors(*frames[2:])
    assert qvec.count() > 3
    one = sorted(tuple(r) for r in knn.top_k_neighbours(cand, qvec, k=7, metric=metric).collect())
    many = sorted(tuple(r) for r in knn.top_k_neighbours(cand, qvec, k=7, metric=metric, block_cells=3).collect())
    assert one == many and len(one) == 4 * 7


def test_plan_shuffles_the_queries(spark, frames):
    cand, qvec = _vectors(*frames[2:])
    plan = knn.top_k_neighbours(cand, qvec, k=7)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" in plan and "Broadcast" not in plan


def test_pieces_and_bounds_skip_only_losers(monkeypatch):
    """Small pieces, so that bounds are used; skewed norms, so that they skip something."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    monkeypatch.setattr(knn, "_MAX_SCORE_CELLS", 30)
    scored = []
    for kind, cosine in ((knn.SparseQueries, False), (knn.SparseQueries, True), (knn.DenseQueries, False), (knn.DenseQueries, True)):
        x = rng.normal(size=(200, 6)) * rng.pareto(1.5, size=(200, 1))
        q = np.concatenate([rng.normal(size=(5, 6)), np.zeros((1, 6))])
        x[:4] = 0.0
        x[10:20] = x[30]  # ties
        cats = [f"c{i % 3}" for i in range(200)]

        def arrays(m):
            return {"idx": pa.array([list(range(6))] * len(m), pa.list_(pa.int32())), "val": pa.array(m.tolist()), "vector": pa.array(m.tolist())}

        calls = []
        real = kind.scores
        monkeypatch.setattr(kind, "scores", lambda self, rows, active: calls.append(int(active.sum())) or real(self, rows, active))
        got = knn._meet(kind, 4, cosine, 9)(
            pa.table({"id": np.arange(200), "category": cats, **arrays(x)}), pa.table({"query_id": np.arange(6) + 100, **arrays(q)}))
        monkeypatch.undo()
        monkeypatch.setattr(knn, "_MAX_SCORE_CELLS", 30)
        s = x @ q.T
        if cosine:
            size = np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(q, axis=1))
            s = np.divide(s, size, out=np.zeros_like(s), where=size > 0)
        want = []
        for j in range(6):
            best = sorted((-round(float(v), 9) + 0.0, cats[i], i) for i, v in enumerate(s[:, j]))[:4]
            want += [(100 + j, i, c, -v) for v, c, i in best]
        rows = got.to_pylist()
        assert sorted((r["query_id"], r["id"]) for r in rows) == sorted(w[:2] for w in want)
        assert np.allclose(sorted(r["score"] for r in rows), sorted(w[3] for w in want), atol=2e-9)
        scored.append(sum(calls))
    assert scored[0] < scored[1] and scored[2] < scored[3]


def test_dense_knn_equals_numpy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(80, 5)).round(3)
    labels = rng.integers(0, 4, size=80)
    q = rng.normal(size=(6, 5)).round(3)
    rows = [(i, [float(v) for v in x[i]], f"l{labels[i]}") for i in range(80)] + [(90, None, "l0"), (91, [9.0] * 5, None)]
    cand = spark.createDataFrame(rows, "id long, vector array<double>, category string")
    queries = spark.createDataFrame([(j, q[j].tolist()) for j in range(6)], "query_id long, vector array<double>")
    for block in (10, 10_000):
        got = {}
        for r in knn.top_k_dense(cand, queries, k=5, block_values=block).collect():
            got.setdefault(r["query_id"], []).append((r["nn_rank"], r["id"]))
        for j in range(6):
            s = x @ q[j]
            order = sorted(range(80), key=lambda i: (-round(float(s[i]), 9), f"l{labels[i]}", i))[:5]
            assert [i for _, i in sorted(got[j])] == order
    assert knn.top_k_dense(cand, queries.limit(0)).count() == 0 and knn.top_k_dense(cand.limit(0), queries).count() == 0


def test_scores_of_a_piece_are_bounded():
    import pyarrow as pa

    def vectors(n):
        return pa.table({"vector": pa.array([[float(i), 1.0] for i in range(n)], pa.list_(pa.float64()))})

    block = knn.DenseQueries(vectors(1000), vectors(5000), False)
    pieces = list(block.pieces())
    assert max(map(len, pieces)) * block.count <= 1_000_000 and sorted(np.concatenate(pieces).tolist()) == list(range(5000))
