"""Gibbs topic model (M19-M21) and evaluation reports."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkloom.functions.text import tokens_letters
from sparkloom.operators import evaluate as E
from sparkloom.operators import topics as TP
from sparkloom.operators import vocab as V

GROUPS = [
    "apple banana cherry grape lemon mango".split(),
    "engine wheel brake clutch piston gear".split(),
    "violin cello flute oboe trumpet harp".split(),
]


def _planted(n_per=30, seed=11):
    rng = np.random.default_rng(seed)
    docs = []
    for g, words in enumerate(GROUPS):
        for i in range(n_per):
            docs.append((g * 1000 + i, " ".join(rng.choice(words, size=15)), g))
    return docs


def uniform(*parts):
    return (int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def plain_log_gamma(a, *key):
    d = (a + 1 if a < 1 else a) - 1 / 3
    out = math.log(d)
    for i in range(TP.GAMMA_TRIALS):
        h = hashlib.md5(":".join(map(str, (*key, i))).encode()).hexdigest()
        u = [(int(h[s : s + 10], 16) + 0.5) / 2**40 for s in (0, 10, 20)]
        x = math.sqrt(-2 * math.log(u[0])) * math.cos(2 * math.pi * u[1])
        root = 1 + x / math.sqrt(9 * d)
        if root > 0 and math.log(u[2]) < x * x / 2 + d - d * root**3 + 3 * d * math.log(root):
            out = math.log(d) + 3 * math.log(root)
            break
    return out + (math.log(uniform(*key, "boost")) / a if a < 1 else 0)


@pytest.mark.parametrize("a", [0.05, 0.7, 1.0, 3.5, 400.0])
def test_gamma_draws(a):
    n = 4000
    got = TP.log_gamma_draws(np.full(n, a), [f"7:2:{i}" for i in range(n)])
    assert got[:300] == pytest.approx([plain_log_gamma(a, 7, 2, i) for i in range(300)], rel=1e-9)
    draws = np.exp(got)
    assert draws.mean() == pytest.approx(a, abs=5 * math.sqrt(a / n))
    assert draws.var() == pytest.approx(a, rel=0.6 if a < 1 else 0.15)


def test_hash_uniforms_in_open_interval():
    u = TP.hash_uniforms([f"7:3:{i}:1" for i in range(2000)])
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.03
    assert u[:50].tolist() == [uniform(7, 3, i, 1) for i in range(50)]


def test_assign_step_posterior(spark):
    docs = _planted(5)
    ddf = spark.createDataFrame([(d, t) for d, t, _ in docs], "doc_id long, text string")
    vocab = V.Vocabulary.fit(ddf, tokens_letters("text"), 100)
    arrays = TP.doc_term_arrays(ddf, tokens_letters("text"), vocab)
    v = vocab.table.count()
    rng = np.random.default_rng(1)
    lm, lp = np.log(rng.dirichlet(np.ones(v), 3)), np.log(rng.dirichlet(np.ones(3)))
    params = spark.createDataFrame([(int(k), float(lp[k]), lm[k].tolist()) for k in (2, 0, 1)], "cluster int, log_pi double, log_mu array<double>")
    out = TP.assign_step(arrays, params, seed=5, iteration=0).toPandas()
    assert len(out) == len(docs)
    # recompute one document's posterior in NumPy
    pdf = arrays.toPandas().set_index("doc_id")
    for _, r in out.head(5).iterrows():
        idx, cnt = pdf.loc[r["doc_id"], "idx"], pdf.loc[r["doc_id"], "cnt"]
        s = lp + np.array([np.sum(np.asarray(cnt) * lm[k, np.asarray(idx)]) for k in range(3)])
        p = np.exp(s - s.max())
        p /= p.sum()
        assert r["posterior"] == pytest.approx(p[int(r["cluster"])], rel=1e-9)
        u = [uniform(5, 0, int(r["doc_id"]), k) for k in range(3)]
        assert r["cluster"] == np.argmax(s - np.log(-np.log(u)))


def test_document_without_words_keeps_prior(spark):
    ddf = spark.createDataFrame([(1, "apple apple"), (2, "1234 !!")], "doc_id long, text string")
    vocab = V.Vocabulary.fit(ddf, tokens_letters("text"), 10)
    arrays = TP.doc_term_arrays(ddf, tokens_letters("text"), vocab)
    got = {r["doc_id"]: list(r["idx"]) for r in arrays.collect()}
    assert got == {1: [0], 2: []}


def test_gibbs_recovers_planted_clusters_and_is_seeded(spark):
    docs = _planted()
    ddf = spark.createDataFrame([(d, t) for d, t, _ in docs], "doc_id long, text string")
    vocab = V.Vocabulary.fit(ddf, tokens_letters("text"), 100)
    arrays = TP.doc_term_arrays(ddf, tokens_letters("text"), vocab)
    model = TP.fit_gibbs(arrays, vocab, k=3, alpha=1.0, beta=0.1, iterations=15, seed=3)
    assign = {r["doc_id"]: r["cluster"] for r in model.assignments().collect()}
    truth = {d: g for d, _, g in docs}
    # each planted group maps to a single cluster, and different groups to different ones
    mapping = {g: Counter(assign[d] for d in truth if truth[d] == g).most_common(1)[0] for g in range(3)}
    assert all(cnt == 30 for _, cnt in mapping.values())
    assert len({c for c, _ in mapping.values()}) == 3
    again = TP.fit_gibbs(arrays, vocab, k=3, alpha=1.0, beta=0.1, iterations=15, seed=3)
    mu = [{r.cluster: (r.log_pi, r.log_mu) for r in m.params.collect()} for m in (model, again)]
    assert mu[0] == mu[1] and all(sum(math.exp(x) for x in lm) == pytest.approx(1) for _, lm in mu[0].values())
    top = model.top_words(3).toPandas()
    for g, (c, _) in mapping.items():
        assert set(top[top["topic"] == c]["word"]) <= set(GROUPS[g])


def test_short_fit_equals_plain_python(spark):
    """Three sweeps, every draw repeated from the hashes; a block of documents without words."""
    docs = [(d, t) for d, t, _ in _planted(6)] + [(7777, "123")]
    ddf = spark.createDataFrame(docs, "doc_id long, text string")
    vocab = V.Vocabulary.fit(ddf, tokens_letters("text"), 100).materialized()
    k, alpha, beta, seed = 4, 0.3, 0.2, 9
    pos = {r.word: r.pos for r in vocab.table.collect()}
    v = len(pos)
    for fixed in (False, True):
        model = TP.fit_gibbs(TP.doc_term_arrays(ddf, tokens_letters("text"), vocab), vocab, k, alpha, beta, 3, seed, fixed_pi=fixed)
        chosen = None
        for it in range(4):
            n = Counter(chosen.values()) if chosen else Counter()
            words = Counter((chosen[d], pos[w]) for d, t in docs for w in t.split() if w in pos) if chosen else Counter()
            lp = [plain_log_gamma(alpha + (0 if fixed else n[c]), seed, 0 if fixed else it, c, -1) for c in range(k)]
            lm = np.array([[plain_log_gamma(beta + words[c, p], seed, it, c, p) for p in range(v)] for c in range(k)])
            lm -= np.log(np.exp(lm).sum(1, keepdims=True))
            if it < 3:
                chosen = {d: int(np.argmax([lp[c] + sum(lm[c, pos[w]] for w in t.split() if w in pos)
                                            - math.log(-math.log(uniform(seed, it + 1, d, c))) for c in range(k)])) for d, t in docs}
        assert {r.doc_id: r.cluster for r in model.assignments().collect()} == chosen
        for r in model.params.collect():
            assert r.log_pi == pytest.approx(lp[r.cluster]) and r.log_mu == pytest.approx(lm[r.cluster].tolist())


def test_sweeps_neither_shuffle_documents_nor_broadcast(spark):
    ddf = spark.createDataFrame([(d, t) for d, t, _ in _planted(3)], "doc_id long, text string")
    vocab = V.Vocabulary.fit(ddf, tokens_letters("text"), 100)
    docs, blocks = TP.in_blocks(TP.doc_term_arrays(ddf, tokens_letters("text"), vocab))
    assert docs.count() == 9 and not [t for t in spark.catalog.listTables() if t.name.startswith("sparkloom_")]
    params = TP.draw_parameters(TP.no_counts(spark, 3), 18, 0.1, 0.1, 1, 0)
    plan = TP.assign_step(None, params, 1, 1, blocked=(docs, blocks))._jdf.queryExecution().executedPlan().toString()
    side = plan.split("FlatMapCoGroupsInArrow")[1].split("Exchange")[0]  # the document side comes first
    assert "Bucketed: true" in side


def test_clusters_come_from_the_table(spark):
    """25 sources give 25 clusters, in the queries and in their SQL."""
    import duckdb

    from sparkloom.plans import topic_queries
    from sparkloom.plans.oracle import ORACLE_SQL

    rows = [(i, f"alpha beta gamma{i % 5} word{i % 25}", f"src{i % 25 + 3}") for i in range(100)] + [(100, "alpha beta", "none")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    made = topic_queries.table
    topic_queries.table = lambda *_: frame
    try:
        for query in (topic_queries.topic_cluster_counts, topic_queries.topic_words_fixed, topic_queries.topic_assign_step):
            df = query(spark, "")
            columns = sorted(df.columns)
            want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[query.__name__]})").fetchall()
            assert sorted(tuple(r) for r in df.select(*columns).collect()) == sorted(want)
        assert topic_queries.topic_cluster_counts(spark, "").select("cluster").distinct().count() == 25
    finally:
        topic_queries.table = made
    with pytest.raises(ValueError, match="clusters"):
        TP.known_clusters(frame.withColumn("cluster", F.col("doc_id")), most=50)


def test_full_grid_and_topic_words(spark):
    cells = spark.createDataFrame([(0, 0, 5), (0, 2, 1), (1, 1, 3)], "cluster int, pos int, cnt long")
    clusters = spark.createDataFrame([(0,), (1,), (2,)], "cluster int")
    grid = TP.full_grid_counts(cells, clusters, 3)
    assert grid.count() == 9
    vocab = V.Vocabulary(spark.createDataFrame([("a", 0, 9), ("b", 1, 8), ("c", 2, 7)], "word string, pos int, count long"), 3)
    words = TP.top_words_per_topic(grid, vocab, beta=0.1, n=2).toPandas()
    assert list(words[words.topic == 0].sort_values("rank")["word"]) == ["a", "c"]
    assert list(words[words.topic == 2].sort_values("rank")["word"]) == ["a", "b"]  # empty cluster: ties by pos
    assert words[words.topic == 0]["prob"].iloc[0] == pytest.approx(round(5.1 / 6.3, 9))


# ------------------------------------------------------------------ evaluation
def test_binary_summary_and_confusion(spark):
    rows = [(1, 0), (1, 0), (0, 0), (0, 1)]  # tp = 0
    df = spark.createDataFrame(rows, "label int, prediction int")
    s = E.binary_summary(df).first()
    assert (s["tp"], s["fp"], s["fn"], s["tn"], s["f1"]) == (0, 1, 2, 1, 0.0)
    df2 = spark.createDataFrame([(1, 1), (1, 1), (0, 1), (1, 0), (0, 0)], "label int, prediction int")
    s2 = E.binary_summary(df2).first()
    assert s2["f1"] == pytest.approx(2 * 2 / (2 * 2 + 1 + 1))
    cm = {(r["label"], r["prediction"]): r["n"] for r in E.confusion_counts(df2).collect()}
    assert cm == {(1, 1): 2, (0, 1): 1, (1, 0): 1, (0, 0): 1}
    pm = spark.createDataFrame([(1, 1), (-1, 1), (-1, -1)], "label int, prediction int")
    assert E.binary_summary(pm, positive=1).first()["f1"] == pytest.approx(2 / 3)


def test_false_positives_first_ids(spark):
    df = spark.createDataFrame([(i, 0, 1 if i % 2 else 0) for i in range(10, 0, -1)], "id int, label int, prediction int")
    assert [r["id"] for r in E.false_positives(df, "id").collect()] == [1, 3, 5]


def test_cluster_label_top_against_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"cluster": rng.integers(0, 5, 400), "label": rng.choice(list("abcdefg"), 400)})
    got = E.cluster_label_top(spark.createDataFrame(pdf)).toPandas()
    sizes = pdf.groupby("cluster").size()
    size_rank = {c: i + 1 for i, c in enumerate(sorted(sizes.index, key=lambda c: (-sizes[c], c)))}
    for c, g in pdf.groupby("cluster"):
        cnt = g["label"].value_counts()
        top = sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        mine = got[got.cluster == c].sort_values("label_rank")
        assert list(zip(mine["label"], mine["label_count"])) == top
        assert set(mine["size_rank"]) == {size_rank[c]}
        assert list(mine["share"]) == pytest.approx([n / len(g) for _, n in top])


def test_presence_rate_by_class(spark):
    docs = spark.createDataFrame([(1, "cat dog", 1), (2, "cat", 1), (3, "dog", 0), (4, "123", 0)],
                                 "doc_id long, text string, label int")
    out = {(r["word"], r["label"]): r["rate"] for r in
           E.presence_rate_by_class(docs, tokens_letters("text"), ["cat", "dog", "emu"]).collect()}
    assert out[("cat", 1)] == 1.0 and out[("dog", 1)] == 0.5 and out[("dog", 0)] == 0.5
    assert out[("cat", 0)] == 0.0 and out[("emu", 1)] == 0.0


def test_blocks_follow_cells_and_cores_not_shuffle_partitions(spark, monkeypatch):
    rows = spark.range(40).selectExpr("id AS doc_id", "array(0, 1, 2) AS idx", "array(1L, 1L, 2L) AS cnt")
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert len(TP.in_blocks(rows)[1]) == 1
        monkeypatch.setattr(TP, "LEAST_CELLS", 10)
        assert len(TP.in_blocks(rows)[1]) == cores
        monkeypatch.setattr(TP, "MOST_CELLS", 20)
        docs, keys = TP.in_blocks(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(set(keys)) == len(keys) == 8 and docs.count() == 40
    dealt = spark.createDataFrame([(k,) for k in keys], "k int").repartition(8, "k").select(F.spark_partition_id().alias("p"))
    assert dealt.distinct().count() == 8


def test_counts_of_many_blocks_are_merged(spark, monkeypatch):
    rows = [(0, [TP.PI, 0, 2], [3, 1, 4]), (0, [TP.PI, 2], [1, 5]), (1, [TP.PI], [0])]
    counts = spark.createDataFrame(rows, TP.COUNTS).repartition(3)
    monkeypatch.setattr(TP, "FAN", 2)

    def drawn(c):
        return sorted((r.cluster, r.log_pi, tuple(r.log_mu)) for r in TP.draw_parameters(c, 3, 0.1, 0.1, 1, 1).collect())

    merged = TP._merged(counts, 3, 3)
    assert merged.count() <= 4 and drawn(merged) == drawn(counts)


def test_md5_of_many_texts():
    import pyarrow as pa

    texts = [f"42:{i}:{i * 37 % 1000}" * (i % 3 + 1) for i in range(500)] + ["", "é" * 27, "a" * 55, "b" * 56, "c" * 200]
    want = [hashlib.md5(t.encode()).digest() for t in texts]
    assert [bytes(r) for r in TP.md5_digests(texts)] == want
    assert [bytes(r) for r in TP.md5_digests(pa.array(texts[:400]).slice(7, 300))] == want[7:307]


def _sweep(n=300, v=40, k=6, width=(0, 9)):
    """A block of random documents, and the dense counts of their words."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    cells = [np.sort(rng.choice(v, rng.integers(*width), replace=False)) for _ in range(n)]
    times = [rng.integers(1, 300, len(c)) for c in cells]
    dense = np.zeros((n, v))
    for row, c, x in zip(dense, cells, times):
        row[c] = x
    lists = [pa.array([x.tolist() for x in some], pa.list_(pa.int64())) for some in (cells, times)]
    docs = pa.table({"doc_id": pa.array([*range(n - 1), None], pa.int64()), "n": pa.array([len(c) for c in cells], pa.int32()),
                     "idx": TP._as_bytes(lists[0], np.dtype(np.uint8)), "cnt": TP._as_bytes(lists[1], np.dtype(np.uint16))})
    log_mu, log_pi = np.log(rng.dirichlet(np.ones(v), k)), np.log(rng.dirichlet(np.ones(k)))
    params = pa.table({"cluster": pa.array(range(k), pa.int32()), "log_pi": log_pi, "log_mu": pa.array(log_mu.tolist())})
    return TP._Sweep(docs, params, "3:1"), log_pi + dense @ log_mu.T, dense


@pytest.mark.parametrize("long", [0, 1000])
def test_pieces_of_a_block_and_skipped_draws(monkeypatch, long):
    """Documents one by one or together, in small pieces; the draws that cannot win are not made."""
    monkeypatch.setattr(TP, "LONG", long)
    monkeypatch.setattr(TP, "SCORED_CELLS", 16)
    monkeypatch.setattr(TP, "COUNTED_CELLS", 100)
    hashed, plain = [], TP.hash_uniforms
    monkeypatch.setattr(TP, "hash_uniforms", lambda texts: hashed.append(len(texts)) or plain(texts))
    sweep, scores, dense = _sweep()
    got = sweep.assigned().to_pydict()
    u = np.array([[uniform("3:1", d, c) for c in range(6)] for d in [*range(299), None]])
    chosen = np.argmax(scores - np.log(-np.log(u)), axis=1)
    assert got["cluster"] == chosen.tolist() and got["doc_id"] == [*range(299), None]
    p = np.exp(scores - scores.max(1, keepdims=True))
    assert got["posterior"] == pytest.approx((p[range(300), chosen] / p.sum(1)).tolist(), rel=1e-9)
    assert len(hashed) > 5 and 300 <= sum(hashed) < 0.6 * scores.size
    for c, pos, cnt in zip(*sweep.counted().to_pydict().values()):
        want = np.append((chosen == c).sum(), dense[chosen == c].sum(0))
        assert dict(zip(pos, cnt)) == {int(at) - 1: want[at] for at in {0, *np.flatnonzero(want).tolist()}}


def test_blocks_hold_bytes_and_are_a_multiple_of_the_cores(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(40).selectExpr("id AS doc_id", "array(0, 1, 300) AS idx", "array(1L, 1L, 2L) AS cnt")
    monkeypatch.setattr(TP, "LEAST_CELLS", 10)
    monkeypatch.setattr(TP, "MOST_CELLS", 30)
    docs, keys = TP.in_blocks(rows)
    assert len(keys) == 2 * cores
    row = docs.first()
    assert (row.n, np.frombuffer(row.idx, np.uint16).tolist(), list(row.cnt)) == (3, [0, 1, 300], [1, 1, 2])


ODD_TEXTS = [
    (1, "The cat sat.\n on the (mat)\n"), (2, "cat.\n"), (3, "cat.\n cat.\n dog.\r\n  Cat,\tdog"), (4, None), (5, ""), (None, "cat cat"),
    (6, "ab\n the\u2028 cat ab\n"), (7, "ÉCOLE école, ΟΔΟΣ aΟΔΟΣ. İxy x1 1x --the-- l'été"), (8, "dog"), (8, "dog cat the"), (9, " the\x85 mat.\x85"),
]


def test_counts_by_distinct_token_equal_counts_by_document(spark, monkeypatch):
    """Line breaks, other scripts, NULL texts, ids that are NULL or come twice."""
    from sparkloom.functions import text as T
    from sparkloom.plans import topic_queries as Q

    docs = spark.createDataFrame([(i, t, "src1") for i, t in ODD_TEXTS], "doc_id long, text string, source string").repartition(1)
    monkeypatch.setattr(Q, "table", lambda *_: docs)
    monkeypatch.setattr(Q, "TOPIC_VOCAB", 12)
    vocab = Q._vocab(Q._docs(spark, ""), 12)
    want = TP.doc_term_arrays(docs, T.topic_tokens("text"), vocab)
    for most in (TP.MOST_FORM_BYTES, 0):  # sent to the tasks, or joined
        monkeypatch.setattr(TP, "MOST_FORM_BYTES", most)
        found, arrays = Q._arrays(spark, "")
        assert sorted(found.table.collect()) == sorted(vocab.table.collect())
        rows = [sorted((str(r.doc_id), r.idx, r.cnt) for r in a.collect()) for a in (arrays, want)]
        assert rows[0] == rows[1] and len(rows[0]) == len(ODD_TEXTS)
