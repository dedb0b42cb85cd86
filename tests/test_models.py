"""Linear regression (M1-M4) and linear classifiers (M13-M18): identities against NumPy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import classify as C
from sparkloom.operators import linear as L


@pytest.fixture(scope="module")
def line(spark):
    x = np.linspace(1, 20, 40)
    return spark.createDataFrame([(float(a), float(3 * a + 2)) for a in x], "x double, y double"), x


def test_closed_form_recovers_exact_line(line):
    df, x = line
    r = L.closed_form(df, "x", "y").first()
    assert (r["n"], r["slope"], r["intercept"]) == (40, 3.0, 2.0)


def _rowwise_gd(x, y, theta, lr, iters, grad_scale, cost_scale):
    """Row-by-row GD with the bold-driver rule (the surveyed jobs' loop, in NumPy)."""
    xa = np.column_stack([np.ones(len(y)), x])
    theta = np.array(theta, float)
    old = 0.0
    out = []
    for _ in range(iters):
        r = y - xa @ theta
        cost = float(r @ r) * cost_scale
        theta = theta - lr * grad_scale * (xa.T @ r)
        if cost < old:
            lr, old = lr * 1.05, cost
        elif cost > old:
            lr, old = lr * 0.5, cost
        out.append((cost, *theta))
    return out


def test_moment_gd_equals_rowwise_gd(line):
    df, x = line
    y = 3 * x + 2
    trace = L.fit_simple_gd(df, "x", "y", lr=1e-3, iterations=50)
    ref = _rowwise_gd(x, y, [0.1, 0.1], 1e-3, 50, -2.0 / len(y), 1.0 / len(y))
    for t, r in zip(trace, ref):
        assert t[1] == pytest.approx(r[0], rel=1e-9)
        assert list(t[2:4]) == pytest.approx(list(r[1:]), rel=1e-9, abs=1e-12)


def test_gd_converges_to_closed_form(line):
    df, _ = line
    trace = L.fit_simple_gd(df, "x", "y", lr=1e-3, iterations=5000)
    _, _, b, m, _ = trace[-1]
    assert (m, b) == (pytest.approx(3.0, abs=1e-4), pytest.approx(2.0, abs=1e-3))


def test_multi_feature_gd(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 4))
    y = x @ np.array([1.0, -2.0, 0.5, 3.0]) + 4.0
    df = spark.createDataFrame([tuple(map(float, row)) + (float(t),) for row, t in zip(x, y)],
                               "f1 double, f2 double, f3 double, f4 double, y double")
    trace = L.fit_multi_gd(df, ["f1", "f2", "f3", "f4"], "y", lr=1e-3, iterations=30, standardize=False)
    ref = _rowwise_gd(x, y, [0.1] * 5, 1e-3, 30, -1.0 / 200, 0.5 / 200)
    for t, r in zip(trace, ref):
        assert t[1] == pytest.approx(r[0], rel=1e-9)
        assert list(t[2:7]) == pytest.approx(list(r[1:]), rel=1e-9, abs=1e-12)


# ------------------------------------------------------------------ classifiers
@pytest.fixture(scope="module")
def two_class(spark):
    rng = np.random.default_rng(5)
    n = 300
    y = (rng.random(n) < 0.3).astype(float)
    x = rng.normal(size=(n, 3)) + np.outer(y, [1.5, -1.0, 0.5])
    rows = [tuple(map(float, r)) + (float(t),) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    return df, x, y


def _np_cost(loss, w, x, y, reg, weights=None):
    z = x @ w
    if loss == "logistic":
        return float(np.sum(np.logaddexp(0, z) - y * z) + reg * w @ w)
    ys = 2 * y - 1
    if loss == "hinge":
        return float(w @ w / (2 * len(y) * reg) + np.mean(np.maximum(0, 1 - ys * z)))
    nr, pr = weights
    m = 1 - ys * z
    return float(np.sum(np.maximum(0, nr * (1 + ys) / 2 * m + pr * (1 - ys) / 2 * m)))


@pytest.mark.parametrize("loss", ["logistic", "hinge", "weighted_hinge"])
def test_gd_first_step_matches_numpy_and_finite_difference(two_class, loss):
    df, x, y = two_class
    label = F.col("y") if loss == "logistic" else F.col("y") * 2 - 1
    ys = y if loss == "logistic" else 2 * y - 1
    weights = (1 - y.mean(), y.mean()) if loss == "weighted_hinge" else None
    cfg = C.GDConfig(loss=loss, lr=0.01, iterations=1, reg=0.5 if loss == "hinge" else 1e-3, tol=-1.0,
                     class_weights=weights)
    backend = C.Columns(df, [F.col("a"), F.col("b"), F.col("c")], label)
    w0 = [0.2, -0.1, 0.3]
    trace = C.fit_gd(backend, w0, cfg, n=len(y))
    cost = trace[0][1]
    assert cost == pytest.approx(_np_cost(loss, np.array(w0), x, y, cfg.reg, weights), rel=1e-10)
    # the summed (sub)gradient equals a central finite difference of the data term
    _, g = backend.sums(cfg, w0)
    eps = 1e-6
    for i in range(3):
        wp, wm = np.array(w0), np.array(w0)
        wp[i] += eps
        wm[i] -= eps
        if loss == "logistic":
            fd = (_np_cost(loss, wp, x, y, 0) - _np_cost(loss, wm, x, y, 0)) / (2 * eps)
        elif loss == "hinge":
            fd = len(y) * ((_np_cost(loss, wp, x, y, 1e300) - _np_cost(loss, wm, x, y, 1e300)) / (2 * eps))
        else:
            fd = (_np_cost(loss, wp, x, y, 0, weights) - _np_cost(loss, wm, x, y, 0, weights)) / (2 * eps)
        assert g[i] == pytest.approx(fd, rel=1e-4, abs=1e-6)
    assert ys is not None


@pytest.mark.parametrize("fan", [2, 32])
def test_sparse_backend_equals_dense_backend(spark, two_class, monkeypatch, fan):
    """With the vectors of all tasks at the driver, and merged in two groups first."""
    monkeypatch.setattr(C.Sparse, "_FAN", fan)
    df, _, _ = two_class
    sparse = df.select(F.array(F.lit(0), F.lit(1), F.lit(2)).alias("idx"),
                       F.array("a", "b", "c").alias("val"), "y")
    cfg = C.GDConfig(loss="logistic", lr=0.05, iterations=15, reg=1e-3, tol=1e-9)
    a = C.fit_gd(C.Columns(df, [F.col("a"), F.col("b"), F.col("c")], F.col("y")), [0.1] * 3, cfg)
    backend = C.Sparse(sparse, 3, F.col("y"))
    assert backend.tasks > 2
    b = C.fit_gd(backend, [0.1] * 3, cfg)
    assert len(a) == len(b)
    for ra, rb in zip(a, b):
        assert list(ra) == pytest.approx(list(rb), rel=1e-9, abs=1e-12)


def test_ml_logistic_minimises_the_same_objective(spark, two_class):
    """M14 <-> pyspark.ml with regParam = 2 lambda / n: compare with a NumPy Newton solve."""
    from pyspark.ml.feature import VectorAssembler

    df, x, y = two_class
    lam = 2.0
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).withColumnRenamed("y", "label")
    model = C.ml_logistic(data, max_iter=200, reg_param=2 * lam / len(y))
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        grad = x.T @ (p - y) + 2 * lam * w
        hess = x.T @ (x * (p * (1 - p))[:, None]) + 2 * lam * np.eye(3)
        w = w - np.linalg.solve(hess, grad)
    assert list(model.coefficients) == pytest.approx(list(w), abs=1e-5)


def test_stop_rule_and_bold_driver(two_class):
    df, _, _ = two_class
    cfg = C.GDConfig(loss="logistic", lr=0.001, iterations=200, reg=1e-5, tol=1e-3)
    trace = C.fit_gd(C.Columns(df, [F.col("a"), F.col("b"), F.col("c")], F.col("y")), [0.0] * 3, cfg)
    assert len(trace) < 200  # stopped on | |w_old| - |w_new| | <= tol
    assert trace[0][-1] == pytest.approx(0.0005)  # old cost starts at 0: step one halves lr
    assert all(r[-1] > 0 for r in trace) and not math.isnan(trace[-1][1])


def test_class_ratios_and_decision_rules(spark):
    df = spark.createDataFrame([(1, 0.0), (-1, 0.5), (-1, -0.5), (-1, 2.0)], "y int, z double")
    nr, pr = C.class_ratios(df, F.col("y"))
    assert (nr, pr) == (0.75, 0.25)
    out = df.select(C.predict(F.col("z"), "ge0").alias("ge"), C.predict(F.col("z"), "gt0", 1, -1).alias("gt"))
    assert [(r["ge"], r["gt"]) for r in out.collect()] == [(1, -1), (1, 1), (0, -1), (1, 1)]


def _svm_descent(x, y, weights=None):
    """The surveyed SVM fits in NumPy: at most 300 iterations, stop rule M6."""
    n, w, old, out = len(y), np.full(x.shape[1], 0.1), 0.0, []
    lr, lam = (0.5, 100.0) if weights is None else (1.0, None)
    c = np.full(n, 1.0 / n) if weights is None else np.where(y > 0, *weights)
    for _ in range(300):
        margin = 1 - y * (x @ w)
        cost = float(c @ np.maximum(0, margin)) + (w @ w / (2 * n * lam) if lam else 0.0)
        grad = -(c * y * (margin >= 0)) @ x + (w / (n * lam) if lam else 0.0)
        new = w - lr * grad
        stop = abs(math.sqrt(w @ w) - math.sqrt(abs(w @ new))) <= 5e-5
        w = new
        out.append((cost, *w))
        if stop:
            break
        if cost != old:
            lr, old = lr * (1.05 if cost < old else 0.5), cost
    return out


@pytest.mark.parametrize("name", ["svm_gd", "svm_weighted_gd"])
def test_svm_descents_run_to_their_end(spark, name):
    import duckdb

    from sparkloom.plans.registry import all_queries

    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"select embedding, label from '{sf}/embeddings.parquet'").fetchall()
    x, y = np.array([r[0] for r in rows], float), np.array([1 if r[1] >= 5 else -1 for r in rows])
    ref = _svm_descent(x, y, ((y < 0).mean(), (y > 0).mean()) if name == "svm_weighted_gd" else None)
    got = all_queries()[name](spark, sf).orderBy("iteration").collect()
    assert len(got) == len(ref) > 5
    for r, t in zip(got, ref):
        assert list(r[1:-1]) == pytest.approx(list(t), rel=1e-4, abs=2e-5)


@pytest.mark.parametrize("kind", ["logistic", "svm"])
def test_fitted_models_predict_in_a_session_with_observations(spark, two_class, kind):
    """A training summary refers to the session, which cannot be sent to tasks once observed."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import Observation

    df, x, _ = two_class
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == len(x)
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).withColumnRenamed("y", "label")
    model = C.ml_logistic(data, max_iter=20) if kind == "logistic" else C.ml_svm(data, reg_param=0.0, max_iter=20)
    z = x @ model.coefficients.toArray()
    got = [r["prediction"] for r in model.transform(data).select("prediction").collect()]
    assert got == [float(v > 0) for v in z]


def test_descent_has_as_many_tasks_as_cores_whatever_the_shuffle_partitions(spark, two_class):
    df, _, _ = two_class
    rows = df.select(F.array(F.lit(0), F.lit(1)).alias("idx"), F.array("a", "b").alias("val"), "y")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        backend = C.Sparse(rows, 2, F.col("y"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert 1 < backend.tasks <= spark.sparkContext.defaultParallelism and backend.count() == df.count()


def test_packed_pieces_keep_every_cell(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(C, "PIECE_CELLS", 4)
    idx, val = [[0, 2], [], [1], [0, 1, 2], [2], [1, 2, 0]], [[1.0, 2.0], [], [3.0], [4.0, 5.0, 6.0], [7.0], [8.0, 9.0, 1.5]]
    batch = pa.RecordBatch.from_arrays([pa.array(idx, pa.list_(pa.int32())), pa.array(val), pa.array([1.0, 0, 1, 0, 1, 0])], names=["idx", "val", "y"])
    pieces = list(C._packed([batch]))
    assert len(pieces) > 2 and sum(p.column("n")[0].as_py() for p in pieces) == 6
    cells = [c for p in pieces for c in C._cells(p)]
    assert [y for c in cells for y in c[0]] == [1.0, 0, 1, 0, 1, 0]
    assert [(i, v) for c in cells for i, v in zip(c[2], c[3])] == [(i, v) for a, b in zip(idx, val) for i, v in zip(a, b)]
    assert [n for c in cells for n in np.bincount(c[1], minlength=len(c[0]))] == [len(i) for i in idx]


def test_vectorizer_equals_count_vectorizer(spark):
    from pyspark.ml.feature import CountVectorizerModel, Normalizer
    from pyspark.ml.linalg import Vectors

    from sparkloom.functions.text import tokens_letters

    docs = spark.createDataFrame([(1, "b a b zz"), (2, "zz"), (2, "c c a"), (3, ""), (4, "c b a a a a a")], "doc_id long, text string")
    words = ["a", "b", "c", "d"]
    counts = CountVectorizerModel.from_vocabulary(words, "t", "n").transform(docs.withColumn("t", tokens_letters("text")))
    want = Normalizer(inputCol="n", outputCol="v", p=1.0).transform(counts).select("doc_id", "text", "v").collect()
    assert sorted(map(tuple, C.text_vectors(docs, tokens_letters("text"), words).collect()), key=str) == sorted(map(tuple, want), key=str)
    weighted = C.text_vectors(docs, tokens_letters("text"), words, idf=[2.0, 3.0, 4.0, 5.0]).where("doc_id = 1").first()
    assert weighted["features"] == Vectors.sparse(4, {0: 2.0 / 3, 1: 2.0})
    nothing = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert C.text_vectors(nothing, tokens_letters("text"), words).first()["features"] == Vectors.sparse(4, {})


def test_fit_deals_rows_over_the_cores_and_keeps_no_second_copy(spark, two_class, monkeypatch):
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.feature import VectorAssembler

    df, x, _ = two_class
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).withColumnRenamed("y", "label")
    seen = []

    class Estimator(LinearSVC):
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.storageLevel.useMemory, rows.count()))
            return super().fit(rows)

    C._fit(lambda n: Estimator(maxIter=n // 100), data.repartition(60))
    monkeypatch.setattr(C, "TASK_ROWS", 50)
    C._fit(lambda n: Estimator(maxIter=n // 100), data.repartition(60))
    cores = spark.sparkContext.defaultParallelism
    assert seen == [(cores, False, len(x)), (max(cores, 6), False, len(x))]


def test_text_sets_read_the_documents_once(spark):
    """The fit, its class shares and the predictions read counted words, not texts."""
    from sparkloom.plans import model_queries as Q

    train, test, _, words = Q._tf_sets(spark, "/root/testdata/sf0.001")
    for side in (train, test):
        assert side.columns == ["doc_id", "label", "features"]
        assert not [f for f in side.inputFiles() if "documents" in f]
    assert train.first()["features"].size == len(words)
