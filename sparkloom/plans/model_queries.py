"""Registered model queries: kNN, linear regression, logistic regression and SVMs."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators import knn
from sparkloom.operators import vocab as V
from sparkloom.plans.registry import register
from sparkloom.session import materialize
from sparkloom.sources.tables import table

VOCAB_K = 20000
KNN_K = 10


def _knn_text(spark: SparkSession, sf_dir: str, metric: str, cats: DataFrame | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    if cats is None:
        cats = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("category"))
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return knn.knn_text(None, docs, cats, queries, KNN_K, metric, vocab_k=VOCAB_K)


@register("knn_text_votes")
def knn_text_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn_text(spark, sf_dir, "dot")


@register("knn_text_cosine")
def knn_text_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn_text(spark, sf_dir, "cosine")


@register("knn_text_multi_category")
def knn_text_multi_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with up to two categories each (source and lang); every category is a candidate."""
    cats = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.array("source", "lang")).alias("category")
    ).where(F.col("category").isNotNull())
    return _knn_text(spark, sf_dir, "dot", cats)


@register("knn_dense_votes")
def knn_dense_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with ids divisible by 5 are the queries, the others the labelled base."""
    emb = table(spark, sf_dir, "embeddings")
    is_query = (F.col("vec_id") % 5) == 0
    base = emb.where(~is_query).select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("category"), F.col("embedding").alias("vector"))
    queries = emb.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return knn.vote(knn.top_k_dense(base, queries, KNN_K, "dot"))


# ---------------------------------------------------------------- linear regression
from sparkloom.functions import clean  # noqa: E402
from sparkloom.operators import linear  # noqa: E402
from sparkloom.sources.tables import lineitem_trips  # noqa: E402

MULTI_FEATURES = ["trip_time_secs", "trip_distance", "fare_amount", "surcharge"]


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = lineitem_trips(spark, sf_dir)
    return trips.where(clean.in_clean_range(trips))


@register("linreg_closed_form")
def linreg_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linear.closed_form(clean_trips(spark, sf_dir), "trip_distance", "fare_amount")


@register("linreg_gd")
def linreg_gd(spark: SparkSession, sf_dir: str) -> DataFrame:
    trace = linear.fit_simple_gd(clean_trips(spark, sf_dir), "trip_distance", "fare_amount")
    return linear.trace_frame(spark, trace, ["cost", "b", "m"])


@register("linreg_gd_multi")
def linreg_gd_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    trace = linear.fit_multi_gd(clean_trips(spark, sf_dir), MULTI_FEATURES, "total_amount")
    return linear.trace_frame(spark, trace, ["cost", "b", "w1", "w2", "w3", "w4"])


# ---------------------------------------------------------------- classifiers on embeddings
from sparkloom.operators import classify, evaluate  # noqa: E402

N_EMB_FEATURES = 64  # all embedding values
GD_ITERATIONS = 5
W0 = [0.1] * N_EMB_FEATURES


def emb_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list]:
    emb = table(spark, sf_dir, "embeddings")
    return emb, [F.col("embedding").getItem(i).cast("double") for i in range(N_EMB_FEATURES)]


def emb_label(signed: bool):
    return F.when(F.col("label") >= 5, 1).otherwise(-1 if signed else 0)


def _trace(spark: SparkSession, trace: list[tuple]) -> DataFrame:
    return linear.trace_frame(spark, trace, ["cost"] + [f"w{i + 1}" for i in range(N_EMB_FEATURES)])


LOGREG_CFG = classify.GDConfig(loss="logistic", lr=1e-3, iterations=GD_ITERATIONS, reg=1e-5, tol=1e-6,
                               grow_on_equal=True)
SVM_CFG = classify.GDConfig(loss="hinge", lr=0.5, iterations=GD_ITERATIONS, reg=100.0, tol=5e-5)
WSVM_CFG = classify.GDConfig(loss="weighted_hinge", lr=1.0, iterations=GD_ITERATIONS, tol=5e-5)


@register("logreg_gd_fixed_iters")
def logreg_gd_fixed_iters(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb, xs = emb_features(spark, sf_dir)
    return _trace(spark, classify.fit_gd(classify.Columns(emb, xs, emb_label(False)), W0, LOGREG_CFG))


@register("svm_gd_fixed_iters")
def svm_gd_fixed_iters(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb, xs = emb_features(spark, sf_dir)
    return _trace(spark, classify.fit_gd(classify.Columns(emb, xs, emb_label(True)), W0, SVM_CFG))


@register("svm_weighted_gd_fixed_iters")
def svm_weighted_gd_fixed_iters(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb, xs = emb_features(spark, sf_dir)
    nr, pr = classify.class_ratios(emb, emb_label(True))
    cfg = classify.GDConfig(**{**WSVM_CFG.__dict__, "class_weights": (nr, pr)})
    return _trace(spark, classify.fit_gd(classify.Columns(emb, xs, emb_label(True)), W0, cfg))


SVM_ITERATIONS = 300  # of the surveyed jobs; the stop rule (M6) may end a fit earlier


def _emb_arrays(emb: DataFrame) -> classify.Sparse:
    """Embeddings for many iterations: weights are broadcast, so no iteration compiles a plan."""
    cells = emb.where(F.col("embedding").isNotNull()).select(
        F.sequence(F.lit(0), F.lit(N_EMB_FEATURES - 1)).alias("idx"),
        F.slice("embedding", 1, N_EMB_FEATURES).cast("array<double>").alias("val"), emb_label(True).alias("y"))
    return classify.Sparse(cells, N_EMB_FEATURES, F.col("y"))


@register("svm_gd")
def svm_gd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 + M6: exact hinge descent to its stop rule or limit (rows-only check)."""
    emb, _ = emb_features(spark, sf_dir)
    cfg = replace(SVM_CFG, iterations=SVM_ITERATIONS)
    return _trace(spark, classify.fit_gd(_emb_arrays(emb), W0, cfg, emb.count()))


@register("svm_weighted_gd")
def svm_weighted_gd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M17 + M6: exact class-weighted hinge descent to its stop rule or limit (rows-only check)."""
    emb, _ = emb_features(spark, sf_dir)
    cfg = replace(WSVM_CFG, iterations=SVM_ITERATIONS, class_weights=classify.class_ratios(emb, emb_label(True)))
    return _trace(spark, classify.fit_gd(_emb_arrays(emb), W0, cfg, emb.count()))


# ---------------------------------------------------------------- text classifiers
from sparkloom.plans.text_queries import split_by_id, train_test_docs  # noqa: E402


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))


def _labelled_split(spark: SparkSession, sf_dir: str):
    labels = _labels(spark, sf_dir)
    train, test = train_test_docs(spark, sf_dir)
    return train.join(labels, "doc_id"), test.join(labels, "doc_id")


def _vocab_words(vocab: V.Vocabulary) -> list[str]:
    # the fitted dictionary, bounded by VOCAB_K entries
    return [r["word"] for r in vocab.table.orderBy("pos").select("word").collect()]


def _tf_sets(spark: SparkSession, sf_dir: str):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").join(_labels(spark, sf_dir), "doc_id")
    # joined, tokenised and counted once: the dictionary and both splits come from the written bags
    train, test = split_by_id(materialize(V.bags(docs, F.col("text"), ["doc_id", "label"], T.letter_words)))
    vocab = V.Vocabulary.fit_bow(V.bag_cells(train), VOCAB_K).materialized()
    words = _vocab_words(vocab)
    vectorizer = classify.TextVectorizer(words)
    return vectorizer.transform_bags(train), vectorizer.transform_bags(test), vocab, words


@register("logreg_lbfgs")
def logreg_lbfgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-BFGS logistic regression on TF vectors; test predictions (rows-only check)."""
    tr, te, _, _ = _tf_sets(spark, sf_dir)
    model = classify.ml_logistic(tr, max_iter=200)
    return model.transform(te).select("doc_id", F.col("label").cast("int").alias("label"),
                                      F.col("prediction").cast("int").alias("prediction"))


@register("svm_text")
def svm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 via LinearSVC with regParam = 1 / (n lambda), lambda = 100 (rows-only check)."""
    tr, te, _, _ = _tf_sets(spark, sf_dir)
    model = classify.ml_svm(tr, lam=100.0, max_iter=300)
    return model.transform(te).select("doc_id", F.col("label").cast("int").alias("label"),
                                      F.col("prediction").cast("int").alias("prediction"))


@register("svm_weighted_text")
def svm_weighted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M17 via LinearSVC with class weights NR (positives) and PR (negatives), no penalty."""
    tr, te, _, _ = _tf_sets(spark, sf_dir)
    nr, pr = classify.class_ratios(_labelled_split(spark, sf_dir)[0], F.col("label"))  # reads no text
    weighted = tr.withColumn("weight", F.when(F.col("label") > 0, F.lit(nr)).otherwise(F.lit(pr)))
    model = classify.ml_svm(weighted, reg_param=0.0, max_iter=300, weight_col="weight")
    return model.transform(te).select("doc_id", F.col("label").cast("int").alias("label"),
                                      F.col("prediction").cast("int").alias("prediction"))


@register("logreg_test_report")
def logreg_test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A22 of the fitted M15 on the test documents (rows-only check)."""
    return evaluate.binary_summary(logreg_lbfgs(spark, sf_dir))


@register("svm_test_report")
def svm_test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A22 of the fitted M16 on the test documents (rows-only check)."""
    return evaluate.binary_summary(svm_text(spark, sf_dir))


@register("svm_weighted_test_report")
def svm_weighted_test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A22 of the fitted M17 on the test documents (rows-only check)."""
    return evaluate.binary_summary(svm_weighted_text(spark, sf_dir))


@register("logreg_top_words")
def logreg_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 + M22: the five words with the largest L-BFGS coefficients (rows-only check)."""
    tr, _, vocab, words = _tf_sets(spark, sf_dir)
    coef = classify.ml_logistic(tr, max_iter=200).coefficients.toArray()
    top = np.argsort(-coef, kind="stable")[:5]  # the coefficient vector is bounded by VOCAB_K
    rows = [(i + 1, int(p), float(coef[p])) for i, p in enumerate(top)]
    weights = spark.createDataFrame(rows, "rank int, pos int, weight double")
    return weights.join(vocab.lookup_table(), "pos").select("rank", "word", "weight")


@register("logreg_text_gd")
def logreg_text_gd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 exact GD on TF-IDF cells (sparse backend): cost trace (rows-only check)."""
    train, _ = _labelled_split(spark, sf_dir)
    bow = materialize(V.bag_of_words(train, T.tokens_letters("text")))  # tokenised once
    model = V.TfIdfModel.fit_bow(bow, V.n_docs_of(train), VOCAB_K)
    cells = model.transform_bow(bow).select("doc_id", "pos", F.col("tfidf").alias("w"))
    arrays = knn.long_to_arrays(cells, "doc_id").join(train.select("doc_id", "label"), "doc_id")
    d = model.vocab.table.count()
    rng = np.random.default_rng(42)
    w0 = rng.normal(0.0, 0.1, d).tolist()
    cfg = classify.GDConfig(loss="logistic", lr=0.1, iterations=2000, reg=1e-5, tol=1e-3, grow_on_equal=True)
    trace = classify.fit_gd(classify.Sparse(arrays, d, F.col("label")), w0, cfg)
    rows = [(int(t[0]), float(t[1]), float(np.linalg.norm(t[2:-1])), float(t[-1])) for t in trace]
    return spark.createDataFrame(rows, "iteration long, cost double, w_norm double, learning_rate double")
