"""Registered topic-model queries (documents; cluster = the number of ``source``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators import topics
from sparkloom.operators import vocab as V
from sparkloom.plans.registry import register
from sparkloom.session import materialize
from sparkloom.sources.tables import table

SEED = 42
ALPHA = BETA = 0.1
STEP_VOCAB = 20000
TOPIC_VOCAB = 20000
GIBBS_K = 20
GIBBS_ITERATIONS = 200
SHORT_ITERATIONS = 3


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "text", F.regexp_extract("source", "([0-9]+)", 1).try_cast("int").alias("cluster"))


def _vocab(docs: DataFrame, k: int) -> V.Vocabulary:
    return V.Vocabulary(V.top_k(V.word_counts(docs, T.tokens_whitespace("text"), T.stripped_token), k), k).materialized()


def _cluster_cells(docs: DataFrame, vocab: V.Vocabulary) -> DataFrame:
    terms = vocab.doc_terms(docs, T.topic_tokens("text"))
    return terms.join(docs.select("doc_id", "cluster"), "doc_id").groupBy("cluster", "pos").agg(
        F.sum("cnt").alias("cnt")
    )


@register("topic_assign_step")
def topic_assign_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One assignment sweep with mu = smoothed per-source term frequencies."""
    docs = _docs(spark, sf_dir)
    vocab = _vocab(docs, STEP_VOCAB)
    v = vocab.table.count()
    # the corpus is tokenised once: per-document arrays (with their cluster) feed both the
    # cluster term counts and the assignment pass; documents without a cluster are assigned one
    arrays = materialize(topics.doc_term_arrays(docs, T.topic_tokens("text"), vocab, keep=("cluster",)))
    known = arrays.filter(F.col("cluster").isNotNull())
    cells = topics.cluster_cells_of_arrays(known)
    params = materialize(topics.smoothed_parameters(cells, topics.known_clusters(known), v, ALPHA, BETA))
    out = topics.assign_step(arrays, params, SEED, 0)
    return out.select("doc_id", "cluster", F.round("posterior", 6).alias("posterior"))


def _grid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, V.Vocabulary]:
    """Counts of every dictionary word in every cluster that the documents have."""
    docs = _docs(spark, sf_dir)
    vocab = _vocab(docs, TOPIC_VOCAB)
    clusters = topics.known_clusters(docs).select("cluster")
    return topics.full_grid_counts(_cluster_cells(docs, vocab), clusters, vocab.table.count()), vocab


@register("topic_cluster_counts")
def topic_cluster_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19 + U1: term counts of every (cluster, dictionary word), zeros included."""
    return _grid(spark, sf_dir)[0]


@register("topic_words_fixed")
def topic_words_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 + W3 + M20: 100 most probable words per source under smoothed frequencies."""
    grid, vocab = _grid(spark, sf_dir)
    return topics.top_words_per_topic(grid, vocab, BETA, 100)


def _arrays(spark: SparkSession, sf_dir: str) -> tuple[V.Vocabulary, DataFrame]:
    """The dictionary and the documents' counts. The tokens between single spaces are counted in
    Arrow batches; the words of both tokenisers are found once per distinct token."""
    docs = _docs(spark, sf_dir)
    found = materialize(V.text_counts(docs, F.col("text"), T.single_space_words))
    words = found.select(F.explode(T.tokens_whitespace("word")).alias("word"), "count")
    vocab = V.Vocabulary(V.top_k(V.normal_counts(words, T.stripped_token), TOPIC_VOCAB), TOPIC_VOCAB).materialized()
    forms = found.select(F.col("word").alias("form"), F.explode(T.topic_tokens("word")).alias("word"))
    forms = materialize(forms.join(vocab.lookup_table(), "word").select("form", "pos"))
    if (forms.agg(F.sum(F.octet_length("form") + F.lit(16))).first()[0] or 0) > topics.MOST_FORM_BYTES:
        return vocab, topics.doc_term_arrays(docs, T.topic_tokens("text"), vocab)
    return vocab, topics.form_arrays(docs, F.col("text"), T.single_space_words, forms)


def _gibbs(spark: SparkSession, sf_dir: str, iterations: int) -> topics.GibbsModel:
    vocab, arrays = _arrays(spark, sf_dir)
    return topics.fit_gibbs(arrays, vocab, GIBBS_K, ALPHA, BETA, iterations, SEED)


@register("topic_gibbs")
def topic_gibbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gibbs-sampled clusters of all documents (rows-only check)."""
    return _gibbs(spark, sf_dir, GIBBS_ITERATIONS).assignments()


@register("topic_top_words")
def topic_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted topics' 100 most probable words (rows-only check)."""
    return _gibbs(spark, sf_dir, GIBBS_ITERATIONS).top_words(100)


@register("topic_gibbs_short")
def topic_gibbs_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M19, M19a-e: clusters after three sweeps, which SQL can repeat draw by draw."""
    out = _gibbs(spark, sf_dir, SHORT_ITERATIONS).assignments()
    return out.select("doc_id", "cluster", F.round("posterior", 6).alias("posterior"))


@register("topic_gibbs_short_words")
def topic_gibbs_short_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M20 + T8 after three sweeps: 100 most probable words per topic."""
    top = _gibbs(spark, sf_dir, SHORT_ITERATIONS).top_words(100)
    return top.select("topic", "rank", "word", F.round("log_prob", 6).alias("log_prob"))
