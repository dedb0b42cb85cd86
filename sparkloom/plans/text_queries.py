"""Registered text queries: word counts, vocabularies, TF / DF / TF-IDF, parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators import vocab as V
from sparkloom.plans.registry import register
from sparkloom.session import materialize
from sparkloom.sources.tables import documents_as_wiki_lines, table

VOCAB_K = 20000
ROUND = 9


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@register("word_count")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.word_counts(_docs(spark, sf_dir), T.tokens_letters("text"))


@register("word_count_raw")
def word_count_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.word_counts(_docs(spark, sf_dir), T.tokens_single_space("text"))


@register("vocab_topk")
def vocab_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.Vocabulary.fit(_docs(spark, sf_dir), T.tokens_letters("text"), VOCAB_K).table


@register("vocab_tail20")
def vocab_tail20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.Vocabulary.fit(_docs(spark, sf_dir), T.tokens_letters("text"), VOCAB_K).tail(20)


@register("vocab_stripped_tokens")
def vocab_stripped_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = documents_as_wiki_lines(spark, sf_dir)
    body = T.body_from_first_gt("value")
    return V.top_k(V.word_counts(lines, T.tokens_whitespace(body), T.stripped_token), VOCAB_K)


def _model_docs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, V.Vocabulary]:
    docs = _docs(spark, sf_dir)
    return docs, V.Vocabulary.fit(docs, T.tokens_letters("text"), VOCAB_K)


def _bow(docs: DataFrame) -> DataFrame:
    """The corpus tokenised once and written to the checkpoint folder: the dictionary, the term
    cells and the document frequencies all read it instead of tokenising again."""
    return materialize(V.bag_of_words(docs, T.tokens_letters("text")))


@register("term_frequency")
def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    bow = _bow(_docs(spark, sf_dir))
    vocab = V.Vocabulary.fit_bow(bow, VOCAB_K).materialized()
    tf = V.term_frequency(vocab.bow_terms(bow))
    return tf.select("doc_id", "pos", "cnt", "tf")


@register("document_frequency")
def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    bow = _bow(_docs(spark, sf_dir))
    vocab = V.Vocabulary.fit_bow(bow, VOCAB_K).materialized()
    dfreq = V.document_frequency(vocab.bow_terms(bow))
    return dfreq.join(vocab.lookup_table(), "pos").select("pos", "word", "df")


def _tfidf(spark: SparkSession, sf_dir: str, smoothing: bool) -> DataFrame:
    docs = _docs(spark, sf_dir)
    bow = _bow(docs)
    model = V.TfIdfModel.fit_bow(bow, V.n_docs_of(docs), VOCAB_K, smoothing)
    out = model.transform_bow(bow)
    return out.select("doc_id", "pos", F.round("tfidf", ROUND).alias("tfidf"))


@register("tfidf")
def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tfidf(spark, sf_dir, smoothing=False)


@register("tfidf_smoothed")
def tfidf_smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tfidf(spark, sf_dir, smoothing=True)


def train_test_docs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every document is used: ids divisible by 5 form the test set, the rest train."""
    return split_by_id(_docs(spark, sf_dir))


def split_by_id(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    is_test = (F.col("doc_id") % 5) == 0
    return docs.where(~is_test), docs.where(is_test)


@register("idf_train_apply_test")
def idf_train_apply_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary and idf fitted on the training documents, applied to the test ones."""
    train, test = train_test_docs(spark, sf_dir)
    model = V.TfIdfModel.fit_bow(_bow(train), V.n_docs_of(train), VOCAB_K)
    out = model.transform(test, T.tokens_letters("text"))
    return out.select("doc_id", "pos", F.round("tfidf", ROUND).alias("tfidf"))


# The five probe words of the word-presence report.
PROBE_WORDS = ["applicant", "and", "attack", "protein", "court"]


@register("word_presence_by_class")
def word_presence_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 + F8 + F9: share of the documents of each class that contain each probe word."""
    from sparkloom.operators.evaluate import presence_rate_by_class

    docs, vocab = _model_docs(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return presence_rate_by_class(docs.join(labels, "doc_id"), T.tokens_letters("text"), PROBE_WORDS, vocab)


@register("category_join")
def category_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents joined to their label rows on differently named keys (1:n)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("labelled_doc"), "quality", "toxic"
    )
    joined = docs.join(labels, docs.doc_id == labels.labelled_doc)
    return joined.select("doc_id", "source", "lang", "quality", "toxic")


@register("doc_line_parse")
def doc_line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P4 + F5 on wrapped document lines: id, body, header and the from-'>' body."""
    lines = documents_as_wiki_lines(spark, sf_dir).where(T.valid_doc_line("value"))
    body = T.body_of_line("value")
    body4 = T.body_from_first_gt("value")
    return lines.select(
        T.doc_id_of_line("value").alias("doc_id"),
        T.header_of_line("value").alias("header"),
        F.length(body).cast("long").alias("body_chars"),
        F.md5(body).alias("body_md5"),
        F.length(body4).cast("long").alias("gt_body_chars"),
        F.md5(body4).alias("gt_body_md5"),
    )


@register("page_tag_strip")
def page_tag_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + P5 on raw web pages: first tag, and the text with all tags removed."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    stripped = T.strip_tags("html")
    return pages.select(
        "page_id",
        T.header_of_line("html").alias("header"),
        F.length(stripped).cast("long").alias("stripped_chars"),
        F.md5(stripped).alias("stripped_md5"),
    )


@register("label_from_text")
def label_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 with ``source`` as the id and '1' as the marker: 0/1 and -1/+1 labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return docs.select(
        "doc_id",
        T.label_from_id("source", "1").alias("label"),
        T.label_from_id("source", "1", 1, -1).alias("signed_label"),
    )
