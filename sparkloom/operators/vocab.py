"""Word counts, top-k vocabulary and the sparse bag-of-words / TF-IDF family.

Everything stays in *long* form — ``(doc_id, pos, value)`` rows — instead of dense
20 000-wide vectors, so storage and shuffle volume follow the number of non-zero cells.

Shuffle budget of a TF-IDF build:
  1. ``groupBy(word)`` for corpus counts; map-side partial aggregation absorbs hot words.
  2. top-k: histograms of the counts find the cut and only words tied at it are sorted; the
     vocabulary is bounded by ``k``; Spark broadcasts it when its measured bytes allow.
  3. the words of a document are counted inside its row (Arrow batches), without an exchange.
  4. one clustering of the aggregated cells by ``doc_id`` gives the per-document totals (a
     window); ``groupBy(pos)`` of the same cells gives the document frequency.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType


PIECE_WORDS = 1 << 17  # counted at once; bounds a task's work arrays
PIECE_BYTES = 1 << 20  # of text, likewise
COUNTED_BYTES = 1 << 23  # of text, where the work for its distinct words outweighs the rest


def explode_tokens(docs: DataFrame, tokens: Column, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, word)``, one row per token occurrence."""
    return docs.select(F.col(id_col), F.explode(tokens).alias("word"))


def bag_of_words(docs: DataFrame, tokens: Column, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, word, cnt)``: the corpus tokenised once, counted per document.

    All tokens of a document come from one row, so they are counted inside it, in Arrow batches,
    in pieces of about ``PIECE_WORDS`` occurrences, and no (document, word) cell is exchanged;
    every row is a document of its own. Later steps (vocabulary, term counts, document frequency)
    derive from this one table.
    """
    rows = docs.select(F.col(id_col), tokens.alias("words"))

    def count(batches):
        for batch in _pieces(batches):
            owner, words, n = _counted(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), words, pa.array(n, pa.int64())], names=[id_col, "word", "cnt"])

    return rows.mapInArrow(count, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, word string, cnt long")


def _pieces(batches, most_bytes: int = PIECE_BYTES):
    """The batches in slices of about ``PIECE_WORDS`` list elements, or ``most_bytes`` of text, of
    their column 1."""
    for batch in batches:
        column = batch.column(1)
        length, most = (column.value_lengths(), PIECE_WORDS) if pa.types.is_list(column.type) else (pc.binary_length(column), most_bytes)
        size = np.cumsum(np.asarray(length.fill_null(0)).astype(np.int64))
        ends = [*(np.flatnonzero(np.diff(size // most)) + 1).tolist(), batch.num_rows]
        for start, end in zip([0, *ends], ends):
            yield batch.slice(start, end - start)


def _counted(words: pa.ListArray) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(row, word, occurrences) of the distinct words of each row, rows in order."""
    owner = np.repeat(np.arange(len(words)), np.asarray(words.value_lengths().fill_null(0)))
    coded = words.flatten().dictionary_encode()
    size = max(len(coded.dictionary), 1)
    cells, n = np.unique(owner * size + np.asarray(coded.indices), return_counts=True)
    return pa.array(cells // size), coded.dictionary.take(pa.array(cells % size)), n


def bags(docs: DataFrame, tokens: Column, keep: list[str], words_of: Callable[[pa.Array], pa.ListArray] | None = None) -> DataFrame:
    """:func:`bag_of_words` with one row per row of ``docs``, of which the columns ``keep`` stay:
    ``(keep, words array<string>, counts array<bigint>)``. Written once, it gives the word
    counts (:func:`bag_cells`) and the features of a fit, and the text is not read again. With
    ``words_of``, ``tokens`` is a text and is tokenised in its Arrow batch: a text is sent to the
    kernel in a fraction of the time of its tokens."""
    rows = docs.select(F.struct(*keep).alias("row"), tokens.alias("words"))

    def count(batches):
        for batch in _pieces(batches):
            found = batch.column(1) if words_of is None else words_of(batch.column(1))
            owner, words, n = _counted(found)
            ends = pa.array(np.searchsorted(np.asarray(owner), np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.column(0).flatten(), pa.ListArray.from_arrays(ends, words), pa.ListArray.from_arrays(ends, pa.array(n, pa.int64()))],
                names=[*keep, "words", "counts"])

    added = [StructField("words", ArrayType(StringType())), StructField("counts", ArrayType(LongType()))]
    return rows.mapInArrow(count, StructType([*(docs.schema[c] for c in keep), *added]))


def bag_cells(bags: DataFrame) -> DataFrame:
    """``(word, cnt)`` of every distinct word of every row of :func:`bags`."""
    return bags.select(F.inline(F.arrays_zip("words", "counts"))).toDF("word", "cnt")


def word_counts(docs: DataFrame, tokens: Column, normal: Callable[[Column], Column] | None = None) -> DataFrame:
    """``(word, count)`` over all token occurrences of the corpus. With ``normal``, the word of a
    token (NULL: none) is found once per distinct token, after the tokens are counted."""
    counts = docs.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return counts if normal is None else normal_counts(counts, normal)


def normal_counts(counts: DataFrame, normal: Callable[[Column], Column]) -> DataFrame:
    """``(word, count)`` of the words that ``normal`` makes of counted tokens ``(word, count)``."""
    words = counts.select(normal(F.col("word")).alias("word"), "count").filter("word is not null")
    return words.groupBy("word").agg(F.sum("count").alias("count"))


def text_counts(docs: DataFrame, text: Column, words_of: Callable[[pa.Array], pa.ListArray]) -> DataFrame:
    """:func:`word_counts` of the tokens that ``words_of`` finds in an Arrow batch of texts: counted
    in pieces of the batch, so that a token is exchanged once a piece."""
    rows = docs.select(F.lit(0).alias("none"), text.alias("words"))

    def count(batches):
        for batch in _pieces(batches, most_bytes=COUNTED_BYTES):
            coded = words_of(batch.column(1)).flatten().dictionary_encode()
            n = np.bincount(np.asarray(coded.indices), minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n, pa.int64())], names=["word", "count"])

    return rows.mapInArrow(count, "word string, count long").groupBy("word").agg(F.sum("count").alias("count"))


def top_k(counts: DataFrame, k: int, value: str = "count", key: str = "word") -> DataFrame:
    """The ``k`` largest rows by ``value`` (positive longs), ties broken by ``key``; adds ``pos``
    0..k-1.

    Histograms find the k-th largest value; the rows above it are kept as they are, only the
    rows equal to it are put in order to fill up. The positional window then runs over at most
    ``k`` rows.
    """
    from sparkloom.operators.ranking import kth_largest, numbered
    from sparkloom.session import materialize

    order = [F.col(value).desc(), F.col(key).asc()]
    counts = materialize(counts)
    cut = kth_largest(counts, value, k)
    top = counts
    if cut is not None:
        least, above = cut
        ties = numbered(counts.filter(F.col(value) == least), [F.col(key).asc()], "__tie").filter(F.col("__tie") <= k - above)
        top = counts.filter(F.col(value) > least).unionByName(ties.drop("__tie"))
    return top.withColumn("pos", (F.row_number().over(Window.orderBy(*order)) - 1).cast("int"))


@dataclass
class Vocabulary:
    """A fitted dictionary ``(word, pos, count)``; ``pos`` 0 = most frequent word."""

    table: DataFrame
    k: int

    @classmethod
    def fit(cls, docs: DataFrame, tokens: Column, k: int = 20000, id_col: str = "doc_id") -> "Vocabulary":
        # corpus counts need no (document, word) cells, so one exchange of distinct words is enough
        return cls(top_k(word_counts(docs, tokens), k), k)

    @classmethod
    def fit_bow(cls, bow: DataFrame, k: int = 20000) -> "Vocabulary":
        counts = bow.groupBy("word").agg(F.sum("cnt").alias("count"))
        return cls(top_k(counts, k), k)

    def materialized(self) -> "Vocabulary":
        """The dictionary computed once (at most ``k`` rows) and written to the checkpoint folder.

        ``table`` is otherwise a lazy plan (tokenise, count, top-k): every count, lookup or
        join would tokenise the whole corpus again.
        """
        from sparkloom.session import materialize

        return Vocabulary(materialize(self.table), self.k)

    def lookup_table(self) -> DataFrame:
        return self.table.select("word", "pos")

    def doc_terms(self, docs: DataFrame, tokens: Column, id_col: str = "doc_id") -> DataFrame:
        """``(id_col, pos, cnt)``: in-vocabulary term counts per document."""
        return self.bow_terms(bag_of_words(docs, tokens, id_col), id_col)

    def bow_terms(self, bow: DataFrame, id_col: str = "doc_id") -> DataFrame:
        """Bag-of-words rows restricted to the dictionary, words replaced by positions."""
        return bow.join(self.lookup_table(), "word").select(id_col, "pos", "cnt")

    def tail(self, n: int = 20) -> DataFrame:
        """The last ``n`` dictionary positions, highest first."""
        return self.table.orderBy(F.col("pos").desc()).limit(n)


def term_frequency(doc_terms: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, pos, cnt, tf)``: tf = count / in-vocabulary tokens of the document."""
    total = F.sum("cnt").over(Window.partitionBy(id_col))
    return doc_terms.withColumn("tf", F.col("cnt") / total)


def presence(doc_terms: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """0/1 presence cells: a long-table row exists exactly when the word occurs."""
    return doc_terms.select(id_col, "pos", F.lit(1).alias("present"))


def document_frequency(doc_terms: DataFrame) -> DataFrame:
    """``(pos, df)``: number of documents containing each dictionary word.

    Counts non-null ``cnt`` (= rows): every cell is one document's.
    """
    return doc_terms.groupBy("pos").agg(F.count("cnt").alias("df"))


def idf(doc_freq: DataFrame, n_docs: Column, smoothing: bool = False) -> DataFrame:
    """``(pos, df, idf)`` with idf = ln(N / df), or ln(N / (1 + df)) when ``smoothing``."""
    denom = F.col("df") + F.lit(1) if smoothing else F.col("df")
    return doc_freq.withColumn("idf", F.log(n_docs.cast("double") / denom.cast("double")))


def n_docs_of(docs: DataFrame) -> Column:
    """Number of documents as a scalar subquery (one plan, no driver round trip)."""
    return docs.agg(F.count(F.lit(1))).scalar()


def tfidf(tf: DataFrame, idf_table: DataFrame, k: int, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, pos, tf, idf, tfidf)``; the idf side has at most ``k`` rows."""
    return (
        tf.join(idf_table.select("pos", "idf"), "pos")
        .select(id_col, "pos", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))
    )


@dataclass
class TfIdfModel:
    """Vocabulary and idf fitted on one corpus, applied to any other (train -> test)."""

    vocab: Vocabulary
    idf_table: DataFrame

    @classmethod
    def fit(
        cls, docs: DataFrame, tokens: Column, k: int = 20000, smoothing: bool = False, id_col: str = "doc_id"
    ) -> "TfIdfModel":
        bow = bag_of_words(docs, tokens, id_col)
        vocab = Vocabulary.fit_bow(bow, k)
        terms = vocab.bow_terms(bow, id_col)
        return cls(vocab, idf(document_frequency(terms), n_docs_of(docs), smoothing))

    @classmethod
    def fit_bow(cls, bow: DataFrame, n_docs: Column, k: int = 20000, smoothing: bool = False,
                id_col: str = "doc_id", materialize_vocab: bool = True) -> "TfIdfModel":
        """Fit from an existing bag-of-words table (e.g. a written one).

        The dictionary is written once (``materialize_vocab``) because the idf and every
        transform read it; skip that when the model is ``localized()`` right away.
        """
        vocab = Vocabulary.fit_bow(bow, k)
        if materialize_vocab:
            vocab = vocab.materialized()
        return cls(vocab, idf(document_frequency(vocab.bow_terms(bow, id_col)), n_docs, smoothing))

    def materialized(self) -> "TfIdfModel":
        """The idf (at most ``k`` rows) computed once, for a model that is applied several times."""
        from sparkloom.session import materialize

        return TfIdfModel(self.vocab, materialize(self.idf_table))

    def localized(self) -> "TfIdfModel":
        """Evaluate the model once: (word, pos, count, idf) rows, at most k of them, become
        a small in-memory table, so later plans broadcast it instead of refitting."""
        spark = self.vocab.table.sparkSession
        rows = self.vocab.table.join(self.idf_table.select("pos", "df", "idf"), "pos", "left").toPandas()
        local = spark.createDataFrame(rows).select(
            F.col("word"), F.col("count").cast("long"), F.col("pos").cast("int"),
            F.col("df").cast("long"), F.col("idf").cast("double"))
        return TfIdfModel(Vocabulary(local.select("word", "count", "pos"), self.vocab.k),
                          local.where(F.col("df").isNotNull()).select("pos", "df", "idf"))

    def transform(self, docs: DataFrame, tokens: Column, id_col: str = "doc_id") -> DataFrame:
        terms = self.vocab.doc_terms(docs, tokens, id_col)
        return tfidf(term_frequency(terms, id_col), self.idf_table, self.vocab.k, id_col)

    def transform_bow(self, bow: DataFrame, id_col: str = "doc_id") -> DataFrame:
        terms = self.vocab.bow_terms(bow, id_col)
        return tfidf(term_frequency(terms, id_col), self.idf_table, self.vocab.k, id_col)
