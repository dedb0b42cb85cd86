"""Word counts, top-k vocabulary (A1, A2, T2, T4, W1), TF / DF / IDF / TF-IDF in long form
(A8-A11, M7-M10) and train -> test transformation (J1, J2), checked against a
plain-Python computation."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from sparkloom.functions.text import tokens_letters
from sparkloom.operators import vocab as V

TRAIN = [
    (1, "the cat sat on the mat"),
    (2, "the dog sat"),
    (3, "a cat and a dog and a bird"),
    (4, "12345 !!!"),
    (5, "Bird bird BIRD cat"),
]
TEST = [(10, "the cat and the zebra"), (11, "zebra yak"), (12, "dog")]


def _tok(t):
    return re.sub("[^a-zA-Z]", " ", t).lower().split()


def _vocab(docs, k):
    c = Counter(w for _, t in docs for w in _tok(t))
    ranked = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
    return {w: (i, n) for i, (w, n) in enumerate(ranked)}


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(TRAIN, "doc_id long, text string")


def test_word_counts(spark, train):
    got = {r["word"]: r["count"] for r in V.word_counts(train, tokens_letters("text")).collect()}
    assert got == dict(Counter(w for _, t in TRAIN for w in _tok(t)))


@pytest.mark.parametrize("k", [3, 5, 100])
def test_vocabulary_positions_and_ties(spark, train, k):
    vocab = V.Vocabulary.fit(train, tokens_letters("text"), k)
    got = {r["word"]: (r["pos"], r["count"]) for r in vocab.table.collect()}
    assert got == _vocab(TRAIN, k)  # k larger than the vocabulary keeps every word
    tail = [r["pos"] for r in vocab.tail(2).collect()]
    assert tail == sorted(range(len(got)), reverse=True)[:2]


def test_tf_df_idf_tfidf(spark, train):
    k = 6
    model = V.TfIdfModel.fit(train, tokens_letters("text"), k)
    voc = _vocab(TRAIN, k)
    n = len(TRAIN)
    dfreq = Counter(w for _, t in TRAIN for w in set(_tok(t)) if w in voc)
    expected = {}
    for d, t in TRAIN:
        words = [w for w in _tok(t) if w in voc]
        for w, c in Counter(words).items():
            tf = c / len(words)
            expected[(d, voc[w][0])] = tf * math.log(n / dfreq[w])
    got = {(r["doc_id"], r["pos"]): r["tfidf"] for r in model.transform(train, tokens_letters("text")).collect()}
    assert set(got) == set(expected)
    for key, v in expected.items():
        assert got[key] == pytest.approx(v, rel=1e-12, abs=1e-15)
    idf = {r["pos"]: (r["df"], r["idf"]) for r in model.idf_table.collect()}
    assert {p: d for p, (d, _) in idf.items()} == {voc[w][0]: c for w, c in dfreq.items()}


def test_smoothed_idf_and_presence(spark, train):
    model = V.TfIdfModel.fit(train, tokens_letters("text"), 6, smoothing=True)
    for r in model.idf_table.collect():
        assert r["idf"] == pytest.approx(math.log(len(TRAIN) / (1 + r["df"])))
    terms = model.vocab.doc_terms(train, tokens_letters("text"))
    pres = V.presence(terms).collect()
    assert {r["present"] for r in pres} == {1}
    assert len(pres) == terms.count()


def test_train_model_applied_to_test(spark, train):
    model = V.TfIdfModel.fit(train, tokens_letters("text"), 100)
    test = spark.createDataFrame(TEST, "doc_id long, text string")
    out = model.transform(test, tokens_letters("text")).collect()
    voc = _vocab(TRAIN, 100)
    # unknown words (zebra, yak) are dropped; a test doc with no known word has no cells
    assert {r["doc_id"] for r in out} == {10, 12}
    tf10 = {r["pos"]: r["tf"] for r in out if r["doc_id"] == 10}
    assert tf10 == {voc["the"][0]: 2 / 4, voc["cat"][0]: 1 / 4, voc["and"][0]: 1 / 4}


def test_local_model_equals_lazy_model(spark, train):
    model = V.TfIdfModel.fit(train, tokens_letters("text"), 6)
    local = model.localized()
    a = sorted(tuple(r) for r in model.transform(train, tokens_letters("text")).collect())
    b = sorted(tuple(r) for r in local.transform(train, tokens_letters("text")).collect())
    assert a == b


def test_bag_of_words_is_counted_inside_the_row(spark, train):
    docs = train.unionByName(spark.createDataFrame([(6, None), (7, "")], "doc_id long, text string")).repartition(3)
    bow = V.bag_of_words(docs, tokens_letters("text"))
    assert "Exchange" not in V.bag_of_words(train, tokens_letters("text"))._jdf.queryExecution().executedPlan().toString()
    want = {(d, w): n for d, t in TRAIN for w, n in Counter(_tok(t)).items()}
    assert {(r.doc_id, r.word): r.cnt for r in bow.collect()} == want and bow.count() == len(want)
    assert V.bag_of_words(train.limit(0), tokens_letters("text")).count() == 0


def test_words_of_distinct_tokens_equal_words_of_the_text(spark):
    from pyspark.sql import functions as F

    from sparkloom.functions import text as T

    texts = ["A a. (b) ...Foo-bar, x\u00a0foo-bar! --", "", None, "\n\tFOO-BAR;\n ?! \u0130st. \u039f\u0394\u039f\u03a3. e\u2028ee:", "ab.\n", " [c] [cd] d,d "]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    a = V.word_counts(docs, T.tokens_stripped("text"))
    b = V.word_counts(docs, T.tokens_whitespace("text"), T.stripped_token)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and b.filter(F.col("word") == "foo-bar").first()["count"] == 3


def test_bag_of_words_counts_in_bounded_pieces(spark, monkeypatch):
    from pyspark.sql import functions as F

    from sparkloom.functions import text as T

    monkeypatch.setattr(V, "PIECE_WORDS", 5)
    docs = spark.createDataFrame([(i, " ".join(["red", "blue", "red"] * (i % 4))) for i in range(20)] + [(20, None)], "doc_id long, text string")
    tokens = T.tokens_letters("text")
    plain = docs.select("doc_id", F.explode(tokens).alias("word")).groupBy("doc_id", "word").count()
    assert sorted(map(tuple, V.bag_of_words(docs, tokens).collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("most", [4, 1 << 20])
def test_bags_keep_rows_and_their_counts(spark, monkeypatch, most):
    from pyspark.sql import functions as F

    from sparkloom.functions.text import letter_words

    monkeypatch.setattr(V, "PIECE_WORDS", most)
    monkeypatch.setattr(V, "PIECE_BYTES", most)
    rows = [*TRAIN, TRAIN[2], (None, "a b"), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((str(i), sorted(Counter(_tok(t or "")).items())) for i, t in rows)
    for bags in (V.bags(docs, tokens_letters("text"), ["doc_id"]), V.bags(docs, F.col("text"), ["doc_id"], letter_words)):
        assert bags.columns == ["doc_id", "words", "counts"]
        assert sorted((str(r[0]), sorted(zip(r["words"], r["counts"]))) for r in bags.collect()) == want
    got = V.Vocabulary.fit_bow(V.bag_cells(bags), 5).table.collect()
    assert {r["word"]: (r["pos"], r["count"]) for r in got} == _vocab([(i, t or "") for i, t in rows], 5)
