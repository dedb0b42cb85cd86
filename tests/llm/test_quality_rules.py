from __future__ import annotations

import re
from collections import Counter

from helpers import NASTY, SF, by_id, space_words, table

from sparkloom.llm import quality_rules as qr
from sparkloom.llm.queries import op4_quality_rules


def brute(docs):
    out = []
    for doc, text in docs:
        text = text or ""
        w = space_words(text)
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        n, hit = Counter(windows), set()
        for i, x in enumerate(windows):
            if n[x] > 1:
                hit |= set(range(i, i + 8))
        lines = [x for x in text.split("\n") if space_words(x)]
        out.append((doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                    len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_query_equals_brute_force(spark):
    df = op4_quality_rules(spark, SF)
    assert by_id(df, *COLUMNS) == brute(table("documents", columns="doc_id, text"))
    kept = {r.doc_id: r.kept for r in df.collect()}
    assert not any(kept[r.doc_id] for r in df.filter("base_failed").collect())
    labels = table("labels", columns="doc_id, quality")
    good = [kept[d] for d, q in labels if q == 1]
    bad = [kept[d] for d, q in labels if q == 0]
    assert sum(good) > 0.75 * len(good) and sum(bad) < 0.4 * len(bad)


TEXTS = list(enumerate(NASTY)) + [
    (20, "a b c d e f g h i a b c d e f g h"), (21, "same line\nsame line\n \nsame line\n\n"), (21, "same line"),
    (None, "# * $ % & | < > !"), (22, "a b c d e f g h " * 5000),
]


def test_edges(spark):
    docs = spark.createDataFrame([(d, t, 7, 1) for d, t in TEXTS], "doc_id long, text string, n_words int, fail_bits int")
    ledger = qr.with_fail_bits(qr.measure(docs))
    got = by_id(ledger.withColumn("base_failed", qr.fails(qr.BASE)), *COLUMNS)
    assert got == brute(TEXTS)
    assert qr.measure(docs.limit(0)).count() == 0


def test_policies_and_ablation(spark):
    rules = (qr.Rule("a", "x > 1"), qr.Rule("b", "y > 1"), qr.Rule("c", "x > 5"))
    rows = spark.createDataFrame([(0, 0), (2, 0), (2, 2), (6, 0), (None, 3)], "x int, y int")
    ledger = qr.with_fail_bits(rows, rules)
    assert sorted(r.fail_bits for r in ledger.collect()) == [0, 1, 2, 3, 5]
    both, one = qr.Policy("p", 1, ("a", "b")), qr.Policy("p", 2, ("c",))
    got = {(r.version, r.rule): (r.failed, r.only_this_rule, r.rejected, r.documents)
           for r in qr.ablation(ledger, [both, one], rules).collect()}
    assert got == {(1, "a"): (3, 2, 4, 5), (1, "b"): (2, 1, 4, 5), (2, "c"): (1, 1, 1, 5)}
