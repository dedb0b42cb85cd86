"""Fill-in-middle: brute force over the regular expression, skip lists, round trips, edges."""

from __future__ import annotations

import re

import numpy as np
import pytest
from helpers import NASTY, SF, by_id, sha, table
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.llm import fill_middle
from sparkloom.llm.queries import op12_fill_middle

COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def plain(doc, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = [int(sha(f"1:{'' if doc is None else doc}")[8 * i : 8 * i + 8], 16) for i in range(4)]
    lo, hi = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, len(units), "plain", None, None, sha(text), sha(text)
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return doc, len(units), "spm" if h[3] % 100 < 20 else "psm", len(p), len(m), sha(out), sha(text)


def test_query_equals_brute_force(spark):
    want = sorted((plain(*row) for row in table("documents", columns="doc_id, text")), key=repr)
    assert by_id(op12_fill_middle(spark, SF), *COLUMNS) == want
    assert {r[2] for r in want} == {"plain", "psm", "spm"}


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(1, 40), max_size=700), max_size=6), st.randoms())
def test_skip_lists_reach_every_rank(lists, random):
    bounds = np.cumsum([0] + [len(x) for x in lists])
    chars = np.array([c for x in lists for c in x], np.int64)
    built = fill_middle.SkipLists(bounds, chars)
    ranks = np.array([random.randint(0, len(x)) for x in lists], np.int64)
    node, before = built.find(ranks)
    assert (node - bounds[:-1]).tolist() == ranks.tolist()
    assert before.tolist() == [sum(x[:r]) for x, r in zip(lists, ranks)]


def test_lanes_shrink_and_carry_widths():
    built = fill_middle.SkipLists(np.array([0, 5000, 5000, 5017]), np.full(5017, 3, np.int64))
    assert len(built.lanes) == 4  # 5000, 313, 20 and 2 nodes of the longest list
    for bounds, units, chars in built.lanes:
        assert units.sum() == 5017 and chars.sum() == 3 * 5017 and len(units) == bounds[-1]
        assert np.diff(bounds).tolist()[1] == 0


def test_edges_and_round_trip(spark):
    texts = NASTY + ["<", "a<P>b", "<<S", "é", "a b", "<P", "P><S", "a" * 3 + "<M", "🙂" * 400, "<P><", "x y z " * 60_000]
    rows = [(i, t, i * 1.5, "k") for i, t in enumerate(texts)] + [(None, "no id", 0.0, "k"), (4, "a", 6.0, "k"), (-7, "minus", 1.0, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n double, form string")
    made = fill_middle.transform(docs).withColumn("back", fill_middle.restore(fill_middle.F.col("fim_text"), fill_middle.F.col("fim_form")))
    assert made.columns[:4] == docs.columns
    got = sorted(((r.doc_id, r.fim_units, r.fim_form, r.fim_prefix_chars, r.fim_middle_chars, sha(r.fim_text), sha(r.back)) for r in made.collect()), key=repr)
    assert got == sorted((plain(r[0], r[1]) for r in rows), key=repr)
    assert fill_middle.transform(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="fim_text"):
        fill_middle.transform(docs.withColumn("FIM_Text", fill_middle.F.lit(1)))


def test_cuts_hold_for_every_id(spark):
    text = "Ein Satz, der <oft> geschnitten wird: 漢字 and 3 words_more.\n"
    docs = spark.range(3000).selectExpr("id as doc_id").withColumn("text", fill_middle.F.lit(text))
    got = by_id(fill_middle.transform(docs), "doc_id", "fim_prefix_chars", "fim_middle_chars", "fim_form")
    assert got == sorted(((d, *plain(d, text)[3:5], plain(d, text)[2]) for d in range(3000)), key=repr)
