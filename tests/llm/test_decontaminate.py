from __future__ import annotations

import re

import pytest
from helpers import NASTY, SF, ascii_lower, by_id, sha, table

from sparkloom.llm import decontaminate
from sparkloom.llm.queries import op1_decontaminate

DOCS = "doc_id long, text string, bench_x int, item_id string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            for i in range(max(1, len(w) - size + 1)):
                windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    ids |= found
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_query_equals_brute_force(spark):
    got = by_id(op1_decontaminate(spark, SF), *COLUMNS)
    assert got == brute(table("documents", columns="doc_id, text"), table("benchmark", columns="item_id, text"))
    assert any(r[5] for r in got)


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Short item"), (3, "single"), (4, None), (5, "  "), (6, "Short item"), (None, "nameless item here"),
    (10, "word word word word word word word word word word word"),
]
TEXTS = [(i, t) for i, t in enumerate(NASTY)] + [
    (50, "x ONE two, three four five six seven eight nine ten y"), (51, "one two three four five six seven eight nine"),
    (52, "the short ITEM is single"), (52, "the short ITEM is single"), (None, "short item"), (53, "short items"),
    (54, "pad " * 5000 + "two three four five six seven eight nine ten eleven twelve " + "short item " * 40),
]


@pytest.mark.parametrize("block_bytes", [64 << 20, 900])
def test_edges_and_blocks(spark, block_bytes):
    docs = spark.createDataFrame([(d, t, 1, "z") for d, t in TEXTS], DOCS)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.annotate(docs, items, block_bytes=block_bytes)
    got = sorted(
        ((r.doc_id, r.bench_words, sum(s.end - s.start for s in r.bench_spans), len(r.bench_items),
          sha(",".join(r.bench_items)), bool(r.bench_spans)) for r in out.collect()), key=repr)
    assert got == brute(TEXTS, ITEMS)
    assert out.columns[:4] == docs.columns


def test_empty_tables_and_removal(spark):
    docs = spark.createDataFrame([(d, t, 1, "z") for d, t in TEXTS], DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.remove_contaminated(docs, none).count() == len(TEXTS)
    assert decontaminate.annotate(docs.limit(0), items).count() == 0
    kept = decontaminate.remove_contaminated(docs, items)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r[0] for r in brute(TEXTS, ITEMS) if not r[5])


def test_query_equals_its_sql(spark):
    from sparkloom.llm.oracle import ORACLE_SQL
    from sparkloom.plans.check import compare, duckdb_connection

    problems, n, _, _ = compare(spark, duckdb_connection(SF), "op1", op1_decontaminate, ORACLE_SQL["op1_decontaminate"], SF)
    assert not problems and n == 200
