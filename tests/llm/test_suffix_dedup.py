from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import NASTY, SF, by_id, sha, table

from sparkloom.llm import suffix_dedup
from sparkloom.llm.queries import op6_suffix_dedup
from sparkloom.llm.run_index import RunLengthIndex


def brute(docs, n=100):
    first = {}
    rows = [((2**63 - 1) if d is None else d, d, (t or "").encode()) for d, t in docs]
    for order, _, data in rows:
        for p in range(len(data) - n + 1):
            w = data[p : p + n]
            first[w] = min(first.get(w, (order, p)), (order, p))
    out = []
    for order, d, data in rows:
        gone = bytearray(len(data))
        for p in range(len(data) - n + 1):
            if first[data[p : p + n]] < (order, p):
                gone[p : p + n] = b"\1" * n
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g))))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_query_equals_brute_force(spark):
    got = by_id(op6_suffix_dedup(spark, SF), *COLUMNS)
    assert got == brute(table("documents", columns="doc_id, text"))
    assert sum(r[2] for r in got) > 0


def made():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    base = " ".join(word() for _ in range(120))
    passage = " ".join(word() for _ in range(40))
    rows = list(enumerate(NASTY)) + [(20, base), (21, base), (21, base), (None, base), (None, "é" * 80), (22, "é" * 90)]
    for i in range(60):
        w = base.split()
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = word()
        rows.append((100 + i, " ".join(w)))
        rows.append((300 + i, " ".join(word() for _ in range(8)) + " " + passage + " " + word()))
    rows += [(500, "ab" * 400), (501, "x" + "ab" * 300), (502, passage + "\n" + passage), (50, "z" * 99), (51, "z" * 100), (52, "z" * 101)]
    return rows


@pytest.mark.parametrize("hot", [20_000, 5])
def test_copies_and_edges(spark, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLAB", 1 << 9)
    rows = made()
    docs = spark.createDataFrame([(d, t, 1, "b") for d, t in rows], "doc_id long, text string, block int, removed string").repartition(4)
    assert by_id(suffix_dedup.summary(suffix_dedup.marked(docs, hot=hot)), *COLUMNS) == brute(rows)
    assert suffix_dedup.summary(suffix_dedup.marked(docs.limit(0))).count() == 0


def test_hot_windows_reach_the_index_once_per_block(spark):
    """A passage in many different surroundings: the index gets each of its windows once a block."""
    from pyspark.sql import functions as F

    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage = letters(150)
    rows = [(i, letters(60) + passage + letters(60)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert by_id(suffix_dedup.summary(suffix_dedup.marked(docs, hot=5)), *COLUMNS) == brute(rows)
    blocks = docs.withColumn("text_key", F.xxhash64("text")).withColumn("block", (F.col("doc_id") % 2).cast("int"))
    settled = suffix_dedup.materialize(suffix_dedup._settle(suffix_dedup._send(blocks, 8), 5))
    sent = {}
    for r in suffix_dedup._fetch(blocks, settled, 8).collect():
        at = 0
        for size in np.frombuffer(r.pieces, suffix_dedup._PIECE)["size"].tolist():
            if size == suffix_dedup.WINDOW:
                one = bytes(r.body[at : at + size])
                sent[one] = sent.get(one, 0) + 1
            at += size
    assert any(one.decode() in passage for one in sent) and max(sent.values()) <= 2


def test_run_length_index():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(0, 40))) for _ in range(30)] + [b"ab" * 30, b"ab" * 25, b"", b"ab" * 30]
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    keys = np.arange(len(data), dtype=np.uint64)
    depth = 9
    index = RunLengthIndex(data, sizes, keys, depth)
    joined = b"".join(bytes([0, 0]) + t.replace(b"", b"") for t in texts)
    assert joined is not None and len(index.start) < len(data)
    begin = np.cumsum(sizes) - sizes
    spell = {i: [] for i in range(len(texts))}
    rows_of = np.arange(len(texts))
    for alive, length, rows in index.matching_statistics():
        symbol, _ = index.step(rows_of[alive])
        rows_of[alive] = rows
        for i, c, r in zip(alive.tolist(), symbol.tolist(), rows.tolist()):
            spell[i].append(c - 1)
            at = sizes[i] - length
            if length >= depth:
                w = texts[i][at : at + depth]
                least = min(begin[j] + p for j, t in enumerate(texts) for p in range(len(t) - depth + 1) if t[p : p + depth] == w)
                assert index.least_key(np.array([r]))[0] == least
    assert [bytes(reversed(spell[i])) for i in range(len(texts))] == texts
    # a run's sample is the text position of its last row
    for k in (0, len(index.start) // 2, len(index.start) - 1):
        assert index.symbols[index.sample[k] - 1] == index.symbol[k]
