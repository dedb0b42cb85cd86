"""Source divergence: brute force in exact integers, perfect hashes, rounds, tiles and flushes."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import NASTY, ascii_lower

from sparkloom.llm import divergence
from sparkloom.llm.divergence import ONE, PerfectHash, Settings


def brute(docs, min_docs=3, top=200):
    """``docs`` of (lang, source, text)."""
    seen, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text))
        seen[lang].update(set(words))
        count[lang, source].update(words)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= min_docs]
        whole = Counter()
        p = {}
        for s in sources:
            own = {t: count[lang, s][t] for t in kept}
            whole.update(own)
            total = sum(own.values()) + len(kept)
            p[s] = {t: 1 + ONE * (n + 1) // total for t, n in own.items()}
        total = sum(whole.values()) + len(kept)
        q = {t: 1 + ONE * (whole[t] + 1) // total for t in kept}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs, key=utf8)), ("term", sorted(terms, key=utf8)[:top])):
                out += [(lang, s, part, item, -value, i) for i, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def utf8(pair):
    return pair[0], pair[1].encode()


def run(spark, docs, cfg=Settings()):
    frame = spark.createDataFrame(docs, "lang string, source string, text string")
    return sorted(tuple(r) for r in divergence.audit(frame, cfg=cfg).collect())


def made_docs(seed=5, n=260):
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["Ünï", "漢字", "été", "zz"]
    docs = []
    for i in range(n):
        lang = ["aa", "bb", None, "cc"][min(int(rng.integers(0, 6)), 3)]
        source = f"s{int(rng.integers(0, 9))}" if rng.random() < 0.6 else "hot"
        text = " ".join(words[int(x) % len(words)] for x in rng.zipf(1.4, rng.integers(0, 120)))
        docs.append((lang, source, text.upper() if i % 7 == 0 else text))
    return docs


@pytest.mark.parametrize("cfg", [
    Settings(), Settings(shard_bytes=200, round_bytes=400, dense_slots=50, tile=2, block=16), Settings(min_docs=1, top=3, tile=4, shard_bytes=1000)])
def test_equals_brute_force(spark, cfg):
    docs = made_docs()
    assert run(spark, docs, cfg) == brute(docs, cfg.min_docs, cfg.top)


def test_edges(spark):
    docs = [(None, None, t) for t in NASTY] + [("x", s, "one two") for s in "abc"] + [("x", "d", None), ("y", "a", ""), ("y", "b", "9 8"), ("y", None, None)]
    docs += [("x", "a", "one two")] * 4 + [("z", "only", "a b")] * 3 + [("x", "e", "l" * 70_000)] * 3
    assert run(spark, docs) == brute(docs)
    assert run(spark, [("y", "a", "")]) == [] and run(spark, []) == []
    clash = spark.createDataFrame([("x", s, "one two", 1, "p", 2.0) for s in "aab"], "lang string, source string, text string, n int, shard string, v double")
    assert sorted(tuple(r) for r in divergence.audit(clash).collect()) == brute([("x", s, "one two") for s in "aab"])


def test_perfect_hash_is_minimal_and_verifies():
    words = pa.array([f"word{i}" for i in range(20_000)])
    built = PerfectHash.build(divergence._hashes(words), words)
    slots = built.find(divergence._hashes(words), words)
    assert sorted(slots.tolist()) == list(range(20_000))
    assert built.keys.take(pa.array(slots)).equals(words)
    other = pa.array([f"other{i}" for i in range(20_000)])
    assert (built.find(divergence._hashes(other), other) == -1).all()
    assert (built.find(divergence._hashes(words), other) == -1).all()  # right hash, wrong key
    empty = PerfectHash.build(np.zeros(0, np.uint64), pa.array([], pa.string()))
    assert (empty.find(divergence._hashes(words), words) == -1).all()


def test_perfect_hash_with_equal_hashes():
    words = pa.array(["a", "b", "c", "d", "e"])
    hashes = np.array([7, 7, 9, 7, 1], np.uint64)
    built = PerfectHash.build(hashes, words)
    assert built.keys.take(pa.array(built.find(hashes, words))).equals(words)
    assert built.find(np.array([7], np.uint64), pa.array(["q"])).tolist() == [-1]


def test_large_counts_do_not_overflow(spark):
    count, total = 10**13, 3 * 10**13 + 1
    frame = spark.createDataFrame([(count, total)], "c long, t long")
    got = frame.select(divergence._scaled(divergence.F.col("c"), divergence.F.col("t"))).first()[0]
    assert got == 1 + ONE * (count + 1) // total
    assert divergence._scaled_array(np.array([count]), np.array([total])).tolist() == [got]
