from __future__ import annotations

import random
from collections import defaultdict

import pytest
from helpers import NASTY, SF, ascii_lower, by_id, space_words, table

from sparkloom.llm import jaccard_join as jj
from sparkloom.llm.components import components
from sparkloom.llm.queries import op7_jaccard_join


def brute(docs, k=4, percent=85):
    sets, ids = [], []
    for doc, text in docs:
        w = space_words(ascii_lower(text))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
        ids.append(doc)
    parent = {d: d for d in ids if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        if ids[i] is not None:
            for g in s:
                holders[g].append(i)
    common = defaultdict(int)
    for h in holders.values():
        for x in range(len(h)):
            for y in range(x + 1, len(h)):
                common[h[x], h[y]] += 1
    for (i, j), c in common.items():
        if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
            a, b = find(ids[i]), find(ids[j])
            parent[max(a, b)] = min(a, b)
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in zip(ids, sets)), key=repr)


COLUMNS = ("doc_id", "n_shingles", "component_id")


def test_query_equals_brute_force(spark):
    got = by_id(op7_jaccard_join(spark, SF), *COLUMNS)
    assert got == brute(table("documents", columns="doc_id, text"))
    assert any(r[0] != r[2] for r in got)


def near_copies(n=150):
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(90)]
    passage = " ".join(f"p{rng.randrange(300)}" for _ in range(60))
    out = [(1000, " ".join(base))]
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(1, 7)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append((i, " ".join(w)))
    out += [(2000 + i, " ".join(f"q{rng.randrange(10**5)}" for _ in range(12)) + " " + passage) for i in range(60)]
    out += [(3000 + i, " ".join(base)) for i in range(40)]
    return out


@pytest.mark.parametrize("cfg", [jj.Settings(), jj.Settings(words=5, percent=80, crowd=3, block=16),
                                 jj.Settings(hot=20, crowd=4, block=8, fragments=1)])
def test_crowded_groups(spark, cfg, monkeypatch):
    rows = near_copies()
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, component_id string").repartition(5)
    assert by_id(jj.classes(docs, cfg=cfg), *COLUMNS) == brute(rows, cfg.words, cfg.percent)


@pytest.mark.parametrize("near, hot", [(2, 10), (10, 60)])
def test_hot_shingles_of_few_distinct_sets(spark, near, hot):
    """Copies make the shingles hot; each share gets fewer distinct sets than a crowd has."""
    base = [f"w{i}" for i in range(90)]
    rows = [(i, " ".join(base)) for i in range(200)]
    rows += [(1000 + i, " ".join(base[: 8 * i] + [f"e{i}"] + base[8 * i + 1 :])) for i in range(near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = by_id(jj.classes(docs, cfg=jj.Settings(hot=hot)), *COLUMNS)
    assert got == brute(rows) and {r[2] for r in got} == {0}


def test_edges(spark):
    rows = list(enumerate(NASTY)) + [(40, "a"), (41, "A"), (42, "a b"), (43, "b a"), (44, "a b"), (44, "a b"), (None, "a b"),
                                     (None, None), (45, "word " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(jj.classes(docs), *COLUMNS) == brute(rows)
    assert jj.classes(docs.limit(0)).count() == 0
    kept = jj.keep_one(docs)
    assert kept.columns == docs.columns
    drop = {d for d, _, c in brute(rows) if d is not None and c != d}
    assert sorted(map(repr, (tuple(r) for r in kept.collect()))) == sorted(repr(r) for r in rows if r[0] not in drop)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in parent:
        for u, v in edges:
            parent[u] = parent[v] = min(parent[u], parent[v])
    assert got == {x: c for x, c in parent.items() if any(x in e and e[0] != e[1] for e in edges)}


def chain(ids):
    return [(ids[i], ids[i + 1]) for i in range(len(ids) - 1)]


@pytest.mark.parametrize("shape, most", [("rising", 15), ("shuffled", 40), ("ring", 15), ("star", 10)])
def test_components_in_logarithmic_rounds(spark, monkeypatch, shape, most):
    """A component of 1 000 nodes; every written table is a round of jobs."""
    from sparkloom.llm import components as module

    ids = list(range(5, 1005))
    if shape == "shuffled":
        random.Random(2).shuffle(ids)
    edges = chain(ids) + ([(ids[-1], ids[0])] if shape == "ring" else [])
    if shape == "star":
        edges = [(777, i) for i in ids if i != 777]
    written = []
    real = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df: written.append(1) or real(df))
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long").repartition(2)).collect()}
    assert got == dict.fromkeys(ids, 5)
    assert len(written) <= most


def thue_morse(n):
    out = "a"
    while len(out) < n:
        out += out.translate(str.maketrans("ab", "ba"))
    return out[:n]


def test_structured_words_do_not_meet(spark):
    """The sequence and its complement have one polynomial hash modulo 2^64, for every base."""
    word = thue_morse(2048)
    pairs = [(word, word.translate(str.maketrans("ab", "ba"))), ("x" * 64 + "y", "x" * 64 + "z"), ("ab" * 4, "ba" * 4), ("a", "a" * 9)]
    rows = [(2 * i + j, w) for i, pair in enumerate(pairs) for j, w in enumerate(pair)]
    docs = spark.createDataFrame(rows + [(100 + d, w) for d, w in rows], "doc_id long, text string")
    assert by_id(jj.classes(docs), *COLUMNS) == sorted([(d, 1, d % 100) for d, _ in rows] + [(100 + d, 1, d) for d, _ in rows], key=repr)


def test_sketches_never_differ_in_more_bits_than_the_sets():
    import numpy as np

    rng = np.random.default_rng(3)
    sets = []
    for size in (1, 5, 63, 64, 65, 127, 128, 129, 1000, 5000):
        base = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        sets += [base, base[: max(1, len(base) - len(base) // 9)], np.append(base, np.uint64(7))]
    bounds = np.append(0, np.cumsum([len(s) for s in sets]))
    sketches = jj.parity_sketches(bounds, np.concatenate(sets)).to_pylist()
    pairs = [(i, j) for i in range(len(sets)) for j in range(i + 1)]
    apart = jj._distance([sketches[i] for i, _ in pairs], [sketches[j] for _, j in pairs])
    for (i, j), d in zip(pairs, apart.tolist()):
        assert d <= len(np.setxor1d(sets[i], sets[j]))
        assert d == 0 or i != j
    assert apart[pairs.index((len(sets) - 1, 0))] > 0  # unrelated sets differ
    assert jj._distance([], []).tolist() == []
    assert jj.parity_sketches(np.array([0, 0]), np.zeros(0, np.uint64)).to_pylist() == [bytes(8)]
