"""Quality network, language profiles and URL models: held-out accuracy, and naive twins."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import NASTY, SF, table

from sparkloom.llm import language, quality_cnn, url_filter
from sparkloom.llm.queries import URL_RULES, op3_quality_classifier, op5_url_filter, op8_language_id

SF01 = "/root/testdata/sf0.01"


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 3 == 1


def test_quality_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op3_quality_classifier(spark, SF01).collect()}
    assert all(r.held_out == held(d) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in rows.items())
    known = [(rows[d], q) for d, q in table("labels", SF01, "doc_id, quality") if held(d)]
    good, bad = ([r.score for r, q in known if q == x] for x in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.5 for s in good]) > 0.95


def test_features_cover_whole_text():
    net = quality_cnn.Network(1)
    texts = ["", "a", "xyz" * 10, "q" * 511, "w" * 513 + "Z", "long " * 70_000 + "#", None]
    mean, most = quality_cnn.features(pa.array(texts), net, net.tables())
    w = net.params["w"]
    for i, t in enumerate(texts):
        data = np.frombuffer((t or "").encode() + b"\0" * (quality_cnn.WIDTH - 1), np.uint8)
        n = len((t or "").encode())
        if not n:
            assert not mean[i].any() and not most[i].any()
            continue
        r = sum(w[k][data[k : k + n]] for k in range(quality_cnn.WIDTH))
        half = quality_cnn.CHUNK // 2
        starts = range(0, max(n - half, 1), half)
        act = np.maximum(np.stack([r[s : s + 2 * half].max(0) for s in starts]) + net.params["b"], 0)
        assert np.allclose(mean[i], act.mean(0), atol=1e-4) and np.allclose(most[i], act.max(0), atol=1e-4)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(d, t, 1.0) for d, t in enumerate(NASTY)] + [(None, "x", 1.0), (3, "b", 1.0)], "doc_id long, text string, label double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_cnn.score(docs, quality_cnn.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(d, 1) for d in range(10)] + [(None, 0), (4, None)], "doc_id long, quality int")
    net = quality_cnn.fit(docs, one)
    assert {r.score for r in quality_cnn.score(docs, net).collect()} == {1.0}
    assert quality_cnn.keep_good(docs, one).columns == docs.columns
    assert quality_cnn.score(docs.limit(0), net).count() == 0


def naive_grams(text):
    letters, out = ["_"], Counter()
    for ch in text:
        letters.append(ch.lower() if ch.isalpha() and len(ch.lower()) == 1 else ch if ch.isalpha() else "_")
    letters.append("_")
    for i in range(1, len(letters) - 1):
        a, b, c = letters[i - 1 : i + 2]
        if b != "_":
            out[b] += 1
            out[a + b] += 1
            out[a + b + c] += 1
            if c == "_":
                out[b + c] += 1
    return out


def test_language_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op8_language_id(spark, SF01).collect()}
    known = [(rows[d], lang) for d, lang in table("documents", SF01, "doc_id, lang") if held(d)]
    assert np.mean([r.lang_pred == lang for r, lang in known]) > 0.97
    assert all(r.held_out == held(d) and 0 <= r.score <= 1 for d, r in rows.items())


def test_language_counts_and_edges(spark):
    text = "Être ou ne pas ÊTRE, 漢字 x"
    data = np.frombuffer(("ab" + text).encode(), np.uint8)
    keys, n = language._counted(language._chunk_grams(data, np.array([0, 2, len(data)])))
    assert sorted(n[keys >> np.uint64(50) == 1].tolist()) == sorted(naive_grams(text).values())
    rows = [(d, t, "xx" if d % 2 else "yy") for d, t in enumerate(NASTY)] + [(50, "12 34!", "xx"), (None, "hi", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language.learn(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, language.Profiles(learned)).collect()}
    for d, t, _ in rows:
        assert (got[d][0] == "und") == (not any(ch.isalpha() for ch in t or "")) and 0 <= got[d][1] <= 1
    assert language.learn(docs.limit(0)) == {}
    assert {r.lang_pred for r in language.identify(docs, language.Profiles({})).collect()} == {"und"}


def plain_rule(url):
    url = url or ""
    rest = url[url.index("://") + 3 :] if "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.text)) if fit else None
    return host, path, best and best.text, best and best.verdict


def test_url_query(spark):
    got = op5_url_filter(spark, SF).collect()
    urls = dict(table("pages", columns="page_id, url"))
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = plain_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert verdict is None or r.verdict == verdict


URLS = [None, "", "no scheme", "http://", "HTTP://Example.ORG", "x://example.org/en/1/../?q#f", "a://b.com?x=/fr/", "s://é.com/fr/ü",
        "http://notexample.org/es/", "http://u@EXAMPLE.org/es/", "q://a\n.org/\nx", "x://" + "a" * 9000 + ".com/de/"]


def test_url_edges_and_models(spark):
    pages = spark.createDataFrame([(i, u, "p", "z") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    for r in url_filter.judge(pages, URL_RULES).collect():
        host, path, rule, verdict = plain_rule(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if not URLS[r.page_id] else r.verdict))
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0
    made = spark.createDataFrame([(f"http://good{i}.net/a{i % 7}", True) for i in range(300)] + [(f"http://spam-{i}.biz/?x={i}", False) for i in range(300)], "url string, good boolean")
    counts = url_filter.train(made)
    scored = url_filter.score(made, counts, out_col="url_score")
    cut = url_filter.calibrate(scored)
    assert all((r.url_score >= cut) == r.good for r in scored.collect())


def test_url_counts_are_exact(spark):
    """More distinct contexts than a table of fixed size can tell apart."""
    rng = np.random.default_rng(8)
    made = [("".join(chr(33 + c) for c in rng.integers(0, 90, 30)), i % 3 == 0) for i in range(3000)] + [("http://a.net/" + "b" * i, True) for i in range(20)]
    joint, seen = Counter(), Counter()
    for url, good in made:
        for k in range(url_filter.ORDER + 1):
            for i in range(k, len(url)):
                joint[good, url[i - k : i + 1]] += 1
                seen[good, k, url[i - k : i]] += 1

    def naive(url):
        total = 0.0
        for i in range(len(url)):
            p = {True: 1 / 256, False: 1 / 256}
            for k in range(min(url_filter.ORDER, i) + 1):
                for g in p:
                    p[g] = (joint[g, url[i - k : i + 1]] + url_filter.STRENGTH * p[g]) / (seen[g, k, url[i - k : i]] + url_filter.STRENGTH)
            total += np.log(p[True]) - np.log(p[False])
        return total / max(len(url), 1)

    assert len({c for _, k, c in seen if k == url_filter.ORDER}) > 1 << 15
    urls = [u for u, _ in made[::10]] + ["", "x", "http://a.net/bbc", "#" * 50]
    counts = url_filter.train(spark.createDataFrame(made, "url string, good boolean"))
    scored = url_filter.score(spark.createDataFrame([(u,) for u in urls], "url string"), counts)
    got = {r.url: r.url_score for r in scored.collect()}
    assert all(got[u] == pytest.approx(naive(u), abs=1e-9) for u in urls)
