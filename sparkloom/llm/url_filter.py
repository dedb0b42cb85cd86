"""URL filters: rules first, then a character language-model ratio.

URLs that a rule allows or blocks train two byte models, one per verdict: variable-order
Markov models up to ``ORDER`` bytes of context. Each order's estimate is smoothed with the
next lower one (Dirichlet, ``STRENGTH`` pseudo counts), down to uniform bytes; an order without
evidence falls through. Counts are exact: a context and its byte are one number (`_keys`), and
the counted strings are a written table that grows with the URLs. URLs are scored in blocks:
the strings of a block are looked up order by order, where a string has at most 256 longer
ones, so no join has a crowded key. A URL's score is the difference of its log-likelihoods per
byte; the threshold is calibrated on held-out URLs of known verdict (best balanced accuracy over a
histogram of scores).

Empty and edge input: a NULL URL, or one without ``://``, has empty host and path and no rule;
an empty or NULL URL has nothing to fetch and is blocked, others without a rule are scored;
with URLs of one verdict only, the threshold is 0 and the missing model is uniform; repeated
URLs count as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import kernel
from sparkloom.llm.decontaminate import ascii_lower
from sparkloom.llm.tables import extended
from sparkloom.session import materialize

ORDER, STRENGTH = 5, 2.0
BLOCK_BYTES = 1 << 20  # of URLs that are scored together
BINS, SCALE = 400, 100  # score histogram: hundredths from -2 to 2


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def with_rule(pages: DataFrame, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path`` and the longest fitting rule (``rule``, ``rule_verdict``)."""
    host, path = host_path(F.col(url_col))
    pages = pages.withColumn("host", host).withColumn("path", path)
    name, verdict = F, F
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        name, verdict = name.when(fits, r.text), verdict.when(fits, r.verdict)
    return pages.withColumn("rule", name.otherwise(F.lit(None))).withColumn("rule_verdict", verdict.otherwise(F.lit(None)))


def _keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per position: (bytes of context it has, up to ``ORDER``; context and byte as a number)."""
    inside = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    value = np.zeros(len(data), np.int64)
    for j in range(min(ORDER, len(data) - 1), -1, -1):
        value[j:] = (value[j:] << 8) | np.where(inside[j:] >= j, data[: len(data) - j], 0)
    return np.minimum(inside, ORDER), value


def _key(order, value):
    return (np.asarray(order, np.int64) << 48) | value


def train(urls: DataFrame) -> DataFrame:
    """``(key, good, bad)`` from ``urls (url, good boolean)``: how often each string of a
    context and its byte occurs in the accepted and in the rejected URLs."""

    def count(batches):
        for batch in batches:
            good = np.asarray(batch.column(1)).astype(int)
            for lo, hi, data, offsets in kernel.chunks(batch.column(0)):
                mark = np.repeat(good[lo:hi], np.diff(offsets))
                order, value = _keys(data, offsets)
                for k in range(ORDER + 1):
                    at = np.flatnonzero(order >= k)
                    key, own = np.unique(_key(k, value[at] & ((1 << 8 * (k + 1)) - 1)), return_inverse=True)
                    n = np.bincount(own, minlength=len(key))
                    n_good = np.bincount(own, weights=mark[at], minlength=len(key)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(n_good), pa.array(n - n_good)], names=["key", "good", "bad"])

    rows = urls.select("url", "good").mapInArrow(count, "key long, good long, bad long")
    return materialize(rows.groupBy("key").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))


def _order_of(key: Column) -> Column:
    return F.shiftright(key, 48)


def _shorter(key: Column, k: int) -> Column:
    """The key of the last ``k + 1`` bytes."""
    return key.bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).bitwiseOR(F.lit(k << 48))


def _ratios(wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """``(key, ratio)``: log-likelihood difference of each string ``wanted (key)``."""
    orders = [F.when(_order_of(F.col("key")) >= k, _shorter(F.col("key"), k)) for k in range(ORDER + 1)]
    wanted = materialize(wanted.select(F.explode(F.array(*orders)).alias("key")).filter("key is not null").distinct())
    levels, below = [], None
    for k in range(ORDER + 1):
        context = F.shiftright(F.col("key"), 8)
        own = counts.filter((F.col("key") >= (k << 48)) & (F.col("key") < ((k + 1) << 48)))
        seen = own.groupBy(context.alias("context")).agg(F.sum("good").alias("seen_good"), F.sum("bad").alias("seen_bad"))
        level = wanted.filter((F.col("key") >= (k << 48)) & (F.col("key") < ((k + 1) << 48)))
        level = level.join(own, "key", "left").withColumn("context", context).join(seen, "context", "left")
        if k:
            lower = below.select(F.col("key").alias("lower"), F.col("p_good").alias("q_good"), F.col("p_bad").alias("q_bad"))
            level = level.withColumn("lower", _shorter(F.col("key"), k - 1)).join(lower, "lower")
        else:
            level = level.withColumn("q_good", F.lit(1 / 256)).withColumn("q_bad", F.lit(1 / 256))
        below = materialize(level.select("key", *[
            ((F.coalesce(F.col(x), F.lit(0)) + STRENGTH * F.col(f"q_{x}")) / (F.coalesce(F.col(f"seen_{x}"), F.lit(0)) + STRENGTH)).alias(f"p_{x}")
            for x in ("good", "bad")]))
        levels.append(below)
    both = levels[0]
    for level in levels[1:]:
        both = both.unionAll(level)
    return both.select("key", (F.log("p_good") - F.log("p_bad")).alias("ratio"))


def score(pages: DataFrame, counts: DataFrame, url_col: str = "url", out_col: str = "url_score") -> DataFrame:
    """``pages`` with the log-likelihood difference, accepted minus rejected, per byte of each URL."""
    columns, schema = pages.columns, extended(pages.schema, **{out_col: "double"})
    rows = materialize(pages.withColumn("__row", F.monotonically_increasing_id()))
    size = rows.agg(F.sum(F.octet_length(url_col))).first()[0] or 0
    # by row, so that copies of one URL do not meet in one block
    rows = rows.withColumn("__block", F.pmod(F.xxhash64("__row"), F.lit(max(8, size // BLOCK_BYTES))).cast("int"))

    def strings(key, table):
        found = [np.zeros(0, np.int64)]
        for _, _, data, offsets in kernel.chunks(table.column(1).combine_chunks()):
            found.append(np.unique(_key(*_keys(data, offsets))))
        found = np.unique(np.concatenate(found))
        return pa.table({"block": pa.array(np.full(len(found), key[0].as_py(), np.int32)), "key": pa.array(found)})

    wanted = materialize(rows.select("__block", url_col).groupBy("__block").applyInArrow(strings, "block int, key long"))
    known = wanted.join(_ratios(wanted.select("key"), counts), "key").select("block", "key", "ratio")

    def run(left, right):
        key, ratio = (right.column(c).to_numpy() for c in ("key", "ratio"))
        order = np.argsort(key)
        key, ratio = key[order], ratio[order]
        out = [np.zeros(0)]
        for lo, hi, data, offsets in kernel.chunks(left.column(url_col).combine_chunks()):
            text = np.repeat(np.arange(hi - lo), np.diff(offsets))
            each = ratio[np.searchsorted(key, _key(*_keys(data, offsets)))] if len(data) else np.zeros(0)
            out.append(np.bincount(text, weights=each, minlength=hi - lo) / np.maximum(np.diff(offsets), 1))
        return left.select(columns).append_column(out_col, pa.array(np.concatenate(out)))

    return rows.groupBy("__block").cogroup(known.groupBy("block")).applyInArrow(run, schema)


def calibrate(scored: DataFrame) -> float:
    """Threshold of best balanced accuracy for ``scored (url_score, good)``."""
    edge = F.least(F.greatest(F.floor(F.col("url_score") * SCALE), F.lit(-BINS // 2)), F.lit(BINS // 2))
    rows = scored.groupBy(edge.cast("int").alias("bin"), "good").count().toPandas()
    bins = np.arange(-BINS // 2, BINS // 2 + 1)
    good, bad = (np.zeros(len(bins)) for _ in range(2))
    for b, g, n in rows.itertuples(index=False):
        (good if g else bad)[b + BINS // 2] += n
    if not good.sum() or not bad.sum():
        return 0.0
    # threshold at a bin's lower edge: good from it upwards, bad below it
    accuracy = np.cumsum(good[::-1])[::-1] / good.sum() + (np.cumsum(bad) - bad) / bad.sum()
    best = np.flatnonzero(accuracy >= accuracy.max() - 1e-12)
    return float(bins[best[np.argmin(np.abs(bins[best]))]] / SCALE)


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``url_score`` and ``verdict``."""
    ruled = with_rule(pages, rules, url_col)
    good = (F.col("rule_verdict") == "allow").alias("good")
    held = F.pmod(F.xxhash64(F.col(url_col)), F.lit(5)) == 0
    counts = train(ruled.filter("rule is not null").filter(~held).select(F.col(url_col).alias("url"), good))
    scored = materialize(score(ruled, counts, url_col))
    threshold = calibrate(scored.filter("rule is not null").filter(held).select("url_score", good))
    model = F.when((F.length(F.coalesce(F.col(url_col), F.lit(""))) > 0) & (F.col("url_score") >= threshold), "allow").otherwise("block")
    return scored.withColumn("verdict", F.coalesce("rule_verdict", model)).drop("rule_verdict")
