"""Mixture-of-multinomials topic model fitted by Gibbs sampling.

Model: document d has one cluster c_d ~ pi; its words are drawn from mu_{c_d};
pi ~ Dir(alpha), mu_k ~ Dir(beta). One sweep is one Spark job:

1. assign every document: p(k | d) ~ pi_k * prod_w mu_k[w]^{x_dw}, in log space. The documents
   lie in blocks (a table clustered by block, so no sweep shuffles them); the parameters, one
   row per cluster, are sent to every block and met there by a cogroup. The draw is Gumbel-max
   with uniforms hashed from (seed, iteration, doc_id, k), so it is exact sampling,
   reproducible, and independent of how documents are partitioned. Only clusters that can still
   win get a draw, and the hashes of many texts are computed together, in NumPy;
2. the same task adds its documents' counts into a K x V partial sum, so only one row of
   positions and counts per cluster leaves it; they are added up by cluster;
3. pi ~ Dir(alpha + n_k) and mu_k ~ Dir(beta + counts_k) are drawn where the counts lie, a
   cluster in a task: every (cluster, pos) has its own Gamma variate by Marsaglia and Tsang's
   method from hashed uniforms (:func:`log_gamma_draws`), so any engine that can hash can repeat
   the draws.

Nothing of the model passes through the driver, neither counts nor parameters. Differences from
the surveyed job: pi is resampled each sweep (it computed the new alpha but never used it;
``fixed_pi=True`` restores that), and a document without dictionary words keeps posterior pi
instead of failing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.operators import vocab as V

TWO_POW_52 = float(2**52)
MAX_CLUSTERS = 4096  # K x V values are sent to every block of documents
GAMMA_TRIALS = 12  # each is accepted with probability over 0.95
FAN = 64
SCORED_CELLS = 1 << 12  # of documents scored at once
COUNTED_CELLS = 1 << 20  # of documents drawn and counted at once
LONG = 32  # mean cells of documents that are scored one by one
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 24  # (document, word) cells of a block
HASHED = 1 << 14  # texts hashed at once
REACH = 41.0  # Gumbel draws of 52-bit uniforms differ by less: -ln(-ln u) lies in [-3.61, 36.75]
MOST_FORM_BYTES = 1 << 26  # of the tokens of dictionary words that are sent to the tasks
PI = -1  # the ``pos`` of a cluster's own weight, beside those of its words


_ROTATE = [r for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for r in four * 4]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_WORDS = [*range(16), *((5 * i + 1) % 16 for i in range(16, 32)), *((3 * i + 5) % 16 for i in range(32, 48)), *(7 * i % 16 for i in range(48, 64))]


def _md5_blocks(words: np.ndarray) -> np.ndarray:
    """The md5 of messages of one padded block, a message a row of 16 words: four words a row."""
    message = [np.ascontiguousarray(w) if w.any() else None for w in words.T]
    start = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = (np.full(len(words), x, np.uint32) for x in start)
    for i in range(64):
        if i < 16:
            f = c ^ d
            f &= b
            f ^= d
        elif i < 32:
            f = b ^ c
            f &= d
            f ^= c
        elif i < 48:
            f = b ^ c
            f ^= d
        else:
            f = ~d
            f |= b
            f ^= c
        f += a
        f += np.uint32(_SINES[i])
        if message[_WORDS[i]] is not None:
            f += message[_WORDS[i]]
        high = f << np.uint32(_ROTATE[i])
        f >>= np.uint32(32 - _ROTATE[i])
        f |= high
        f += b
        a, d, c, b = d, c, b, f
    return np.stack([x + at for x, at in zip((a, b, c, d), start)], axis=1)


def md5_digests(texts: list[str] | pa.Array) -> np.ndarray:
    """The md5 of each text, 16 bytes a row. Texts of up to 55 bytes are one block of md5 and go
    through its rounds together."""
    texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
    out = np.empty((len(texts), 16), np.uint8)
    for first in range(0, len(texts), HASHED):
        part = texts.slice(first, HASHED)
        ends, data = (np.frombuffer(x or b"", kind) for x, kind in zip(part.buffers()[1:], (np.int32, np.uint8)))
        ends = ends[part.offset : part.offset + len(part) + 1]
        length = np.diff(ends)
        blocks, width = np.zeros((len(part), 64), np.uint8), int(length.max())
        if width > 55:
            out[first : first + len(part)] = [list(hashlib.md5(t.encode()).digest()) for t in part.to_pylist()]
            continue
        blocks[:, :width][np.arange(width) < length[:, None]] = data[ends[0] : ends[-1]]
        blocks[np.arange(len(part)), length] = 0x80
        words = blocks.view("<u4")
        words[:, 14] = length * 8
        out[first : first + len(part)] = _md5_blocks(words.astype(np.uint32)).astype("<u4").view(np.uint8)
    return out


def hash_uniforms(texts: list[str] | pa.Array) -> np.ndarray:
    """U(0,1) from the md5 of each text (13 hex digits = 52 bits, centred)."""
    bits = (md5_digests(texts)[:, :8].copy().view(">u8")[:, 0] >> np.uint64(12)).astype(np.float64)
    return (bits + 0.5) / TWO_POW_52


def _three_uniforms(texts: list[str] | pa.Array) -> np.ndarray:
    """Three U(0,1) from the md5 of each text (10 hex digits = 40 bits each, centred)."""
    digests = md5_digests(texts)
    scale = 256.0 ** np.arange(4, -1, -1)
    return np.stack([(digests[:, s : s + 5] @ scale + 0.5) / 2.0**40 for s in (0, 5, 10)])


def _joined(*parts) -> pa.Array:
    """The texts of arrays and of single values, joined by colons; NULL as Python writes it."""
    return pc.binary_join_element_wise(
        *(p.cast(pa.string()).fill_null("None") if isinstance(p, pa.Array | pa.ChunkedArray) else pa.scalar(str(p)) for p in parts), ":")


def log_gamma_draws(shape: np.ndarray, keys: list[str] | pa.Array) -> np.ndarray:
    """ln of Gamma(shape, 1) variates from hashed uniforms of (key, number).

    Marsaglia and Tsang: with d = a - 1/3, c = 1 / sqrt(9 d), x normal (Box-Muller) and
    v = (1 + c x)^3, d v is a draw when ln u < x^2 / 2 + d - d v + d ln v. The first trial
    accepted counts; after ``GAMMA_TRIALS`` refusals (once in 10^15 draws) the variate is d.
    A shape below 1 draws for shape + 1 and multiplies by U^(1 / shape), in log space, so that
    tiny values do not underflow.
    """
    keys = pa.array(keys, pa.string())
    d = np.where(shape < 1, shape + 1, shape) - 1 / 3
    out, left = np.log(d), np.arange(len(d))
    for i in range(GAMMA_TRIALS):
        u = _three_uniforms(_joined(keys.take(pa.array(left)), i))
        x = np.sqrt(-2 * np.log(u[0])) * np.cos(2 * math.pi * u[1])
        root = 1 + x / np.sqrt(9 * d[left])
        log_v = 3 * np.log(np.maximum(root, 1e-300))
        accept = (root > 0) & (np.log(u[2]) < 0.5 * x * x + d[left] - d[left] * np.exp(log_v) + d[left] * log_v)
        out[left[accept]] += log_v[accept]
        left = left[~accept]
        if not len(left):
            break
    small = np.flatnonzero(shape < 1)
    out[small] += np.log(hash_uniforms(_joined(keys.take(pa.array(small)), "boost"))) / shape[small]
    return out


def doc_term_arrays(docs: DataFrame, tokens: Column, vocab: V.Vocabulary, id_col: str = "doc_id",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *keep, idx[], cnt[])``, one row per document; documents without a
    dictionary word keep empty arrays (a left join from the document table)."""
    cells = vocab.doc_terms(docs, tokens, id_col)
    arr = F.sort_array(F.collect_list(F.struct(F.col("pos").alias("p"), F.col("cnt").alias("c"))))
    packed = cells.groupBy(id_col).agg(arr.alias("cells"))
    base = docs.select(id_col, *keep)
    out = base.join(packed, id_col, "left")
    empty_i = F.array().cast("array<int>")
    empty_c = F.array().cast("array<bigint>")
    return out.select(
        id_col, *keep,
        F.coalesce(F.col("cells.p"), empty_i).alias("idx"),
        F.coalesce(F.col("cells.c"), empty_c).alias("cnt"),
    )


def form_arrays(docs: DataFrame, text: Column, words_of: Callable[[pa.Array], pa.ListArray], forms: DataFrame,
                id_col: str = "doc_id") -> DataFrame:
    """:func:`doc_term_arrays` of the tokens that ``words_of`` finds in an Arrow batch of texts and
    that are ``forms`` ``(form, pos)`` of dictionary words. The forms are sent to the tasks, which
    look them up once per distinct token of some texts; no cell is exchanged. Rows of the same id
    have the cells of all of them, those without an id none, as in a join by id."""
    from sparkloom.session import materialize

    table = forms.select("form", "pos").toArrow().combine_chunks()
    shared = docs.sparkSession.sparkContext.broadcast((pa.concat_arrays(table.column("form").chunks or [pa.array([], pa.string())]), table.column("pos").to_numpy()))

    def count(batches):
        found, pos = shared.value
        pos, size = np.append(pos, -1).astype(np.int64), len(pos) + 1
        size = max(size, int(pos.max()) + 1)
        for batch in V._pieces(batches, most_bytes=V.COUNTED_BYTES):
            words = words_of(batch.column(1))
            coded, length = words.flatten().dictionary_encode(), np.asarray(words.value_lengths())
            of = pos[np.asarray(pc.index_in(coded.dictionary, found).fill_null(len(found)))]
            at = of[np.asarray(coded.indices)]
            cells, n = np.unique((np.repeat(np.arange(len(words)) * size, length) + at)[at >= 0], return_counts=True)
            ends = pa.array(np.searchsorted(cells // size, np.arange(len(words) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, pa.array(cells % size, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(n, pa.int64()))],
                names=[id_col, "idx", "cnt"])

    known = F.col(id_col).isNotNull()
    rows = docs.select(F.col(id_col), F.when(known, text).alias("words"))
    out = rows.mapInArrow(count, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, idx array<int>, cnt array<bigint>")
    twice = docs.filter(known).groupBy(id_col).count().filter("count > 1").select(id_col)
    if twice.isEmpty():
        return out
    out, twice = materialize(out), materialize(twice)
    same = out.join(twice, id_col, "left_semi")
    whole = same.groupBy(id_col).agg(F.sort_array(F.flatten(F.collect_list(F.arrays_zip("idx", "cnt")))).alias("cells"))
    whole = same.select(id_col).join(whole, id_col).select(id_col, F.col("cells.idx").alias("idx"), F.col("cells.cnt").alias("cnt"))
    return out.join(twice, id_col, "left_anti").unionByName(whole)


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` ints that hash partitioning deals into ``n`` partitions, one each (plain numbers
    collide, and a task would get several blocks while others get none)."""
    part = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n))
    first = spark.range(32 * n).groupBy(part.alias("part")).agg(F.min("id").alias("id")).collect()
    found = {r["part"]: r["id"] for r in first}
    return [found.get(i, -1 - i) for i in range(n)]


def in_blocks(doc_arrays: DataFrame, blocks: int | None = None, id_col: str = "doc_id") -> tuple[DataFrame, list[int]]:
    """The documents written in blocks by a hash of their id, and the keys of the blocks. Every
    sweep sends the parameters to each block, so there are as many blocks as cores, unless that
    makes them smaller than ``LEAST_CELLS`` cells, and a multiple of the cores if that makes them
    larger than ``MOST_CELLS``. Every sweep reads the cells, so a document's positions and counts
    are bytes, of the least kind of number that holds the largest of each: a sweep's task gets
    them without a conversion of every value."""
    from sparkloom.session import materialize, materialize_bucketed

    spark = doc_arrays.sparkSession
    doc_arrays = materialize(doc_arrays)
    cells, *largest = doc_arrays.agg(F.sum(F.size("idx").cast("long") + F.lit(1)), F.max(F.array_max("idx")), F.max(F.array_max("cnt"))).first()
    if not blocks:
        cells, cores = cells or 0, spark.sparkContext.defaultParallelism
        blocks = max(1, min(cores, -(-cells // LEAST_CELLS)))
        if cells > blocks * MOST_CELLS:
            blocks = cores * -(-cells // (cores * MOST_CELLS))
    keys, kinds = even_keys(spark, blocks), [np.min_scalar_type(x or 0) for x in largest]
    number = F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int")
    block = F.element_at(F.array(*map(F.lit, keys)), number + 1).cast("int")

    def pack(batches):
        for batch in batches:
            ids, block, *lists = batch.columns
            yield pa.RecordBatch.from_arrays([ids, block, lists[0].value_lengths(), *map(_as_bytes, lists, kinds)], names=["doc_id", "block", "n", "idx", "cnt"])

    rows = doc_arrays.select(F.col(id_col).alias("doc_id"), block.alias("block"), "idx", "cnt")
    packed = rows.mapInArrow(pack, f"doc_id {rows.schema[0].dataType.simpleString()}, block int, n int, idx binary, cnt binary")
    return materialize_bucketed(packed, "block", blocks), keys


def _as_bytes(lists: pa.ListArray, kind: np.dtype) -> pa.Array:
    """The numbers of each list, as bytes."""
    values = np.asarray(lists.flatten()).astype(kind)
    ends = np.append(0, np.cumsum(np.asarray(lists.value_lengths()))) * kind.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])


def _of_bytes(column: pa.Array, cells: int) -> np.ndarray:
    """The numbers of all rows of :func:`_as_bytes`."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return data.view(f"u{len(data) // cells}") if cells else np.zeros(0, np.uint8)


def _runs(docs: pa.Table):
    """(ids, cells a document, positions, counts) of documents of about ``COUNTED_CELLS`` cells."""
    for batch in docs.to_batches():
        length = np.asarray(batch.column("n")).astype(np.int64)
        ends = [*(np.flatnonzero(np.diff(np.cumsum(length + 1) // COUNTED_CELLS)) + 1).tolist(), batch.num_rows]
        for start, end in zip([0, *ends], ends):
            if end > start:
                part, n = batch.slice(start, end - start), length[start:end]
                yield part.column("doc_id"), n, *(_of_bytes(part.column(c), int(n.sum())) for c in ("idx", "cnt"))


COUNTS = "cluster int, pos array<int>, cnt array<long>"


def _counts(clusters, pos: list[np.ndarray], cnt: list[np.ndarray]) -> pa.Table:
    """Rows of ``COUNTS``: some of the positions of a cluster, with their counts."""
    ends = pa.array(np.cumsum([0, *map(len, pos)]), pa.int32())
    def lists(arrays, kind, of):
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays).astype(kind) if arrays else np.zeros(0, kind), of))

    return pa.table({"cluster": pa.array(np.asarray(clusters), pa.int32()),
                     "pos": lists(pos, np.int32, pa.int32()), "cnt": lists(cnt, np.int64, pa.int64())})


def _added(cells: pa.Table, v: int) -> np.ndarray:
    """The counts of one cluster, summed: its weight (``PI``) first, then the ``v`` words."""
    pos, cnt = (np.asarray(cells.column(c).combine_chunks().flatten()) for c in ("pos", "cnt"))
    return np.bincount(pos.astype(np.int64) + 1, weights=cnt, minlength=v + 1)


class _Sweep:
    """The documents of one block scored against the parameters, and their sampled clusters."""

    def __init__(self, docs: pa.Table, params: pa.Table, key: str):
        order = np.argsort(params.column("cluster").to_numpy(), kind="stable")
        self.docs, self.key = docs, key
        self.clusters = params.column("cluster").to_numpy()[order]
        self.log_pi = params.column("log_pi").to_numpy()[order]
        rows = params.column("log_mu").combine_chunks()
        self.by_word = np.ascontiguousarray(np.asarray(rows.flatten()).reshape(len(rows), -1)[order].T)

    def scored(self, length: np.ndarray, idx: np.ndarray, cnt: np.ndarray) -> np.ndarray:
        """ln pi + ln p(words) of every document and cluster."""
        scores = np.tile(self.log_pi, (len(length), 1))
        filled, end = np.flatnonzero(length), np.cumsum(length)
        for part in np.split(filled, np.flatnonzero(np.diff(end[filled] // SCORED_CELLS)) + 1) if len(filled) else []:
            first, last = end[part[0]] - length[part[0]], end[part[-1]]
            words, times, ends = self.by_word.take(idx[first:last], axis=0), cnt[first:last].astype(np.float64), end[part] - first
            if last - first < LONG * len(part):
                words *= times[:, None]
                scores[part] += np.add.reduceat(words, ends - length[part], axis=0)
                continue
            start = 0
            for row, stop in zip(part.tolist(), ends.tolist()):
                scores[row] += times[start:stop] @ words[start:stop]
                start = stop
        return scores

    def drawn(self, ids: pa.Array, scores: np.ndarray) -> np.ndarray:
        """The cluster with the largest sum of score and Gumbel draw. A cluster whose score is more
        than ``REACH`` below the best one cannot have it, so its draw is not made."""
        row, at = np.nonzero(scores >= scores.max(axis=1, keepdims=True) - REACH)
        u = hash_uniforms(_joined(self.key, ids.take(pa.array(row)), pa.array(self.clusters[at])))
        sums = np.full(scores.shape, -np.inf)
        sums[row, at] = scores[row, at] - np.log(-np.log(u))
        return np.argmax(sums, axis=1)

    def assigned(self) -> pa.Table:
        schema = pa.schema({"doc_id": self.docs.schema.field("doc_id").type, "cluster": pa.int32(), "posterior": pa.float64()})
        found = []
        for ids, *cells in _runs(self.docs):
            scores = self.scored(*cells)
            chosen, p = self.drawn(ids, scores), np.exp(scores - scores.max(axis=1, keepdims=True))
            p = p[np.arange(len(p)), chosen] / p.sum(axis=1)
            found.append(pa.record_batch([ids, pa.array(self.clusters[chosen], pa.int32()), pa.array(p)], schema=schema))
        return pa.Table.from_batches(found, schema)

    def counted(self) -> pa.Table:
        """Per cluster its documents (at ``PI``) and the occurrences of its words."""
        v, k = self.by_word.shape
        docs, acc = np.zeros(k, np.int64), np.zeros(k * v)
        for ids, length, idx, cnt in _runs(self.docs):
            chosen = self.drawn(ids, self.scored(length, idx, cnt))
            docs += np.bincount(chosen, minlength=k)
            np.add.at(acc, np.repeat(chosen * v, length) + idx, cnt.astype(np.float64))
        at = [np.flatnonzero(row) for row in acc.reshape(k, v)]
        return _counts(self.clusters, [np.append(PI, a) for a in at], [np.append(n, row[a]) for n, row, a in zip(docs, acc.reshape(k, v), at)])


def _met(docs: DataFrame, blocks: list[int], params: DataFrame, seed: int, iteration: int, work, schema: str) -> DataFrame:
    """``work(sweep)`` of every block of documents with all of the parameters."""
    everywhere = params.select("cluster", "log_pi", "log_mu", F.explode(F.array(*[F.lit(b).cast("int") for b in blocks])).alias("block"))

    def run(block_docs: pa.Table, block_params: pa.Table) -> pa.Table:
        return work(_Sweep(block_docs, block_params, f"{seed}:{iteration}"))

    return docs.groupBy("block").cogroup(everywhere.groupBy("block")).applyInArrow(run, schema)


def assign_step(doc_arrays: DataFrame, params: DataFrame, seed: int, iteration: int, id_col: str = "doc_id",
                blocked: tuple[DataFrame, list[int]] | None = None) -> DataFrame:
    """M19b + M19c: ``(doc_id, cluster, posterior)`` for given parameters ``(cluster, log_pi,
    log_mu)``, one row per cluster with the V values of ``log_mu`` in an array."""
    docs, blocks = blocked or in_blocks(doc_arrays, id_col=id_col)
    return _met(docs, blocks, params, seed, iteration, _Sweep.assigned, "doc_id long, cluster int, posterior double")


def draw_parameters(counts: DataFrame, v: int, alpha: float, beta: float, seed: int, iteration: int, fixed_pi: bool = False) -> DataFrame:
    """M19a, M19d, M19e: pi ~ Dir(alpha + documents) and mu ~ Dir(beta + occurrences) from
    ``COUNTS`` rows; ``(cluster, log_pi, log_mu)``, one row per cluster of ``counts``, each drawn
    in a task of its own. ``log_pi`` is not normalised over the clusters: a constant
    changes no assignment."""

    def draw(key, cells):
        cluster, n = key[0].as_py(), _added(cells, v)
        shape = n + np.append(alpha, np.full(v, beta))
        keys = _joined(f"{seed}:{iteration}:{cluster}", pa.array(np.arange(PI, v)))
        if fixed_pi:
            shape[0], keys = alpha, pa.concat_arrays([pa.array([f"{seed}:0:{cluster}:{PI}"]), keys[1:]])
        g = log_gamma_draws(shape, keys)
        words = g[1:]
        if v:
            words = words - (words.max() + np.log(np.exp(words - words.max()).sum()))
        return pa.table({"cluster": pa.array([cluster], pa.int32()), "log_pi": g[:1], "log_mu": pa.ListArray.from_arrays(pa.array([0, v], pa.int32()), pa.array(words, pa.float64()))})

    return counts.groupBy("cluster").applyInArrow(draw, "cluster int, log_pi double, log_mu array<double>")


def _by_cluster(cells: DataFrame, k: int) -> DataFrame:
    """Cells dealt by cluster, once for their sums and for the draws. The number of partitions is
    given, so that adaptive execution does not merge the draws into one task, and not above the
    ``k`` clusters; a block's cells are summed already, so there is nothing to add up before the
    exchange."""
    return cells.repartition(min(k, int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "cluster")


def _merged(counts: DataFrame, v: int, blocks: int) -> DataFrame:
    """The counts of many blocks added up in ``FAN`` groups a cluster, so that no task of the
    draws gets more rows than that."""
    if blocks <= FAN:
        return counts

    def merge(key, cells):
        n = _added(cells, v)
        at = np.flatnonzero(n)
        return _counts([key[0].as_py()], [at - 1], [n[at]])

    part = F.pmod(F.spark_partition_id(), F.lit(FAN)).alias("part")
    return counts.select("*", part).groupBy("cluster", "part").applyInArrow(merge, COUNTS)


def no_counts(spark, k: int) -> DataFrame:
    """The counts of ``k`` clusters before any document is assigned."""
    return _by_cluster(spark.range(k).select(F.col("id").cast("int").alias("cluster"), F.array(F.lit(PI)).alias("pos"), F.array(F.lit(0).cast("long")).alias("cnt")), k)


@dataclass
class GibbsModel:
    params: DataFrame  # (cluster, log_pi, log_mu) after the last sweep
    used: DataFrame  # those of the last sweep's assignment
    vocab: V.Vocabulary
    seed: int
    last_iteration: int
    blocked: tuple[DataFrame, list[int]]

    def assignments(self) -> DataFrame:
        """The cluster of every document as drawn in the last sweep."""
        return assign_step(None, self.used, self.seed, self.last_iteration, blocked=self.blocked)

    def top_words(self, n: int = 100) -> DataFrame:
        """M20 + T8: ``(topic, rank, word, log_prob)``, n most probable words per topic."""
        rows = self.params.select(F.col("cluster").alias("topic"), F.posexplode("log_mu").alias("pos", "log_prob"))
        best = Window.partitionBy("topic").orderBy(F.col("log_prob").desc(), F.col("pos").asc())
        ranked = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
        return ranked.join(self.vocab.lookup_table(), "pos").select("topic", "rank", "word", "log_prob")


def fit_gibbs(doc_arrays: DataFrame, vocab: V.Vocabulary, k: int = 20, alpha: float = 0.1, beta: float = 0.1,
              iterations: int = 200, seed: int = 0, fixed_pi: bool = False) -> GibbsModel:
    """K-cluster mixture of multinomials by Gibbs sampling."""
    from sparkloom.session import materialize

    if k > MAX_CLUSTERS:
        raise ValueError(f"k = {k} is above MAX_CLUSTERS = {MAX_CLUSTERS}")
    spark = doc_arrays.sparkSession
    v = vocab.table.count()  # dictionary size, at most vocab.k
    docs, blocks = in_blocks(doc_arrays)

    params = used = materialize(draw_parameters(no_counts(spark, k), v, alpha, beta, seed, 0, fixed_pi), known=True)
    for it in range(1, iterations + 1):
        counts = _by_cluster(_merged(_met(docs, blocks, params, seed, it, _Sweep.counted, COUNTS), v, len(blocks)), k)
        used, params = params, materialize(draw_parameters(counts, v, alpha, beta, seed, it, fixed_pi), known=True)
    return GibbsModel(params, used, vocab, seed, iterations, (docs, blocks))


def smoothed_parameters(cluster_terms: DataFrame, clusters: DataFrame, v: int, alpha: float, beta: float) -> DataFrame:
    """Parameters of given clusters ``(cluster, n)``: log (n + alpha), and per word log of
    (count + beta) / (total + V beta) from ``(cluster, pos, cnt)``."""
    grid = full_grid_counts(cluster_terms, clusters, v)
    rows = grid.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("pos", "cnt"))).alias("rows"), F.sum("cnt").alias("total"))
    whole = F.log(F.col("total") + F.lit(v * beta))
    return rows.join(clusters, "cluster").select(
        "cluster", F.log(F.col("n") + F.lit(alpha)).alias("log_pi"),
        F.transform("rows.cnt", lambda c: F.log(c + F.lit(beta)) - whole).alias("log_mu"))


def known_clusters(rows: DataFrame, cluster: str = "cluster", most: int = MAX_CLUSTERS) -> DataFrame:
    """``(cluster, n)``: the clusters that occur, with their rows; an error beyond ``most``."""
    from sparkloom.session import materialize

    found = materialize(rows.filter(F.col(cluster).isNotNull()).groupBy(F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("n")))
    n = found.count()
    if n > most:
        raise ValueError(f"{n} clusters, more than {most}")
    return found


def cluster_cells_of_arrays(doc_arrays: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``(cluster, pos, cnt)`` term counts per cluster from per-document arrays that
    carry their cluster; one row per (document, word) is exploded and summed, with
    map-side partial aggregation before the ``groupBy(cluster, pos)`` exchange."""
    cell = F.explode(F.arrays_zip(F.col("idx").alias("p"), F.col("cnt").alias("c"))).alias("cell")
    return doc_arrays.select(cluster, cell).groupBy(cluster, F.col("cell.p").alias("pos")).agg(
        F.sum("cell.c").alias("cnt"))


def full_grid_counts(cells: DataFrame, clusters: DataFrame, v: int, cluster: str = "cluster") -> DataFrame:
    """Every (cluster, pos) pair with its count, zero when absent.

    The grid is generated per cluster row by ``explode(sequence(0, V-1))`` (K x V rows,
    bounded by the model size) and left-joined to the observed cells.
    """
    grid = clusters.select(cluster, F.explode(F.sequence(F.lit(0), F.lit(v - 1))).alias("pos"))
    return grid.join(cells, [cluster, "pos"], "left").select(
        cluster, "pos", F.coalesce(F.col("cnt"), F.lit(0)).cast("long").alias("cnt")
    )


def top_words_per_topic(grid_counts: DataFrame, vocab: V.Vocabulary, beta: float, n: int = 100,
                        digits: int = 9, cluster: str = "cluster") -> DataFrame:
    """T8 + W3: ``(topic, rank, word, prob)`` from smoothed counts; ties by dictionary position."""
    total = F.sum("cnt").over(Window.partitionBy(cluster))
    v = F.count(F.lit(1)).over(Window.partitionBy(cluster))
    prob = (F.col("cnt") + F.lit(beta)) / (total + v * F.lit(beta))
    ranked = grid_counts.withColumn("prob", prob).withColumn(
        "rank", F.row_number().over(Window.partitionBy(cluster).orderBy(F.col("prob").desc(), F.col("pos").asc()))
    ).where(F.col("rank") <= n)
    return ranked.join(vocab.lookup_table(), "pos").select(
        F.col(cluster).alias("topic"), F.col("rank").cast("long").alias("rank"), "word",
        F.round("prob", digits).alias("prob"),
    )
