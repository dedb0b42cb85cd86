"""Approximate nearest neighbours by balanced posting lists.

1. Rows with equal vectors are one class (SHA-256 of the vector's doubles). Of each class the
   k + 1 smallest ids are kept with the nearest classes at the end: no other id of it can be
   among the k nearest of any query. The class itself is one posting, so a vector that a third
   of the rows share makes no list longer.
2. A bounded sample of classes is cut into balanced clusters: recursive halving at the median of
   the direction between two means, so every cluster gets equal shares of the sample. There is
   one list per ``list_rows`` rows, ``max_lists`` at most; then lists get longer and are dealt
   out in blocks. Only the centroids and their neighbour graph are broadcast: ``max_lists`` times
   a vector and ``2 * degree`` integers each, whatever the number of rows.
3. Every class is posted to its nearest list and, if it lies near a boundary, also to others: up
   to ``replicas`` lists within ``spread`` times the distance of the nearest. Centroids are found
   by beam search in the graph.
4. A query takes the lists within ``ratio`` times the distance of its nearest one, ``probes`` at
   most, and meets their postings list by list. Each list keeps its k + 1 nearest classes under
   (distance, smallest id), and these are merged over the lists.

Distances are Euclidean, in double precision on the original vectors: a matrix product proposes,
differences decide.

Defined results: vectors that are NULL, empty, all zero, hold a NULL or non-finite component, or
are not as long as most vectors are (ties: the longest) take no part, nor do rows without an id.
An id with several vectors is a candidate by each of them, so at its smallest distance, and
searches with its smallest vector; repeated rows count once. A row's own id is never its result.
Ties go to the smaller id; with fewer than k candidates all are returned; an empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.session import materialize


@dataclass(frozen=True)
class Settings:
    k: int = 10
    list_rows: int = 256  # rows per list, before replication
    max_lists: int = 16_384
    sample_rows: int = 131_072  # rows that the clusters are fitted on, at most (about)
    replicas: int = 2
    spread: float = 1.05
    ratio: float = 1.12
    probes: int = 256
    degree: int = 16
    block: int = 4096  # postings of a list that a task meets at a time, about


class CentroidGraph:
    """Centroids with the edges of their nearest-neighbour graph, searched by a beam."""

    def __init__(self, centroids: np.ndarray, degree: int):
        self.centroids = np.ascontiguousarray(centroids, np.float64)
        self.squares = (self.centroids**2).sum(1)
        near = _neighbours(self.centroids, self.squares, degree)
        self.edges = _both_ways(near, self.centroids, 2 * degree)
        # a search starts at evenly spread centroids, with one in every component of the graph
        n = len(centroids)
        entries = np.arange(0, n, max(1, int(np.sqrt(n))))
        self.entries = np.unique(np.append(entries, np.unique(_components(self.edges))))

    def nearest(self, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(lists, distances) of the ``beam`` nearest centroids found, nearest first; -1 and
        infinity where there are fewer."""
        found, far = [], []
        for s in range(0, len(vectors), 256):
            a, b = self._search(vectors[s : s + 256], beam)
            found.append(a)
            far.append(b)
        if not found:
            return np.zeros((0, beam), np.int32), np.zeros((0, beam))
        return np.concatenate(found), np.concatenate(far)

    def _search(self, x, beam):
        rows, square = np.arange(len(x))[:, None], (x**2).sum(1)[:, None]
        # one slot more than centroids: edge -1 leads there and counts as seen
        seen = np.zeros((len(x), len(self.centroids) + 1), bool)
        seen[:, -1] = True
        seen[:, self.entries] = True
        node = np.broadcast_to(self.entries, (len(x), len(self.entries))).astype(np.int32)
        far = self.squares[self.entries] - 2 * (x @ self.centroids[self.entries].T)
        open_ = np.ones(node.shape, bool)
        while True:
            if node.shape[1] > beam:
                best = np.argpartition(far, beam - 1, axis=1)[:, :beam]
                node, far, open_ = node[rows, best], far[rows, best], open_[rows, best]
            if not open_.any():
                break
            wide = min(4, node.shape[1])
            pick = np.argpartition(np.where(open_, far, np.inf), wide - 1, axis=1)[:, :wide]
            ends = self.edges[node[rows, pick]]
            ends[~open_[rows, pick]] = -1
            open_[rows, pick] = False
            ends = np.sort(ends.reshape(len(x), -1), axis=1)
            fresh = ~seen[rows, ends]
            fresh[:, 1:] &= ends[:, 1:] != ends[:, :-1]
            seen[rows, ends] = True
            width = int(fresh.sum(1).max())
            if not width:
                continue
            first = np.argsort(~fresh, axis=1, kind="stable")[:, :width]
            ends, fresh = ends[rows, first], fresh[rows, first]
            step = self.squares[ends] - 2 * np.einsum("nd,ned->ne", x, self.centroids[ends])
            node = np.concatenate([node, ends], 1)
            far = np.concatenate([far, np.where(fresh, step, np.inf)], 1)
            open_ = np.concatenate([open_, fresh], 1)
        order = np.argsort(far, axis=1, kind="stable")
        node, far = node[rows, order], far[rows, order]
        out, dist = np.full((len(x), beam), -1, np.int32), np.full((len(x), beam), np.inf)
        out[:, : node.shape[1]] = np.where(np.isfinite(far), node, -1)
        dist[:, : node.shape[1]] = np.sqrt(np.maximum(far + square, 0))
        return out, dist


def _neighbours(centroids, squares, degree):
    """The nearest other centroids of each, -1 where there are fewer."""
    n = len(centroids)
    out = np.full((n, degree), -1, np.int32)
    wide = min(degree, n - 1)
    for s in range(0, n if wide > 0 else 0, 1024):
        far = squares - 2 * (centroids[s : s + 1024] @ centroids.T)
        far[np.arange(len(far)), np.arange(s, s + len(far))] = np.inf
        out[s : s + 1024, :wide] = np.argpartition(far, wide - 1, axis=1)[:, :wide]
    return out


def _both_ways(near, centroids, most):
    """Edges in both directions, the ``most`` shortest of each centroid."""
    a, b = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel().astype(np.int64)
    a, b = a[b >= 0], b[b >= 0]
    once = np.unique(np.concatenate([a * len(near) + b, b * len(near) + a]))
    a, b = once // len(near), once % len(near)
    order = np.lexsort((((centroids[a] - centroids[b]) ** 2).sum(1), a))
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    out = np.full((len(near), most), -1, np.int32)
    kept = place < most
    out[a[kept], place[kept]] = b[kept]
    return out


def _components(edges):
    """The smallest centroid that reaches each one over the edges kept."""
    label = np.arange(len(edges))
    while True:
        reached = np.where(edges >= 0, label[edges], len(edges)).min(1, initial=len(edges))
        step = np.minimum(label, reached)
        step = step[step]
        if (step == label).all():
            return label
        label = step


def balanced_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Means of ``lists`` clusters of equal share (within one row a cut) of the sample."""
    out, open_ = [], [(np.arange(len(sample)), lists)]
    while open_:
        rows, parts = open_.pop()
        own = sample[rows]
        mean = own.mean(0)
        if parts < 2 or len(rows) < 2 * parts:
            out.append(mean)
            continue
        own = own - mean
        cut = len(rows) * (parts // 2) // parts
        direction = own[np.argmax((own**2).sum(1))]
        for _ in range(4):  # two means, halves kept equal
            order = np.argpartition(own @ direction, cut)
            direction = own[order[cut:]].mean(0) - own[order[:cut]].mean(0)
        order = np.argpartition(own @ direction, cut)
        open_.append((rows[order[:cut]], parts // 2))
        open_.append((rows[order[cut:]], parts - parts // 2))
    return np.stack(out)


def _matrix(column) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _matrix(column) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _usable(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``(vec_id, vector)`` of the rows that take part, and their number."""
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    common = rows.groupBy(F.size("vector").alias("size")).count().agg(F.max(F.struct("count", "size")).alias("m")).first()["m"]
    if common is None:
        return rows, 0
    return rows.filter(F.size("vector") == common["size"]), common["count"]


def _keyed(rows: DataFrame) -> DataFrame:
    """``(vec_id, vector, key)``: the key is a digest of the vector's doubles."""

    def run(batches):
        for batch in batches:
            matrix = _matrix(batch.column(1)) + 0.0  # -0.0 equals 0.0
            keys = [hashlib.sha256(x.tobytes()).digest() for x in matrix]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=["vec_id", "vector", "key"])

    return rows.mapInArrow(run, f"vec_id long, vector {_kind(rows)}, key binary")


def _kind(rows: DataFrame) -> str:
    return rows.schema["vector"].dataType.simpleString()


def _listed(classes: DataFrame, graph, beam: int, most: int, ratio: float) -> DataFrame:
    """``classes (key, first, vector)`` once per list within ``ratio`` times the distance of the
    nearest one, ``most`` at most."""

    def run(batches):
        for batch in batches:
            lists, far = graph.value.nearest(_matrix(batch.column("vector")), beam)
            lists, far = lists[:, :most], far[:, :most]
            row, place = np.nonzero((lists >= 0) & (far <= ratio * far[:, :1]))
            kept = [batch.column(c).take(pa.array(row)) for c in ("key", "first", "vector")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(lists[row, place], pa.int32())], names=["key", "first", "vector", "list"])

    return classes.select("key", "first", "vector").mapInArrow(run, f"key binary, first long, vector {_kind(classes)}, list int")


def _classes(keyed: DataFrame) -> DataFrame:
    """``(key, first, vector)``: distinct vectors with their smallest id."""
    return keyed.groupBy("key").agg(F.min("vec_id").alias("first"), F.first("vector").alias("vector"))


@dataclass(frozen=True)
class Index:
    """All usable rows ``(vec_id, vector, key)``, the broadcast graph over the lists' centroids,
    and the number of blocks that a list is dealt into."""

    rows: DataFrame
    graph: object
    lists: int
    blocks: int
    cfg: Settings

    def postings(self) -> DataFrame:
        """``(key, first, vector, list, block)``: every class in each of its lists."""
        cfg = self.cfg
        listed = _listed(_classes(self.rows), self.graph, 2 * cfg.replicas + 8, cfg.replicas, cfg.spread)
        return listed.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(self.blocks)).cast("int"))


def build(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cfg: Settings = Settings()) -> Index:
    """An index of every usable row. Lists are fitted on the distinct vectors of a hash sample."""
    rows, n = _usable(rows, id_col, vector_col)
    keyed = _keyed(rows)
    wanted = max(1, min(n // cfg.list_rows, cfg.max_lists))
    sample = np.zeros((0, 0))
    if n:
        share = max(1, min(1 << 30, (cfg.sample_rows << 30) // n))
        picked = keyed.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share)
        found = picked.groupBy("key").agg(F.first("vector").alias("vector")).select("vector").limit(2 * cfg.sample_rows)
        sample = _matrix(found.toArrow().column(0))
    if not len(sample) and n:  # a few rows, none of them drawn
        sample = _matrix(rows.select("vector").limit(1).toArrow().column(0))
    if len(sample):
        sample = sample[np.lexsort(sample.T[::-1])]  # rows arrive in any order; the fit does not depend on it
        centroids = balanced_centroids(sample, wanted)
    else:
        centroids = np.zeros((1, 1))
    graph = rows.sparkSession.sparkContext.broadcast(CentroidGraph(centroids, cfg.degree))
    blocks = max(1, -(-n * cfg.replicas // (len(centroids) * cfg.block)))
    return Index(keyed, graph, len(centroids), blocks, cfg)


def _best(dist: np.ndarray, first: np.ndarray, keep: int) -> np.ndarray:
    """The ``keep`` smallest by (distance, id)."""
    if len(dist) > keep:
        some = np.flatnonzero(dist <= np.partition(dist, keep - 1)[keep - 1])
    else:
        some = np.arange(len(dist))
    return some[np.lexsort((first[some], dist[some]))][:keep]


def _meet(keep: int):
    """Cogroup function: the ``keep`` nearest postings of a list's block for each query."""

    def run(queries, postings):
        q, x = _matrix(queries.column("vector")), _matrix(postings.column("vector"))
        out_query, out_row, out_far = [], [], []
        if len(q) and len(x):
            first = postings.column("first").to_numpy()
            squares = (x**2).sum(1)
            for s in range(0, len(q), 64):
                some = q[s : s + 64]
                own = (some**2).sum(1)
                near = own[:, None] + squares - 2 * (some @ x.T)
                # the product is off by some 1e-14 of the squares; differences decide inside that
                slack = 1e-10 * (own + squares.max())
                if len(x) > keep:
                    near_enough = np.partition(near, keep - 1, axis=1)[:, keep - 1] + slack
                else:
                    near_enough = np.full(len(some), np.inf)
                for i in range(len(some)):
                    rows = np.flatnonzero(near[i] <= near_enough[i])
                    dist = np.sqrt(((x[rows] - some[i]) ** 2).sum(1))
                    best = _best(dist, first[rows], keep)
                    out_query.append(np.full(len(best), s + i))
                    out_row.append(rows[best])
                    out_far.append(dist[best])
        at = np.concatenate(out_query) if out_query else np.zeros(0, np.int64)
        row = np.concatenate(out_row) if out_row else np.zeros(0, np.int64)
        return pa.table({
            "query": queries.column("key").take(pa.array(at)).cast(pa.binary()), "key": postings.column("key").take(pa.array(row)).cast(pa.binary()),
            "first": postings.column("first").take(pa.array(row)),
            "score": pa.array(np.concatenate(out_far) if out_far else np.zeros(0, np.float64))})

    return run


def search(index: Index, queries: DataFrame) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows ``(vec_id, vector, key)`` of ``queries``,
    rows of ``index.rows``."""
    cfg, keep = index.cfg, index.cfg.k + 1
    asked = queries.groupBy("vec_id").agg(F.min(F.struct("vector", "key")).alias("v")).select("vec_id", "v.vector", "v.key")
    asked = materialize(asked)
    listed = _listed(_classes(asked), index.graph, cfg.probes, cfg.probes, cfg.ratio)
    listed = listed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(index.blocks - 1))))
    met = (
        listed.groupBy("list", "block").cogroup(index.postings().groupBy("list", "block"))
        .applyInArrow(_meet(keep), "query binary, key binary, first long, score double")
    )
    near = Window.partitionBy("query").orderBy("score", "first", "key")
    # a class comes from each of its lists with one and the same distance
    nearest = met.withColumn("at", F.dense_rank().over(near)).filter(F.col("at") <= keep).select("query", "key", "score").distinct()
    by_id = Window.partitionBy("key").orderBy("vec_id")
    members = index.rows.select("key", "vec_id").distinct().withColumn("at", F.row_number().over(by_id)).filter(F.col("at") <= keep).drop("at")
    # k + 1 ids per distinct query: one of them may be the asking row itself
    by_score = Window.partitionBy("query").orderBy("score", "vec_id")
    found = (
        nearest.join(members, "key").groupBy("query", "vec_id").agg(F.min("score").alias("score"))
        .withColumn("at", F.row_number().over(by_score)).filter(F.col("at") <= keep)
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("found"))
    )
    return _answers(asked.select("vec_id", "key"), found, cfg.k)


def _answers(asked: DataFrame, found: DataFrame, k: int, share: int = 4096) -> DataFrame:
    """Each asking row's results, from those of its vector. Rows that ask with one vector are
    dealt into shares of about ``share``."""
    hot = asked.groupBy("key").agg(F.ceil(F.count("*") / share).cast("int").alias("shares")).filter("shares > 1")
    shares = F.coalesce("shares", F.lit(1))
    own = asked.join(hot, "key", "left").select(
        F.col("vec_id").alias("query_id"), "key", F.pmod(F.xxhash64("vec_id"), shares).cast("int").alias("share"))
    spread = found.withColumnRenamed("query", "key").join(hot, "key", "left").select(
        "key", "found", F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))
    others = F.slice(F.filter("found", lambda r: r["vec_id"] != F.col("query_id")), 1, k)
    return (
        own.join(spread, ["key", "share"])
        .select("query_id", F.posexplode(others).alias("rank", "hit"))
        .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), "hit.score")
    )


def nearest(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, cfg: Settings = Settings()) -> DataFrame:
    """The ``cfg.k`` nearest other rows of every row whose id is divisible by ``every``."""
    index = build(rows, id_col, vector_col, cfg)
    return search(index, index.rows.filter(F.col("vec_id") % every == 0))
