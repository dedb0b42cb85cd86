"""Batched k-nearest-neighbour classification (M11, M12) for sparse and dense vectors.

Plan, for Q queries against D labelled rows:

1. Queries and candidates are cut into blocks of about ``block_cells`` cells by a hash of their
   ids, and every block of queries meets every block of candidates in one task of a shuffle
   cogroup. Neither side is broadcast or collected; a task holds one block of each, and a small
   side is simply one block.
2. A task turns its query block into inverted lists ``pos -> [(query, w)]`` (sparse) or a matrix
   (dense) and walks the candidates in pieces, long vectors first. A piece can give a query at
   most the sum of |w| times the largest |value| of each position (dense: the product of the
   norms, by Cauchy-Schwarz); queries whose k-th best score so far is above that bound skip it.
   Scores of the others are vectorised NumPy, and only the ``k`` best rows per query leave the
   task, under the total order (score desc, category, id). No (query, document) pair is ever a
   Spark row.
3. The global top-k is a ``row_number() <= k`` window over at most ``k`` rows per query and
   candidate block, then votes per (query, category) are counted and ranked (votes desc,
   category).

Scores are rounded to ``digits`` decimals *before* ranking so that engines with different
summation orders pick the same rows. A query with no dictionary word gets no result (the
surveyed job raises instead); candidates without a category cannot vote and take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCORE_DIGITS = 9
BLOCK_CELLS = 1 << 18
# sizes of the NumPy work arrays inside one task
_MAX_EXPANDED = 1_000_000
_MAX_SCORE_CELLS = 1_000_000

_NEAR = "query_id long, id long, category string, score double"


def long_to_arrays(long_df: DataFrame, id_col: str, pos: str = "pos", val: str = "w") -> DataFrame:
    """``(id, pos, w)`` cells -> one row ``(id, idx[], val[])`` per id (bounded by vocabulary)."""
    cells = F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(val).alias("v"))))
    return long_df.groupBy(id_col).agg(cells.alias("cells")).select(
        F.col(id_col), F.col("cells.p").alias("idx"), F.col("cells.v").alias("val")
    )


class _Lists:
    """Sparse vectors of one block as flat cells (row, position, value)."""

    def __init__(self, table: pa.Table):
        idx = table.column("idx").combine_chunks()
        self.length = np.asarray(idx.value_lengths().fill_null(0)).astype(np.int64)
        self.start = np.append(0, np.cumsum(self.length))
        self.pos = np.asarray(idx.flatten()).astype(np.int64)
        self.val = np.asarray(table.column("val").combine_chunks().flatten()).astype(np.float64)

    def norms(self) -> np.ndarray:
        rows = np.repeat(np.arange(len(self.length)), self.length)
        return np.sqrt(np.bincount(rows, weights=self.val * self.val, minlength=len(self.length)).astype(np.float64))

    def cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``rows``, position, value) of the cells of some rows."""
        n = self.length[rows]
        at = np.arange(n.sum()) + np.repeat(self.start[rows] - (np.cumsum(n) - n), n)
        return np.repeat(np.arange(len(rows)), n), self.pos[at], self.val[at]


class SparseQueries:
    """A block of sparse queries as inverted lists, and the scores of pieces of candidates."""

    def __init__(self, queries: pa.Table, candidates: pa.Table, cosine: bool):
        own, self.rows, self.cosine = _Lists(queries), _Lists(candidates), cosine
        self.count = len(own.length)
        self.norm, self.row_norm = own.norms(), self.rows.norms()
        query = np.repeat(np.arange(self.count), own.length)
        order = np.argsort(own.pos, kind="stable")
        order = order[own.val[order] != 0.0]  # zero weights add nothing to a dot product
        self.query, self.weight, self.pos = query[order], own.val[order], own.pos[order]
        top = max(self.pos.max(initial=-1), self.rows.pos.max(initial=-1)) + 2
        self.list_start = np.searchsorted(self.pos, np.arange(top + 1))

    def pieces(self):
        """Places of the candidates, longest vectors first, in pieces of bounded work."""
        order = np.argsort(-self.row_norm, kind="stable")
        # postings that a row meets, and its line of scores
        pos = np.append(self.list_start, self.list_start[-1])
        met = np.diff(pos)[self.rows.pos]
        work = np.add.reduceat(np.append(met, 0), self.rows.start[:-1]) * (self.rows.length > 0) if len(order) else met
        cost = np.maximum(work[order] / _MAX_EXPANDED, self.count / _MAX_SCORE_CELLS)
        cut = np.flatnonzero(np.diff(np.floor(np.cumsum(cost)))) + 1
        return np.split(order, cut)

    def bounds(self, rows: np.ndarray) -> np.ndarray:
        if self.cosine:
            return np.ones(self.count)
        _, pos, val = self.rows.cells(rows)
        most = np.zeros(len(self.list_start))
        np.maximum.at(most, pos, np.abs(val))
        return np.bincount(self.query, weights=np.abs(self.weight) * most[self.pos], minlength=self.count)

    def scores(self, rows: np.ndarray, active: np.ndarray) -> np.ndarray:
        """``(len(rows), active queries)``."""
        place, pos, val = self.rows.cells(rows)
        keep, number = slice(None), np.arange(self.count)
        start = self.list_start
        if not active.all():  # the lists without the queries that sit this piece out
            keep, number = active[self.query], np.cumsum(active) - 1
            start = np.append(0, np.cumsum(keep))[self.list_start]
        query, weight, n = number[self.query[keep]], self.weight[keep], int(active.sum())
        first, count = start[pos], start[pos + 1] - start[pos]
        at = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
        out = np.bincount(np.repeat(place, count) * n + query[at], weights=np.repeat(val, count) * weight[at], minlength=len(rows) * n)
        out = out.astype(np.float64).reshape(len(rows), n)  # of no cells, bincount counts
        if self.cosine:
            size = np.outer(self.row_norm[rows], self.norm[active])
            out = np.divide(out, size, out=np.zeros_like(out), where=size > 0)
        return out


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("vector").combine_chunks()
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


class DenseQueries:
    """A block of dense queries as a matrix, and the scores of pieces of candidates."""

    def __init__(self, queries: pa.Table, candidates: pa.Table, cosine: bool):
        self.own, self.rows, self.cosine = _matrix(queries), _matrix(candidates), cosine
        self.count = len(self.own)
        self.norm, self.row_norm = (np.sqrt((m * m).sum(1)) for m in (self.own, self.rows))

    def pieces(self):
        order = np.argsort(-self.row_norm, kind="stable")
        return np.split(order, np.arange(0, len(order), max(1, _MAX_SCORE_CELLS // max(self.count, 1)))[1:])

    def bounds(self, rows: np.ndarray) -> np.ndarray:
        return np.ones(self.count) if self.cosine else self.norm * self.row_norm[rows].max(initial=0.0)

    def scores(self, rows: np.ndarray, active: np.ndarray) -> np.ndarray:
        out = self.rows[rows] @ self.own[active].T
        if self.cosine:
            size = np.outer(self.row_norm[rows], self.norm[active])
            out = np.divide(out, size, out=np.zeros_like(out), where=size > 0)
        return out


def _piece_top(s: np.ndarray, cats: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact top-k rows of every query column of one piece, all queries at once.

    Rows strictly above the k-th largest score are kept; rows tied with it are kept in
    (category, id) order until k rows are reached. Returns (row, query) index pairs.
    """
    n, nq = s.shape
    if n <= k:
        return np.nonzero(np.ones((n, nq), dtype=bool))
    thr = np.partition(s, n - k, axis=0)[n - k]
    keep = s > thr
    need = k - keep.sum(axis=0)
    order = np.lexsort((ids, cats))
    tied = s[order] == thr
    keep[order] |= tied & (np.cumsum(tied, axis=0) <= need[None, :])
    return np.nonzero(keep)


def _best(found: list[np.ndarray], k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The k best (score desc, category, id) of each query, and each row's rank among them."""
    query, score, cats, ids = found
    order = np.lexsort((ids, cats, -score, query))
    query = query[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    order = order[rank < k]
    return [a[order] for a in found], rank[rank < k]


def _meet(kind, k: int, cosine: bool, digits: int):
    """Cogroup function of a block of candidates and a block of queries."""

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        cats = np.array(candidates.column("category").to_pylist(), dtype=str)
        ids = candidates.column("id").to_numpy()
        found = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, dtype=cats.dtype if len(cats) else "U1"), np.zeros(0, np.int64)]
        if len(ids) and queries.num_rows:
            block = kind(queries, candidates, cosine)
            least = np.full(block.count, -np.inf)  # a query's k-th best score so far
            for rows in block.pieces():
                # equal scores may still win by category and id; rounding may lift a score
                active = np.round(block.bounds(rows) * (1 + 1e-12), digits) + 10.0**-digits >= least
                if not active.any():
                    continue
                s = np.round(block.scores(rows, active), digits)
                r, q = _piece_top(s, cats[rows], ids[rows], k)
                some = [np.flatnonzero(active)[q], s[r, q], cats[rows][r], ids[rows][r]]
                found, rank = _best([np.concatenate(x) for x in zip(found, some)], k)
                full = rank == k - 1
                least[found[0][full]] = found[1][full]
        return pa.table({
            "query_id": queries.column("query_id").to_numpy()[found[0]].astype(np.int64), "id": found[3].astype(np.int64),
            "category": pa.array(found[2].tolist(), pa.string()), "score": found[1]})

    return run


def _blocked(rows: DataFrame, cells: str, block_cells: int) -> tuple[DataFrame, int]:
    """``rows`` written once, and the number of blocks of about ``block_cells`` cells in them. They
    are counted on the written table: an ``Observation`` would leave the session with a manager
    that cannot be serialized, and ``pyspark.ml`` models with a training summary refer to it."""
    from sparkloom.session import materialize

    written = materialize(rows)
    n = written.agg(F.coalesce(F.sum(F.size(cells)), F.lit(0)).alias("cells")).first()["cells"]
    return written, max(1, -(-n // block_cells))


def _top_k(kind, candidates: DataFrame, queries: DataFrame, cells: str, k: int, metric: str, digits: int, block_cells: int) -> DataFrame:
    if metric not in ("dot", "cosine"):
        raise ValueError("metric must be 'dot' or 'cosine'")
    candidates, n_rows = _blocked(candidates.filter(F.col("category").isNotNull()), cells, block_cells)
    queries, n_queries = _blocked(queries, cells, block_cells)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = candidates.withColumn("row_block", F.pmod(F.xxhash64("id", "category"), F.lit(n_rows)).cast("int")).withColumn("query_block", every(n_queries))
    right = queries.withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(n_queries)).cast("int")).withColumn("row_block", every(n_rows))
    blocks = ["row_block", "query_block"]
    near = left.groupBy(*blocks).cogroup(right.groupBy(*blocks)).applyInArrow(_meet(kind, k, metric == "cosine", digits), _NEAR)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("category").asc(), F.col("id").asc())
    return near.withColumn("nn_rank", F.row_number().over(w).cast("long")).where(F.col("nn_rank") <= k)


def top_k_neighbours(
    candidates: DataFrame, query_cells: DataFrame, k: int = 10, metric: str = "dot",
    digits: int = SCORE_DIGITS, block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """``(query_id, id, category, score, nn_rank)``: the k best candidate rows per query.

    ``candidates``: ``id long, category string, idx array<int>, val array<double>``;
    ``query_cells``: ``query_id long, pos int, w double``.
    """
    rows = candidates.select(F.col("id").cast("long"), F.col("category").cast("string"), "idx", "val")
    queries = long_to_arrays(
        query_cells.select(F.col("query_id").cast("long"), F.col("pos").cast("int"), F.col("w").cast("double")), "query_id")
    return _top_k(SparseQueries, rows, queries, "idx", k, metric, digits, block_cells)


def top_k_dense(
    candidates: DataFrame, queries: DataFrame, k: int = 10, metric: str = "dot",
    digits: int = SCORE_DIGITS, block_values: int = 4 * BLOCK_CELLS,
) -> DataFrame:
    """:func:`top_k_neighbours` of dense vectors of one length: ``candidates`` are ``id, category,
    vector``, ``queries`` are ``query_id, vector``. NULL vectors take no part."""
    vector = F.col("vector").cast("array<double>").alias("vector")
    rows = candidates.filter("vector is not null").select(F.col("id").cast("long"), F.col("category").cast("string"), vector)
    queries = queries.filter("vector is not null").select(F.col("query_id").cast("long"), vector)
    return _top_k(DenseQueries, rows, queries, "vector", k, metric, digits, block_values)


def vote(neighbours: DataFrame) -> DataFrame:
    """A17 + T6: ``(query_id, category, votes, vote_rank)`` over the k neighbours."""
    votes = neighbours.groupBy("query_id", "category").agg(F.count(F.lit(1)).alias("votes"))
    w = Window.partitionBy("query_id").orderBy(F.col("votes").desc(), F.col("category").asc())
    return votes.withColumn("vote_rank", F.row_number().over(w).cast("long"))


def knn_text(
    model, docs: DataFrame, categories: DataFrame, queries: DataFrame, k: int = 10, metric: str = "dot",
    tokens=None, doc_id: str = "doc_id", query_id: str = "query_id", text: str = "text", vocab_k: int = 20000,
) -> DataFrame:
    """Classify each query text by the categories of its k nearest documents.

    ``model`` is a fitted ``TfIdfModel`` or None to fit one (dictionary of ``vocab_k``
    words, idf) on ``docs``; ``categories`` is ``(doc_id, category)``, 1:n.
    """
    from sparkloom.functions.text import tokens_letters

    tokens = tokens if tokens is not None else tokens_letters(text)
    if model is None:
        # tokenise the corpus once: the written bag of words feeds both the fit
        # (dictionary, idf) and the document vectors
        from sparkloom.operators.vocab import TfIdfModel, bag_of_words, n_docs_of
        from sparkloom.session import materialize

        bow = materialize(bag_of_words(docs, tokens, doc_id))
        model = TfIdfModel.fit_bow(bow, n_docs_of(docs), vocab_k, id_col=doc_id).materialized()
        dvec = model.transform_bow(bow, doc_id)
    else:
        dvec = model.transform(docs, tokens, doc_id)
    dvec = dvec.select(doc_id, "pos", F.col("tfidf").alias("w"))
    cand = long_to_arrays(dvec, doc_id).join(categories, doc_id).select(
        F.col(doc_id).alias("id"), "category", "idx", "val"
    )
    qvec = model.transform(queries, tokens, query_id).select(
        F.col(query_id).alias("query_id"), "pos", F.col("tfidf").alias("w")
    )
    return vote(top_k_neighbours(cand, qvec, k, metric))
