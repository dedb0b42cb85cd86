"""Linear classifiers: logistic regression and (class-weighted) linear SVMs.

Two ways to fit, both distributed:

* ``pyspark.ml`` estimators (L-BFGS / OWL-QN with ``treeAggregate``) where the objective is
  the same: M14 <-> ``LogisticRegression(regParam=2*lambda/n, elasticNetParam=0,
  fitIntercept=False, standardization=False)``, M15 L-BFGS, M16 <-> ``LinearSVC(regParam=
  1/(n*lambda))``, M17 <-> ``LinearSVC(weightCol=...)``. See :func:`ml_logistic`,
  :func:`ml_svm`.
* exact batch gradient descent with the bold-driver step and the surveyed stop rules
  (:func:`fit_gd`). One aggregation per iteration: for a handful of features the partial
  sums are JVM expressions (``Columns`` backend); for sparse text features a ``mapInArrow``
  kernel sums each task's rows into one vector, and the vectors are merged in groups
  (``Sparse`` backend). Only the weight vector (bounded by the dictionary size) travels to
  the tasks, as a broadcast.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sparkloom.operators.vocab import _pieces, bags


@dataclass
class GDConfig:
    loss: str = "logistic"  # logistic | hinge | weighted_hinge
    lr: float = 0.1
    iterations: int = 100
    reg: float = 1e-5  # lambda: L2 weight (logistic) or the SVM's lambda
    tol: float = 0.1
    grow_on_equal: bool = False  # logistic job grows the step on cost <= old cost
    class_weights: tuple[float, float] | None = None  # (NR, PR) for weighted_hinge
    extra: dict = field(default_factory=dict)


# ------------------------------------------------------------------ per-row expressions
def dot_columns(w: list[float], xs: list[Column]) -> Column:
    acc = xs[0] * F.lit(float(w[0]))
    for i in range(1, len(xs)):
        acc = acc + xs[i] * F.lit(float(w[i]))
    return acc


def softplus(z: Column) -> Column:
    """ln(1 + e^z) without overflow: max(z, 0) + ln(1 + e^-|z|)."""
    return F.greatest(z, F.lit(0.0)) + F.log(F.lit(1.0) + F.exp(-F.abs(z)))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def row_terms(cfg: GDConfig, w: list[float], xs: list[Column], y: Column, z: Column | None = None) -> tuple[Column, list[Column]]:
    """(loss term, gradient terms) of one row for the current weights; ``z`` is their score."""
    z = dot_columns(w, xs) if z is None else z
    if cfg.loss == "logistic":
        s = sigmoid(z) - y
        return softplus(z) - y * z, [x * s for x in xs]
    margin = F.lit(1.0) - y * z
    active = margin >= F.lit(0.0)
    if cfg.loss == "hinge":
        return F.greatest(F.lit(0.0), margin), [F.when(active, -y * x).otherwise(F.lit(0.0)) for x in xs]
    if cfg.loss == "weighted_hinge":
        positive, negative = (F.lit(float(v)) for v in cfg.class_weights)
        weight = F.when(y > 0, positive).otherwise(negative)
        step = F.when(active, -weight * y).otherwise(F.lit(0.0))
        return weight * F.greatest(F.lit(0.0), margin), [step * x for x in xs]
    raise ValueError(cfg.loss)


# ------------------------------------------------------------------ backends
class Columns:
    """Dense, few features given as Columns: one JVM aggregation per iteration."""

    def __init__(self, data: DataFrame, features: list[Column], label: Column, checkpoint: bool = False):
        from sparkloom.session import materialize

        self.data = data.select(*[f.cast("double").alias(f"x{i}") for i, f in enumerate(features)],
                                label.cast("double").alias("y"))
        if checkpoint:
            self.data = materialize(self.data)
        self.d = len(features)

    def count(self) -> int:
        return self.data.count()

    def sums(self, cfg: GDConfig, w: list[float]) -> tuple[float, list[float]]:
        xs = [F.col(f"x{i}") for i in range(self.d)]
        loss, grads = row_terms(cfg, w, xs, F.col("y"), F.col("z"))
        row = self.data.withColumn("z", dot_columns(w, xs)).agg(F.sum(loss).alias("loss"), *[F.sum(g).alias(f"g{i}") for i, g in enumerate(grads)]).first()
        return float(row["loss"] or 0.0), [float(row[f"g{i}"] or 0.0) for i in range(self.d)]


def loss_and_gradient(cfg: GDConfig, w: np.ndarray, y: np.ndarray, rows: np.ndarray, idx: np.ndarray, val: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed loss and gradient of some rows, given by their cells (row, position, value)."""
    z = np.bincount(rows, weights=val * w[idx], minlength=len(y))
    if cfg.loss == "logistic":
        loss = float(np.sum(np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z))) - y * z))
        step = 1.0 / (1.0 + np.exp(-z)) - y
    else:
        positive, negative = cfg.class_weights if cfg.loss == "weighted_hinge" else (1.0, 1.0)
        margin, weight = 1.0 - y * z, np.where(y > 0, positive, negative)
        loss = float(np.dot(weight, np.maximum(0.0, margin)))
        step = np.where(margin >= 0, -weight * y, 0.0)
    return loss, np.bincount(idx, weights=val * step[rows], minlength=len(w))


PIECE_CELLS = 1 << 18  # of one packed row
TASK_CELLS = 1 << 22  # beyond the session's parallelism, there are tasks of about so many cells
_PIECE = "n long, y binary, length binary, idx binary, val binary"


def _packed(batches):
    """Pieces of the rows ``idx, val, y`` as the bytes of flat arrays, one piece a row: a task of an
    iteration then gets its cells without a conversion of every value."""
    for batch in batches:
        size = np.cumsum(np.asarray(batch.column("idx").value_lengths().fill_null(0)).astype(np.int64))
        ends = [*(np.flatnonzero(np.diff(size // PIECE_CELLS)) + 1).tolist(), batch.num_rows]
        for start, end in zip([0, *ends], ends):
            part = batch.slice(start, end - start)
            idx = part.column("idx")
            arrays = [(np.asarray(part.column("y")), np.float64), (np.asarray(idx.value_lengths().fill_null(0)), np.int32),
                      (np.asarray(idx.flatten()), np.int32), (np.asarray(part.column("val").flatten()), np.float64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.num_rows], pa.int64()), *(pa.array([a.astype(kind).tobytes()], pa.binary()) for a, kind in arrays)],
                names=["n", "y", "length", "idx", "val"])


def _cells(batch: pa.RecordBatch):
    """(labels, row, position, value) of every piece of a batch."""
    for y, length, idx, val in zip(*(batch.column(c) for c in ("y", "length", "idx", "val"))):
        y, length = np.frombuffer(y.as_buffer(), np.float64), np.frombuffer(length.as_buffer(), np.int32)
        yield y, np.repeat(np.arange(len(y)), length), np.frombuffer(idx.as_buffer(), np.int32), np.frombuffer(val.as_buffer(), np.float64)


class Sparse:
    """Sparse features ``idx array<int>, val array<double>``. Each task sums its rows into one
    vector; the vectors of more than ``_FAN`` tasks meet in ``_FAN`` groups first, so the driver
    adds up at most ``_FAN`` of them. The number of tasks follows the cells and the cores, not the
    session's shuffle partitions: an iteration is short. NULL labels take no part."""

    _FAN = 32
    _PARTIAL = "part int, loss double, grad array<double>"

    def __init__(self, data: DataFrame, d: int, label: Column, idx: str = "idx", val: str = "val",
                 checkpoint: bool = True):
        from sparkloom.session import materialize

        rows = data.select(F.col(idx).alias("idx"), F.col(val).alias("val"), label.cast("double").alias("y")).filter("y is not null")
        if checkpoint:
            # read once an iteration: dealt evenly and packed, once
            rows = materialize(rows)
            cells = rows.agg(F.sum(F.size("idx").cast("long"))).first()[0] or 0
            tasks = max(data.sparkSession.sparkContext.defaultParallelism, -(-cells // TASK_CELLS))
            self.data = materialize(rows.repartition(tasks).mapInArrow(_packed, _PIECE))
        else:
            self.data = rows.mapInArrow(_packed, _PIECE)
        self.tasks = self.data.select(F.spark_partition_id().alias("p")).distinct().count()
        self.d = d

    def count(self) -> int:
        return self.data.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def sums(self, cfg: GDConfig, w) -> tuple[float, np.ndarray]:
        shared = self.data.sparkSession.sparkContext.broadcast(np.asarray(w, dtype=np.float64))
        d, fan, names = self.d, self._FAN, ["part", "loss", "grad"]

        def vector(part, loss, grad):
            return [pa.array([part], pa.int32()), pa.array([loss], pa.float64()),
                    pa.ListArray.from_arrays(pa.array([0, d], pa.int32()), pa.array(grad, pa.float64()))]

        def partial(batches):
            loss, grad = 0.0, np.zeros(d)
            for batch in batches:
                for cells in _cells(batch):
                    more, g = loss_and_gradient(cfg, shared.value, *cells)
                    loss, grad = loss + more, grad + g
            yield pa.RecordBatch.from_arrays(vector(TaskContext.get().partitionId() % fan, loss, grad), names=names)

        def merge(table):
            grad = np.asarray(table.column("grad").combine_chunks().flatten()).reshape(-1, d).sum(0)
            return pa.Table.from_arrays(vector(0, table.column("loss").to_numpy().sum(), grad), names=names)

        partials = self.data.mapInArrow(partial, self._PARTIAL)
        if self.tasks > fan:
            partials = partials.groupBy("part").applyInArrow(merge, self._PARTIAL)
        merged = merge(partials.toArrow())
        shared.destroy()
        return float(merged.column("loss")[0].as_py()), merged.column("grad").combine_chunks().flatten().to_numpy()


# ------------------------------------------------------------------ driver loop
def _norm(v: np.ndarray) -> float:
    return math.sqrt(float(np.dot(v, v)))


def fit_gd(backend, w0: list[float], cfg: GDConfig, n: int | None = None) -> list[tuple]:
    """Exact batch GD; returns the trace ``(iteration, cost, w..., lr)``.

    logistic (M14): cost = sum(ln(1+e^z) - y z) + lambda |w|^2, step on
      sum(x (sigma(z) - y)) + 2 lambda w; stop when | |w_old| - |w_new| | <= tol.
    hinge (M16): cost = |w|^2 / (2 n lambda) + mean hinge, step on w / (n lambda) + mean
      subgradient; stop when | |w_old| - sqrt(|w_old . w_new|) | <= tol.
    weighted_hinge (M17): cost = sum of class-weighted hinge, step on the summed
      subgradient, same stop rule as hinge.
    """
    w = np.array(w0, dtype=np.float64)
    lr = cfg.lr
    old = 0.0
    if cfg.loss == "hinge" and n is None:
        n = backend.count()
    trace = []
    for it in range(1, cfg.iterations + 1):
        loss, g = backend.sums(cfg, w)
        g = np.asarray(g, dtype=np.float64)
        if cfg.loss == "logistic":
            cost = loss + cfg.reg * float(np.dot(w, w))
            new = w - lr * (g + 2.0 * cfg.reg * w)
            stop = abs(_norm(w) - _norm(new)) <= cfg.tol
        else:
            if cfg.loss == "hinge":
                cost = (1.0 / (2.0 * (n * cfg.reg))) * float(np.dot(w, w)) + loss / n
                new = w - lr * ((1.0 / (n * cfg.reg)) * w + g / n)
            else:
                cost = loss
                new = w - lr * g
            stop = abs(_norm(w) - math.sqrt(abs(float(np.dot(w, new))))) <= cfg.tol
        w = new
        if stop:
            trace.append((it, cost, *w.tolist(), lr))
            break
        if cost < old or (cfg.grow_on_equal and cost == old):
            lr, old = lr * 1.05, cost
        elif cost > old:
            lr, old = lr * 0.5, cost
        trace.append((it, cost, *w.tolist(), lr))
    return trace


def class_ratios(labelled: DataFrame, label: Column) -> tuple[float, float]:
    """(NR, PR) = shares of negative and positive rows, in one aggregation."""
    row = labelled.agg(F.avg((label <= 0).cast("double")).alias("nr"),
                       F.avg((label > 0).cast("double")).alias("pr")).first()
    return float(row["nr"]), float(row["pr"])


def predict(scored_z: Column, rule: str = "ge0", positive=1, negative=0) -> Column:
    """M18 decision rules on the margin z: 'ge0' (z >= 0), 'gt0' (z > 0)."""
    cond = scored_z >= 0 if rule == "ge0" else scored_z > 0
    return F.when(cond, F.lit(positive)).otherwise(F.lit(negative))


# ------------------------------------------------------------------ pyspark.ml forms
TASK_ROWS = 1 << 14  # beyond the session's parallelism, there are tasks of about so many rows


def _fit(estimator_of, train: DataFrame):
    """Fit on the training rows, written once and dealt over as many tasks as cores (more beyond
    ``TASK_ROWS`` rows each): an iteration is short. They are not cached, since the estimator
    caches its own blocks of them. ``estimator_of(n)`` gets the number of rows.

    The model is written to the checkpoint folder and read back: as fitted it refers to its
    training summary and so to the session, which tasks cannot be sent once anything in the
    session has used an ``Observation``."""
    from sparkloom.session import materialize, scratch_table_path

    rows = materialize(train)
    n = rows.count()
    tasks = max(train.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
    model = estimator_of(n).fit(rows.repartition(tasks))
    path = scratch_table_path(train.sparkSession, uuid.uuid4().hex)
    model.write().save(path)
    return type(model).load(path)


def ml_logistic(train: DataFrame, max_iter: int = 200, reg_param: float = 0.0, features: str = "features",
                label: str = "label"):
    """M13/M15 (and M14 with ``reg_param = 2 lambda / n``): no intercept, no standardisation."""
    from pyspark.ml.classification import LogisticRegression

    return _fit(lambda n: LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg_param,
                                             elasticNetParam=0.0, fitIntercept=False, standardization=False), train)


def ml_svm(train: DataFrame, reg_param: float | None = None, max_iter: int = 300, weight_col: str | None = None,
           features: str = "features", label: str = "label", lam: float | None = None):
    """M16 (``reg_param = 1 / (n lambda)``; pass ``lam`` to have n counted on the cached input)
    and M17 (``weight_col`` with NR / PR weights)."""
    from pyspark.ml.classification import LinearSVC

    kw = {"weightCol": weight_col} if weight_col else {}

    def estimator(n: int):
        reg = reg_param if lam is None else 1.0 / (max(n, 1) * lam)
        return LinearSVC(featuresCol=features, labelCol=label, regParam=reg, maxIter=max_iter,
                         fitIntercept=False, standardization=False, **kw)

    return _fit(estimator, train)


# ------------------------------------------------------------------ text features for pyspark.ml
_INDICES = pa.list_(pa.field("element", pa.int32(), nullable=False))
_VALUES = pa.list_(pa.field("element", pa.float64(), nullable=False))
_SPARSE = [pa.field("type", pa.int8(), nullable=False), pa.field("size", pa.int32()),
           pa.field("indices", _INDICES), pa.field("values", _VALUES)]  # of an ``ml`` vector


class TextVectorizer:
    """TF (count / in-dictionary tokens) or TF-IDF ``ml`` vectors for a fixed dictionary.

    ``vocab_words`` is the fitted dictionary in position order (bounded by its size k). The
    words of a document are counted once (:func:`sparkloom.operators.vocab.bags`) and found in
    the dictionary once per document and distinct word, in Arrow batches;
    ``ElementwiseProduct`` applies the idf weights. A document without words, or without a
    text, has the empty vector.
    """

    def __init__(self, vocab_words: list[str], idf: list[float] | None = None, out: str = "features"):
        from pyspark.ml.feature import ElementwiseProduct
        from pyspark.ml.linalg import Vectors

        self.out = out
        self.words = vocab_words
        self.idf = None if idf is None else ElementwiseProduct(
            scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol=out)

    def transform(self, docs: DataFrame, tokens: Column) -> DataFrame:
        return self.transform_bags(bags(docs, tokens, docs.columns))

    def transform_bags(self, counted: DataFrame) -> DataFrame:
        """Rows of :func:`bags`, the vector in place of their words and counts."""
        from pyspark.ml.linalg import VectorUDT

        kept, known = [c for c in counted.columns if c not in ("words", "counts")], self.words
        name = self.out if self.idf is None else "_tf"
        rows = counted.select(F.struct(*kept).alias("row"), "words", "counts")

        def vectors(batches):
            dictionary = pa.array(known, pa.string())
            for batch in _pieces(batches):
                words, counts = batch.column(1), batch.column(2)
                owner = np.repeat(np.arange(batch.num_rows), np.asarray(words.value_lengths()))
                pos = pc.index_in(words.flatten().cast(pa.string()), value_set=dictionary)
                found = np.asarray(pos.is_valid())
                owner, pos, n = owner[found], np.asarray(pos.drop_null()), np.asarray(counts.flatten())[found]
                order = np.lexsort((pos, owner))
                owner, pos, n = owner[order], pos[order], n[order]
                tf = n / np.bincount(owner, weights=n, minlength=batch.num_rows)[owner]
                ends = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)), pa.int32())
                vector = pa.StructArray.from_arrays(
                    [pa.array(np.zeros(batch.num_rows), pa.int8()), pa.array(np.full(batch.num_rows, len(known)), pa.int32()),
                     pa.ListArray.from_arrays(ends, pa.array(pos, pa.int32()), type=_INDICES),
                     pa.ListArray.from_arrays(ends, pa.array(tf, pa.float64()), type=_VALUES)], fields=_SPARSE)
                yield pa.RecordBatch.from_arrays([*batch.column(0).flatten(), vector], names=[*kept, name])

        tf = rows.mapInArrow(vectors, StructType([*(counted.schema[c] for c in kept), StructField(name, VectorUDT())]))
        return tf if self.idf is None else self.idf.transform(tf).drop("_tf")


def text_vectors(docs: DataFrame, tokens: Column, vocab_words: list[str], idf: list[float] | None = None,
                 out: str = "features") -> DataFrame:
    """One-off form of :class:`TextVectorizer`."""
    return TextVectorizer(vocab_words, idf, out).transform(docs, tokens)
