"""Quality classifier: a byte-level convolutional network in numpy.

A text is the sequence of its UTF-8 bytes, whatever its length. Learned filters of ``WIDTH``
bytes respond at every position; responses are max-pooled inside overlapping chunks (``CHUNK``
positions, one every half chunk) that cover the whole text. The mean and the maximum over the
chunks, per filter, go through one logistic unit.

Scoring is one pass of Arrow batches; filters over byte pairs are tabulated, so a position
costs WIDTH / 2 table rows. Training runs on a bounded sample: at most ``SAMPLE_ROWS`` labelled
documents (those with the smallest id hashes) and ``SAMPLE_CHUNKS`` chunks spread over each
of them, cut on the executors. The seed fixes the rest, so reruns agree.

Empty and edge input: NULL and empty texts have no chunks and score what the bias says; an
id with several labels has their majority (ties are 1); with no labels, or one class only,
the score is the rate of ones (0.5 without labels); repeated rows are each scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import kernel
from sparkloom.llm.tables import extended

WIDTH, FILTERS, CHUNK = 6, 16, 512
SAMPLE_ROWS, SAMPLE_CHUNKS = 2500, 12
EPOCHS, BATCH, RATE, DECAY = 10, 50, 0.02, 1e-4
_PIECE = 1 << 17


def held_out(id_column) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.params = {
            "w": (rng.normal(size=(WIDTH, 256, FILTERS)) * 0.1).astype(np.float32),
            "b": np.zeros(FILTERS, np.float32),
            "v": (rng.normal(size=2 * FILTERS) * 0.1).astype(np.float32),
            "c": np.zeros(1, np.float32),
        }
        self.constant: float | None = None

    def tables(self) -> list[np.ndarray]:
        """Response of each pair of filter taps to every pair of bytes."""
        w = self.params["w"]
        return [(w[k][:, None, :] + w[k + 1][None, :, :]).reshape(65536, FILTERS) for k in range(0, WIDTH, 2)]

    def score(self, mean: np.ndarray, most: np.ndarray) -> np.ndarray:
        z = np.concatenate([mean, most], 1) @ self.params["v"] + self.params["c"][0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _responses(data: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Filter responses at every position of ``data`` that has WIDTH bytes."""
    n = len(data) - WIDTH + 1
    pair = data[:-1].astype(np.int32) * 256 + data[1:]
    out = tables[0][pair[:n]]
    for k, table in enumerate(tables[1:], 1):
        out += table[pair[2 * k : 2 * k + n]]
    return out


def _half_chunk_maxima(text: np.ndarray, tables) -> np.ndarray:
    """Maxima over successive half chunks; a text ends in WIDTH - 1 zero bytes."""
    half, parts = CHUNK // 2, []
    for lo in range(0, len(text), _PIECE):
        piece = np.zeros(min(_PIECE, len(text) - lo) + WIDTH - 1, np.uint8)
        own = text[lo : lo + len(piece)]
        piece[: len(own)] = own
        r = _responses(piece, tables)
        parts.append(np.maximum.reduceat(r, np.arange(0, len(r), half), axis=0))
    return np.concatenate(parts) if parts else np.zeros((0, FILTERS), np.float32)


def features(column: pa.Array, net: Network, tables) -> tuple[np.ndarray, np.ndarray]:
    """(mean, max) over the chunks of each text of a column, after bias and ReLU."""
    bias, mean, most = net.params["b"], [], []
    for lo, hi, data, offsets in kernel.chunks(column):
        for i in range(hi - lo):
            halves = _half_chunk_maxima(data[offsets[i] : offsets[i + 1]], tables)
            chunks = np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves
            act = np.maximum(chunks + bias, 0)
            mean.append(act.mean(0) if len(act) else np.zeros(FILTERS, np.float32))
            most.append(act.max(0) if len(act) else np.zeros(FILTERS, np.float32))
    empty = np.zeros((0, FILTERS), np.float32)
    return (np.stack(mean), np.stack(most)) if mean else (empty, empty)


def training_sample(docs: DataFrame, labels: DataFrame, id_col, text_col, label_col, rows: int, chunks: int):
    """Pandas rows (key, label, chunk) of the bounded sample."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("int").alias("__label"))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(rows)  # at most ``rows`` rows
    picked = docs.select(id_col, F.col(text_col).alias("__text")).join(F.broadcast(chosen), id_col).select(
        F.xxhash64(id_col).alias("key"), F.col("__label").alias("label"), "__text")
    span = CHUNK + WIDTH - 1

    def cut(batches):
        for batch in batches:
            keys, marks, pieces = [], [], []
            for lo, hi, data, offsets in kernel.chunks(batch.column(2)):
                for i in range(hi - lo):
                    text = data[offsets[i] : offsets[i + 1]]
                    starts = np.arange(0, max(len(text) - CHUNK // 2, 1), CHUNK // 2)
                    if len(starts) > chunks:
                        starts = starts[np.linspace(0, len(starts) - 1, chunks).astype(int)]
                    for s in starts:
                        keys.append(batch.column(0)[lo + i].as_py())
                        marks.append(batch.column(1)[lo + i].as_py())
                        pieces.append(text[s : s + span].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(marks, pa.int32()), pa.array(pieces, pa.binary())],
                names=["key", "label", "chunk"])

    return picked.mapInArrow(cut, "key long, label int, chunk binary").toPandas()


def train(sample, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the logistic loss of whole documents; the gradient of a max-pooled filter
    reaches only the bytes at its best position."""
    net = Network(seed)
    sample = sample.sort_values(["key", "chunk"], kind="stable")
    docs, owner = np.unique(sample["key"].to_numpy(), return_inverse=True)
    label = np.zeros(len(docs), np.float32)
    label[owner] = sample["label"].to_numpy()
    if len(docs) == 0 or label.min() == label.max():
        net.constant = float(label.mean()) if len(docs) else 0.5
        return net
    span = CHUNK + WIDTH - 1
    x = np.zeros((len(sample), span + 1), np.uint8)
    size = np.zeros(len(sample), np.int64)
    for i, piece in enumerate(sample["chunk"]):
        x[i, : len(piece)] = np.frombuffer(piece, np.uint8)
        size[i] = min(len(piece), CHUNK)
    first = np.searchsorted(owner, np.arange(len(docs) + 1))
    p, rng = net.params, np.random.default_rng(seed)
    moments = {k: [np.zeros_like(a), np.zeros_like(a)] for k, a in p.items()}
    position, step = np.arange(CHUNK), 0
    for _ in range(epochs):
        for group in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // BATCH)):
            rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in group])
            count = np.diff(first)[group]
            start = np.append(0, np.cumsum(count))[:-1]
            own = np.repeat(np.arange(len(group)), count)
            tables, xs = net.tables(), x[rows]
            pair = xs[:, :-1].astype(np.int32) * 256 + xs[:, 1:]
            r = tables[0][pair[:, :CHUNK]]
            for k in range(1, WIDTH // 2):
                r += tables[k][pair[:, 2 * k : 2 * k + CHUNK]]
            r[position[None, :] >= size[rows][:, None]] = -1e9
            best = r.argmax(1)
            act = np.take_along_axis(r, best[:, None, :], 1)[:, 0] + p["b"]
            act = np.where(size[rows][:, None] > 0, np.maximum(act, 0), 0)
            mean = np.add.reduceat(act, start, axis=0) / count[:, None]
            most = np.maximum.reduceat(act, start, axis=0)
            error = (net.score(mean, most) - label[group]) / len(group)
            v = p["v"]
            grad = {
                "v": np.concatenate([mean, most], 1).T @ error + DECAY * v,
                "c": np.array([error.sum()]),
            }
            top = act == most[own]
            share = top / np.maximum(np.add.reduceat(top, start, axis=0), 1)[own]
            g = error[own][:, None] * (v[:FILTERS] / count[own][:, None] + v[FILTERS:] * share) * (act > 0)
            grad["b"] = g.sum(0)
            flat = np.zeros(WIDTH * 256 * FILTERS)
            for k in range(WIDTH):
                byte = np.take_along_axis(xs, best + k, 1).astype(np.int64)
                at = (k * 256 + byte) * FILTERS + np.arange(FILTERS)
                flat += np.bincount(at.ravel(), weights=g.ravel(), minlength=len(flat))
            grad["w"] = flat.reshape(p["w"].shape) + DECAY * p["w"]
            step += 1
            for k, a in p.items():
                m, s = moments[k]
                m += 0.1 * (grad[k] - m)
                s += 0.01 * (grad[k] ** 2 - s)
                a -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality",
        rows: int = SAMPLE_ROWS, chunks: int = SAMPLE_CHUNKS) -> Network:
    return train(training_sample(docs, labels, id_col, text_col, label_col, rows, chunks))


def score(docs: DataFrame, net: Network, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with a last column: the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # 100 KB, whatever the data
    at = docs.columns.index(text_col)

    def run(batches):
        net, tables = shared.value, None
        for batch in batches:
            if net.constant is not None:
                values = np.full(batch.num_rows, net.constant)
            else:
                tables = tables or net.tables()
                values = net.score(*features(batch.column(at), net, tables)).astype(float)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], names=[*batch.schema.names, out_col])

    return docs.mapInArrow(run, extended(docs.schema, **{out_col: "double"}))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents with a score of at least 0.5, in their own columns."""
    net = fit(docs, labels, **options)
    text_col = options.get("text_col", "text")
    return score(docs, net, text_col, "__score").filter("__score >= 0.5").select(*docs.columns)
