"""Language identification by rank-order profiles.

A language's profile lists its ``PROFILE`` most frequent character n-grams (1 to 3 letters,
word edges count as a symbol). A document is ranked the same way and compared with every
profile by out-of-place distance: the sum over its n-grams of how far the ranks are apart, or
the profile's length for an n-gram that the profile lacks. The nearest profile wins (ties by
name); the score is 1 minus the distance over its maximum.

Profiles are learned from at most about ``SAMPLE_ROWS`` documents of each language, picked by
id hash at a rate that follows from the language's count; whole texts are read. All other
texts are scored whole in one pass of Arrow batches.

Empty and edge input: NULL texts and texts without a letter are ``und`` with score 0, and so
is everything if no language was learned; equal counts rank by n-gram; repeated rows are each
answered, and NULL languages teach nothing.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparkloom.llm import kernel
from sparkloom.llm.quality_cnn import held_out
from sparkloom.llm.tables import extended

PROFILE, SAMPLE_ROWS = 300, 4000
_ROWS = 1 << 14  # texts of a chunk, so that 14 bits number them
_U = np.uint64


@cache
def _letters() -> np.ndarray:
    """Code point to lower-case letter (16 bits); 0 for everything that is no letter."""
    table = np.zeros(0x110000, np.uint16)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            low = ord(low) if len(low) == 1 else cp
            table[cp] = low if low < 0xE000 or 0xF900 <= low < 0x10000 else 0xE000 + low % 0x1900
    return table


def _chunk_grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """uint64 per n-gram occurrence: text number (14 bits), length (2), three letters (48)."""
    letters = _letters()[np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
    chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]
    before, after = np.zeros_like(letters), np.zeros_like(letters)
    before[1:], after[:-1] = letters[:-1], letters[1:]
    full = np.flatnonzero(np.diff(chars))
    before[chars[:-1][full]] = 0
    after[chars[1:][full] - 1] = 0
    at = np.flatnonzero(letters)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(chars))[at] << _U(50)
    b, c, a = before[at].astype(np.uint64), letters[at].astype(np.uint64), after[at].astype(np.uint64)
    last = a == 0
    return np.concatenate([
        text | _U(1 << 48) | c,
        text | _U(2 << 48) | (b << _U(16)) | c,
        (text | _U(2 << 48) | (c << _U(16)))[last],
        text | _U(3 << 48) | (b << _U(32)) | (c << _U(16)) | a,
    ])


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    return keys[first], np.diff(np.append(first, len(keys)))


_GRAM = _U((1 << 50) - 1)


def learn(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", rows: int = SAMPLE_ROWS, size: int = PROFILE):
    """{language: n-gram codes in rank order} from documents that are not held out."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    # one row a language, far less than the profiles that every task gets anyway, so it goes to
    # the texts; a join by language would gather a language's texts in one task
    rates = known.groupBy(lang_col).agg(F.greatest(F.ceil(F.count("*") / rows), F.lit(1)).alias("__every"))
    picked = known.select(F.col(lang_col), F.col(text_col), F.xxhash64(id_col).alias("__h")).join(F.broadcast(rates), lang_col)
    picked = picked.filter(F.pmod("__h", "__every") == 0).select(lang_col, text_col)

    def count(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in sorted(set(langs.tolist())):
                own = batch.column(1).filter(pa.array(langs == lang))
                parts = [_chunk_grams(d, o) & _GRAM for _, _, d, o in kernel.chunks(own, rows=_ROWS)]
                gram, n = _counted(np.concatenate(parts) if parts else np.zeros(0, np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    counts = picked.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("rank", rank).filter(F.col("rank") <= size).toPandas()  # size rows a language
    return {lang: part.sort_values("rank")["gram"].to_numpy(np.int64).view(np.uint64) for lang, part in best.groupby("lang")}


class Profiles:
    """All profiles as one table: known n-grams by rows, languages by columns."""

    def __init__(self, learned: dict[str, np.ndarray], size: int = PROFILE):
        self.names, self.size = sorted(learned), size
        self.grams = np.unique(np.concatenate(list(learned.values()))) if learned else np.zeros(0, np.uint64)
        # a missing n-gram has rank -1; the last row is an n-gram that no profile has
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int64)
        for j, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.grams, learned[name]), j] = np.arange(len(learned[name]))

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(offsets) - 1
        keys, count = _counted(_chunk_grams(data, offsets))
        if not self.names or not len(keys):
            return ["und"] * n, np.zeros(n)
        gram, text = keys & _GRAM, keys >> _U(50)
        known = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        known = np.where(self.grams[known] == gram, known, len(self.grams)).astype(np.uint64)
        # rank by falling count in one sort; unknown n-grams come last among equals
        most = _U((1 << 26) - 1)
        order = np.sort((text << _U(50)) | ((most - np.minimum(count.astype(np.uint64), most)) << _U(24)) | known)
        text = (order >> _U(50)).astype(np.int64)
        rank = np.arange(len(order)) - np.searchsorted(text, np.arange(n))[text]
        near = rank < self.size
        text, rank, row = text[near], rank[near], (order[near] & _U((1 << 24) - 1)).astype(np.int64)
        used = np.bincount(text, minlength=n)
        away = np.zeros((n, len(self.names)))
        for j in range(len(self.names)):
            other = self.ranks[row, j]
            apart = np.where(other < 0, self.size, np.abs(rank - other))
            away[:, j] = np.bincount(text, weights=apart, minlength=n)
        best = away.argmin(1)
        score = np.where(used > 0, 1 - away[np.arange(n), best] / np.maximum(used * self.size, 1), 0.0)
        return [self.names[j] if u else "und" for j, u in zip(best, used)], score


def identify(docs: DataFrame, profiles: Profiles, text_col="text", lang_out="lang_pred", score_out="score") -> DataFrame:
    """``docs`` with two last columns, the language and its score."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # ``size`` n-grams a language
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            names, scores = [], []
            for _, _, data, offsets in kernel.chunks(batch.column(at), rows=_ROWS):
                some, values = shared.value.predict(data, offsets)
                names += some
                scores.append(values)
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores)], names=[*batch.schema.names, lang_out, score_out])

    return docs.mapInArrow(run, extended(docs.schema, **{lang_out: "string", score_out: "double"}))
