"""Benchmark decontamination by a prefix-filtered set join.

Each benchmark item becomes its word windows (``window`` consecutive words; a shorter item
is one window). A window is the set of its word shingles, and for full containment the
necessary prefix of a set is its single rarest shingle, so:

1. the occurrences of every benchmark shingle are counted over all documents, which gives
   the rarity order (ties by hash);
2. a document position whose shingle is the rarest one of a window is a candidate; the
   shingle's offset in the window fixes where the window would begin (positional bound), and
   it must begin and end inside the document (length bound);
3. the candidate's words are compared, by hash and then byte by byte.

Documents are never shuffled: the windows go to them in blocks of at most ``block_bytes``
(measured; a benchmark beyond one block is passed over the documents block by block).

Empty and edge input: a NULL or empty text has no words and no hits, a NULL or empty item has
no windows, items with the same text all count, repeated document rows are each answered,
and an empty benchmark leaves every document clean. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import kernel
from sparkloom.session import materialize

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
BLOCK_BYTES = 64 << 20
WORD_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value, after lower-casing A-Z

_FILTER_BITS = 20


def ascii_lower(text):
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``window string`` (words joined by a space) and ``items array<string>`` holding it."""
    words = F.filter(F.split(ascii_lower(F.col(text_col)), WORD_SEPARATORS), lambda w: w != "")
    n = F.size("words")
    return (
        benchmark.select(F.col(item_col).cast("string").alias("item"), words.alias("words"))
        .filter(F.col("item").isNotNull() & (n > 0))
        .select("item", "words", F.explode(F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1)))).alias("at"))
        .select("item", F.array_join(F.slice("words", F.col("at"), window), " ").alias("window"))
        .groupBy("window")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


class Block:
    """One block of windows with their prefix shingles, as arrays that tasks can search."""

    def __init__(self, windows: list[str], items: list[list[str]], shingle: int):
        self.windows = [w.encode() for w in windows]
        self.items = items
        column = pa.array(windows, pa.large_string())
        data, offsets = kernel.text_bytes(column)
        words = kernel.Words(data, offsets, kernel.ALNUM_OR_HIGH)
        hashes = words.hashes()
        self.length = words.counts
        #: shingle size of each window: ``shingle`` words, or all of a shorter window
        size = np.minimum(self.length, shingle)
        self.full = np.zeros(len(windows), np.uint64)
        for n in np.unique(self.length):
            own = np.flatnonzero(self.length == n)
            self.full[own] = kernel.window_hash(hashes, words.bounds[own], int(n))
        parts = []
        for n in np.unique(size):
            at, key = words.windows(hashes, int(n))
            keep = size[words.text[at]] == n
            at, key = at[keep], key[keep]
            parts.append((np.full(len(at), n), key, words.text[at], at - words.bounds[words.text[at]]))
        self.size, self.key, self.owner, self.offset = (np.concatenate(x) for x in zip(*parts))
        self.keys = np.unique(self.key)
        self.index(np.ones(len(self.key), bool))

    def index(self, chosen: np.ndarray) -> None:
        """Search structures over the chosen shingles: sorted keys behind a bit filter."""
        self.search = {}
        for n in np.unique(self.size[chosen]):
            own = np.flatnonzero(chosen & (self.size == n))
            own = own[np.argsort(self.key[own], kind="stable")]
            keys, first = np.unique(self.key[own], return_index=True)
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[keys >> np.uint64(64 - _FILTER_BITS)] = True
            self.search[int(n)] = (keys, np.append(first, len(own)), own, bits)

    def keep_rarest(self, counts: dict[int, int]) -> None:
        """Leave each window its prefix: the shingle with the fewest occurrences."""
        seen = np.array([counts.get(int(k), 0) for k in self.keys], np.int64)[np.searchsorted(self.keys, self.key)]
        order = np.lexsort((self.offset, self.key, seen, self.owner))
        first = np.ones(len(order), bool)
        first[1:] = self.owner[order][1:] != self.owner[order][:-1]
        chosen = np.zeros(len(order), bool)
        chosen[order[first]] = True
        self.index(chosen)

    def matches(self, words: kernel.Words, hashes: np.ndarray):
        """Yield (shingle size, positions in the chunk's words, rows of the sorted keys)."""
        for n, (keys, first, own, bits) in self.search.items():
            at, key = words.windows(hashes, n)
            near = np.flatnonzero(bits[key >> np.uint64(64 - _FILTER_BITS)])
            at, key = at[near], key[near]
            row = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            same = keys[row] == key
            yield n, at[same], row[same]

    def hits(self, words: kernel.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence of a window in the chunk's texts."""
        found_at, found = [], []
        for n, at, row in self.matches(words, hashes):
            keys, first, own, _ = self.search[n]
            many = first[row + 1] - first[row]
            at = np.repeat(at, many)
            entry = own[np.repeat(first[row], many) + _ramp(many)]
            window = self.owner[entry]
            start = at - self.offset[entry]
            text = words.text[at] if len(at) else at
            fits = (start >= words.bounds[text]) & (start + self.length[window] <= words.bounds[text + 1])
            start, window = start[fits], window[fits]
            for length in np.unique(self.length[window]):
                own_length = self.length[window] == length
                s, w = start[own_length], window[own_length]
                same = kernel.window_hash(hashes, s, int(length)) == self.full[w]
                for i, j in zip(s[same].tolist(), w[same].tolist()):
                    if words.joined(i, int(length)) == self.windows[j]:
                        found_at.append(i)
                        found.append(j)
        return np.array(found_at, np.int64), np.array(found, np.int64)


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each c, one after the other."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def _words_of(data, offsets):
    words = kernel.Words(kernel.LOWER[data], offsets, kernel.ALNUM_OR_HIGH)
    return words, words.hashes()


def _blocks(windows: DataFrame, shingle: int, block_bytes: int) -> list[Block]:
    """Windows as blocks of bounded bytes, cut by hash; each is fetched on its own."""
    size = windows.select(F.sum(F.octet_length("window") + 24 * F.size("items") + 400)).first()[0]
    if not size:
        return []
    n = max(1, -(-int(size) * 2 // block_bytes)) if size > block_bytes else 1
    out = []
    for b in range(n):
        part = windows.filter(F.pmod(F.xxhash64("window"), F.lit(n)) == b).orderBy("window").toPandas()
        if len(part):
            out.append(Block(part["window"].tolist(), [list(x) for x in part["items"]], shingle))
    return out


def _shingle_counts(docs: DataFrame, block: Block, text_col: str) -> dict[int, int]:
    """Occurrences of the block's shingles over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches):
        block = shared.value
        total = np.zeros(len(block.keys), np.int64)
        for batch in batches:
            for _, _, data, offsets in kernel.chunks(batch.column(0)):
                words, hashes = _words_of(data, offsets)
                for n, _, row in block.matches(words, hashes):
                    keys = block.search[n][0]
                    total += np.bincount(np.searchsorted(block.keys, keys[row]), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.keys[some].view(np.int64)), pa.array(total[some])], names=["key", "n"]
        )

    rows = docs.select(text_col).mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return {k & 0xFFFFFFFFFFFFFFFF: n for k, n in rows.toPandas().itertuples(index=False)}


def annotate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW_WORDS,
    shingle: int = SHINGLE_WORDS,
    block_bytes: int = BLOCK_BYTES,
    prefix: str = "bench_",
) -> DataFrame:
    """``docs`` with three more columns: ``<prefix>words`` (number of words),
    ``<prefix>spans`` (maximal hit word ranges, ends exclusive) and ``<prefix>items`` (ids,
    as strings in order, of the items of which a window occurs)."""
    windows = materialize(benchmark_windows(benchmark, item_col, item_text_col, window))
    out = docs.withColumns(
        {
            f"{prefix}words": F.lit(0).cast("long"),
            f"{prefix}spans": F.expr("cast(array() as array<struct<start:int,end:int>>)"),
            f"{prefix}items": F.expr("cast(array() as array<string>)"),
        }
    )
    blocks = _blocks(windows, shingle, block_bytes) or [None]
    for block in blocks:
        if block is not None:
            block.keep_rarest(_shingle_counts(docs, block, text_col))
        out = _with_block(out, block, text_col, prefix)
    return out


def _with_block(docs: DataFrame, block: Block | None, text_col: str, prefix: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    schema, names = docs.schema, docs.columns
    at_text = names.index(text_col)
    at_words, at_spans, at_items = (names.index(f"{prefix}{x}") for x in ("words", "spans", "items"))

    def scan(batches):
        block = shared.value
        for batch in batches:
            counts, spans, items = [], [], []
            had_spans, had_items = batch.column(at_spans), batch.column(at_items)
            for lo, hi, data, offsets in kernel.chunks(batch.column(at_text)):
                words, hashes = _words_of(data, offsets)
                counts.append(words.counts)
                at, window = block.hits(words, hashes) if block else (np.zeros(0, np.int64),) * 2
                text = words.text[at] if len(at) else at
                order = np.argsort(text, kind="stable")
                cut = np.searchsorted(text[order], np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    own = order[cut[i] : cut[i + 1]]
                    before, earlier = had_spans[lo + i].as_py(), had_items[lo + i].as_py()
                    if not len(own):
                        spans.append(before)
                        items.append(earlier)
                        continue
                    starts = np.append(at[own] - words.bounds[i], [s["start"] for s in before]).astype(np.int64)
                    ends = np.append(
                        at[own] - words.bounds[i] + block.length[window[own]], [s["end"] for s in before]
                    ).astype(np.int64)
                    first, last = kernel.runs(kernel.covered(int(words.counts[i]), starts, ends))
                    spans.append([{"start": int(s), "end": int(e)} for s, e in zip(first, last)])
                    ids = {x for j in set(window[own].tolist()) for x in block.items[j]}
                    items.append(sorted(ids | set(earlier)))
            columns = list(batch.columns)
            columns[at_words] = pa.array(np.concatenate(counts) if counts else [], pa.int64())
            columns[at_spans] = pa.array(spans, batch.schema.field(at_spans).type)
            columns[at_items] = pa.array(items, batch.schema.field(at_items).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(scan, schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, in their own columns."""
    marked = annotate(docs, benchmark, prefix="__bench_", **options)
    return marked.filter(F.size("__bench_items") == 0).select(*docs.columns)
