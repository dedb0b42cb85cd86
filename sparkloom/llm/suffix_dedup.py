"""Suffix-array dedup: remove every byte covered by a ``WINDOW``-byte string that also starts
earlier (smaller id, or same document and earlier start), over all documents.

One index over the whole corpus would not be distributable, so equal strings are first made
to meet, by content:

1. The anchor of a window is the ``GRAM``-byte gram in it with the least hash. Successive
   windows with the same anchor are a cell, about 40 bytes of starts. Equal windows have equal
   anchors at the same offset, so they lie in cells of the same anchor, wherever they are.
2. Cells go to buckets by anchor, as a few bytes each. Cells with equal bytes (64-bit hash)
   have all windows in common: all but the earliest are removed whole. An anchor with only
   one kind of cell is done.
3. Where an anchor has several kinds of cells (edges of copied passages, edits), two kinds
   may still share windows. The starts of a cell fall into ``PARTS`` parts, and all windows of
   a part have a core of bytes in common; kinds without an equal core (16-bit marks) are done.
   The bytes of the earliest cell of each other kind are fetched and indexed: a run-length
   Burrows-Wheeler index per bucket (``run_index``), through which the cells are streamed. A
   window is removed if the interval of its match holds an earlier one.
4. Each document gets its ranges, and removes them.

Cells that repeat inside a task are settled there, so a passage that a third of all rows
share arrives at its bucket once per task; an anchor with more than ``HOT`` kinds of cells is
dealt out window by window, by the windows' own hash, and of equal windows in a block of
documents only the earliest is sent to the index.

Empty and edge input: NULL text is empty; texts shorter than a window keep everything; a NULL
id comes after all others; rows that repeat an id are the same document, so equal starts are
not earlier than each other and each row is answered.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import kernel
from sparkloom.llm.run_index import RunLengthIndex
from sparkloom.session import materialize

WINDOW, GRAM, PARTS = 100, 24, 4
SLAB = 4 << 20
BUCKET_BYTES, BLOCK_BYTES, INDEX_BYTES = 24 << 20, 4 << 20, 1 << 20
HOT = 20_000
_FLUSH = 400_000  # cells that a task holds before it sends them
_LAST = np.iinfo(np.int64).max

_CELL = np.dtype([("anchor", "u8"), ("cell", "u8"), ("doc", "u4"), ("at", "u4"), ("low", "u1"), ("high", "u1"), ("marks", "u2", (PARTS,))])
_DOC = np.dtype([("id", "i8"), ("text", "i8"), ("block", "i4")])
_RANGE = np.dtype([("id", "i8"), ("text", "i8"), ("start", "u4"), ("end", "u4")])


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[: len(v) - (width - have)], v[width - have :]) if have < width else v


def cells(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Cells of the texts of a chunk: (text, anchor hash, cell hash, anchor position, first
    byte, end, marks of the parts' cores), positions within the text."""
    sizes = np.diff(offsets)
    starts_per_text = np.maximum(sizes - window + 1, 0)
    if not starts_per_text.any():
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none, none, np.zeros((0, PARTS), np.uint16)
    ranges = kernel.RangeHash(data)
    at = len(data) - gram + 1
    grams = kernel.mix((ranges.sums[gram:] - ranges.sums[:-gram]) * kernel.powers(kernel._BASE_INVERSE, at))
    value = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(at, dtype=np.uint64)
    anchor = (_sliding_min(value, window - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), starts_per_text)
    first_of = np.cumsum(starts_per_text) - starts_per_text
    start = np.arange(len(text)) - first_of[text] + offsets[:-1][text]
    a = anchor[start]
    new = np.append(True, (a[1:] != a[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    text, a, low, high = text[first], a[first], start[first], start[last] + window
    cell = kernel.mix(ranges.of(low, high) ^ (a - low).astype(np.uint64))
    marks = np.zeros((len(a), PARTS), np.uint16)
    edge = [(gram - window) * (PARTS - j) // PARTS for j in range(PARTS + 1)]  # of starts, from the anchor
    for j in range(PARTS):
        own = np.flatnonzero(np.maximum(low - a, edge[j]) <= np.minimum(high - window - a, edge[j + 1]))
        core = ranges.of(a[own] + edge[j + 1], a[own] + edge[j] + window)
        marks[own, j] = core % np.uint64(65535) + np.uint64(1)
    base = offsets[:-1][text]
    return text, grams[a], cell, a - base, low - base, high - base, marks


def _text_cells(column: pa.Array):
    """Yield (row, ...cells) per chunk; a giant text goes slab by slab."""
    for lo, hi, data, offsets in kernel.chunks(column):
        if len(data) <= 2 * SLAB:
            text, *rest = cells(data, offsets)
            yield lo + text, *rest
        else:
            for s in range(0, len(data), SLAB):
                piece = data[s : s + SLAB + WINDOW - 1]
                text, anchor, cell, at, low, high, marks = cells(piece, np.array([0, len(piece)]))
                yield lo + text, anchor, cell, at + s, low + s, high + s, marks


def _earliest(group: list[np.ndarray], order: list[np.ndarray]):
    """Sort by group and order; (sorting, is the group's first or its equal, group start)."""
    by = np.lexsort([*reversed(order), *reversed(group)])
    new = np.zeros(len(by), bool)
    new[:1] = True
    for g in group:
        new[1:] |= g[by][1:] != g[by][:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    first = np.ones(len(by), bool)
    for o in order:
        first &= o[by] == o[by][head]
    return by, first, new


def _by_block(block: np.ndarray, ranges: np.ndarray):
    """Yield (block, ranges of it)."""
    by = np.argsort(block, kind="stable")
    for part in np.split(by, np.flatnonzero(np.diff(block[by])) + 1) if len(by) else []:
        yield int(block[part[0]]), ranges[part]


def _send(docs: DataFrame, buckets: int) -> DataFrame:
    """``docs (doc_id, text, text_key, block)`` to packed cells per bucket (kind 0), and the
    ranges that are settled inside the task (kind 1, passed through any bucket)."""

    def run(batches):
        held, tables, amount, known = [], [], 0, 0

        def flush():
            cell, doc = np.concatenate(held), np.concatenate(tables)
            by, first, _ = _earliest([cell["anchor"], cell["cell"]], [doc["id"][cell["doc"]], cell["at"]])
            late = cell[by[~first]]
            out = []
            for block, part in _by_block(doc["block"][late["doc"]], _ranges(doc, late)):
                out.append((block % buckets, 1, block, b"", part.tobytes()))
            cell = cell[np.sort(by[first])]
            bucket = (kernel.mix(cell["anchor"]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
                own, local = np.unique(cell["doc"][part], return_inverse=True)
                some = cell[part]
                some["doc"] = local
                out.append((int(bucket[part[0]]), 0, -1, doc[own].tobytes(), _columns(some)))
            return _rows(out, ("bucket", "kind", "block", "docs", "cells"))

        for batch in batches:
            table = np.zeros(batch.num_rows, _DOC)
            table["id"] = np.asarray(batch.column(0).fill_null(_LAST))
            table["text"], table["block"] = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            tables.append(table)
            for row, anchor, cell, at, low, high, marks in _text_cells(batch.column(1)):
                some = np.zeros(len(row), _CELL)
                some["anchor"], some["cell"], some["doc"], some["at"] = anchor, cell, row + known, at
                some["low"], some["high"], some["marks"] = at - low, high - at, marks
                held.append(some)
                amount += len(row)
                if amount > _FLUSH:
                    yield flush()
                    held, amount = [], 0
            known += batch.num_rows
        if held:
            yield flush()

    return docs.mapInArrow(run, "bucket int, kind int, block int, docs binary, cells binary")


def _ranges(doc: np.ndarray, cell: np.ndarray) -> np.ndarray:
    out = np.zeros(len(cell), _RANGE)
    out["id"], out["text"] = doc["id"][cell["doc"]], doc["text"][cell["doc"]]
    out["start"], out["end"] = cell["at"] - cell["low"], cell["at"] + cell["high"]
    return out


def _columns(cell: np.ndarray) -> bytes:
    """Column by column, which compresses better; anchors lose the half that orders them."""
    return b"".join([(cell["anchor"] & np.uint64(0xFFFFFFFF)).astype("u4").tobytes()] + [cell[f].tobytes() for f in _CELL.names[1:]])


def _cells_of(blob: bytes) -> np.ndarray:
    n, at = len(blob) // (_CELL.itemsize - 4), 0
    out = np.zeros(n, _CELL)
    for name in _CELL.names:
        kind, shape = ("u4", ()) if name == "anchor" else (_CELL[name].base, _CELL[name].shape)
        values = np.frombuffer(blob, kind, n * int(np.prod(shape, dtype=int)), at)
        out[name] = values.reshape(n, *shape)
        at += values.nbytes
    return out


def _rows(rows: list[tuple], names) -> pa.RecordBatch:
    kinds = [pa.binary() if n in ("docs", "cells", "ranges", "wanted", "pieces") else pa.int32() for n in names]
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=list(names))


_WANTED = np.dtype([*_RANGE.descr, ("anchor", "u8"), ("hot", "u1")])


def _settle(sent: DataFrame, hot: int) -> DataFrame:
    """Per bucket and block: ``ranges`` to remove, and cells ``wanted`` for the index."""

    def run(key, table):
        docs, parts, base, out = [], [], 0, []
        for kind, block, d, c in zip(*(table.column(n).to_pylist() for n in ("kind", "block", "docs", "cells"))):
            if kind == 1:
                out.append((block, c, b"", (len(c) // _RANGE.itemsize), 0))
                continue
            d, c = np.frombuffer(d, _DOC), _cells_of(c)
            c["doc"] += base
            base += len(d)
            docs.append(d)
            parts.append(c)
        if parts:
            doc, cell = np.concatenate(docs), np.concatenate(parts)
            by, first, new = _earliest([cell["anchor"], cell["cell"]], [doc["id"][cell["doc"]], cell["at"]])
            cell = cell[by]
            late = cell[~first]
            starts = np.append(True, cell["anchor"][1:] != cell["anchor"][:-1])
            of_anchor = np.cumsum(starts) - 1
            kinds = np.bincount(of_anchor[new])
            # a kind stays open if another kind of its anchor has an equal core
            open_ = np.zeros(len(cell), bool)
            for j in range(PARTS):
                core = of_anchor * 65536 + cell["marks"][:, j]
                keys, n = np.unique(core[new], return_counts=True)
                open_ |= (cell["marks"][:, j] > 0) & (n[np.searchsorted(keys, core)] > 1)
            some, many = cell[first & open_], (kinds[of_anchor] > hot)[first & open_]
            wanted = np.zeros(len(some), _WANTED)
            ranges = _ranges(doc, some)
            for name in _RANGE.names:
                wanted[name] = ranges[name]
            wanted["anchor"] = some["anchor"] * np.uint64(1 << 16) + np.uint64(key[0].as_py() % (1 << 16))
            wanted["hot"] = many
            gone = dict(_by_block(doc["block"][late["doc"]], _ranges(doc, late)))
            want = dict(_by_block(doc["block"][some["doc"]], wanted))
            for block in sorted(gone.keys() | want.keys()):
                g, w = gone.get(block, np.zeros(0, _RANGE)), want.get(block, np.zeros(0, _WANTED))
                size = int(np.where(w["hot"] == 1, 100 * (w["end"] - w["start"].astype(np.int64)), w["end"] - w["start"].astype(np.int64)).sum())
                out.append((block, g.tobytes(), w.tobytes(), len(g), size))
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()))],
                        names=["block", "ranges", "wanted", "n_ranges", "wanted_bytes"])

    return sent.groupBy("bucket").applyInArrow(run, "block int, ranges binary, wanted binary, n_ranges long, wanted_bytes long")


_PIECE = np.dtype([("id", "i8"), ("text", "i8"), ("block", "i4"), ("start", "u4"), ("size", "u4")])


def _texts(table: pa.Table):
    """{(id, text key): bytes} of one block, and its rows in order."""
    ids = [(_LAST if i is None else i) for i in table.column("doc_id").to_pylist()]
    keys = table.column("text_key").to_pylist()
    texts = [(t or "").encode() for t in table.column("text").to_pylist()]
    return ids, keys, texts


def _fetch(docs: DataFrame, settled: DataFrame, buckets: int) -> DataFrame:
    """The bytes of the wanted cells, packed per index bucket. Of a hot anchor's windows only the
    earliest of each block is sent; the block's others are ``ranges`` to remove."""

    def run(key, left, right):
        ids, keys, texts = _texts(left)
        have = dict(zip(zip(ids, keys), texts))
        block = key[0].as_py()
        wanted = [np.frombuffer(b, _WANTED) for b in right.column("wanted").to_pylist()]
        wanted = np.unique(np.concatenate(wanted)) if wanted else np.zeros(0, _WANTED)
        out: dict[int, tuple[list, list]] = {}
        windows: dict[bytes, list] = {}  # of hot anchors

        def put(bucket, w, start, data):
            pieces, body = out.setdefault(bucket, ([], []))
            pieces.append((w[0], w[1], block, start, len(data)))
            body.append(data)

        spread = (kernel.mix(wanted["anchor"]) % np.uint64(buckets)).tolist()
        for w, bucket in zip(wanted.tolist(), spread):
            data = have[w[0], w[1]][w[2] : w[3]]
            if not w[5]:
                put(bucket, w, w[2], data)
                continue
            for s in range(len(data) - WINDOW + 1):
                windows.setdefault(data[s : s + WINDOW], []).append((w[0], w[2] + s, w[1]))
        late = []
        for one, found in windows.items():
            least = min(found)[:2]
            bucket = int.from_bytes(hashlib.blake2b(one, digest_size=8).digest(), "little") % buckets
            for doc, start, text in found:
                if (doc, start) == least:
                    put(bucket, (doc, text), start, one)
                else:
                    late.append((doc, text, start, start + WINDOW))
        rows = [(b, np.array(p, _PIECE).tobytes(), b"".join(d), -1, b"") for b, (p, d) in sorted(out.items())]
        if late:
            rows.append((block % buckets, b"", b"", block, _merged(np.sort(np.array(late, _RANGE))).tobytes()))
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["bucket", "pieces", "body", "block", "ranges"])

    need = materialize(settled.filter("wanted_bytes > 0").select("block", "wanted"))
    return (
        docs.groupBy("block").cogroup(need.groupBy("block")).applyInArrow(
            run, "bucket int, pieces binary, body binary, block int, ranges binary")
    )


def _merged(ranges: np.ndarray) -> np.ndarray:
    """Sorted ranges, those whose starts follow on each other joined."""
    new = np.ones(len(ranges), bool)
    for name, step in (("id", 0), ("text", 0), ("start", 1)):
        new[1:] &= ranges[name][1:] == ranges[name][:-1] + step
    new[1:] = ~new[1:]
    first = np.flatnonzero(new)
    out = ranges[first]
    out["end"] = ranges["end"][np.append(first[1:], len(ranges)) - 1]
    return out


def _indexed(pieces: DataFrame) -> DataFrame:
    """Ranges to remove, from the run-length index of each bucket, and those already known."""

    def run(table):
        known = table.filter(pc.greater(pc.binary_length(table.column("ranges")), 0)).select(["block", "ranges"])
        table = table.filter(pc.greater(pc.binary_length(table.column("pieces")), 0))
        if not table.num_rows:
            return known
        piece = np.concatenate([np.frombuffer(p, _PIECE) for p in table.column("pieces").to_pylist()])
        data = np.frombuffer(b"".join(table.column("body").to_pylist()), np.uint8)
        size = piece["size"].astype(np.int64)
        _, rank = np.unique(piece["id"], return_inverse=True)
        ends = np.cumsum(size)
        inside = np.arange(len(data)) - np.repeat(ends - size, size)
        key = (np.repeat(rank, size).astype(np.uint64) << np.uint64(32)) | (np.repeat(piece["start"].astype(np.int64), size) + inside).astype(np.uint64)
        index = RunLengthIndex(data, size, key, WINDOW)
        late = np.zeros(len(data), bool)
        for alive, length, rows in index.matching_statistics():
            if length >= WINDOW:  # a long match: is an earlier window in its interval?
                at = ends[alive] - length
                late[at] = index.least_key(rows) < key[at]
        # ranges of removed bytes per piece
        where = np.flatnonzero(late)
        owner = np.searchsorted(ends, where, "right")
        new = np.append(True, (where[1:] != where[:-1] + 1) | (owner[1:] != owner[:-1])) if len(where) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(where)) - 1 if len(first) else first
        out = np.zeros(len(first), _RANGE)
        own = owner[first]
        out["id"], out["text"] = piece["id"][own], piece["text"][own]
        out["start"] = piece["start"][own] + inside[where[first]]
        out["end"] = piece["start"][own] + inside[where[last]] + WINDOW
        rows = [(b, part.tobytes()) for b, part in _by_block(piece["block"][own], out)]
        columns = list(zip(*rows)) if rows else [[]] * 2
        found = pa.table([pa.array(list(c), k) for c, k in zip(columns, (pa.int32(), pa.binary()))], names=["block", "ranges"])
        return pa.concat_tables([known, found])

    return pieces.groupBy("bucket").applyInArrow(run, "block int, ranges binary")


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``(doc_id, text, removed)``: each row with its maximal removed byte ranges."""
    text_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = max(16, total // BLOCK_BYTES)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), text_key.alias("text_key"))
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(blocks)).cast("int"))
    settled = materialize(_settle(_send(docs, max(16, total // BUCKET_BYTES)), hot))
    wanted = settled.agg(F.sum("wanted_bytes")).first()[0] or 0
    ranges = settled.select("block", "ranges")
    if wanted:
        found = _indexed(_fetch(docs, settled, max(16, wanted // INDEX_BYTES)))
        ranges = ranges.unionAll(materialize(found))
    ranges = ranges.filter(F.octet_length("ranges") > 0)

    def run(key, left, right):
        ids, keys, texts = _texts(left)
        gone = [np.frombuffer(b, _RANGE) for b in right.column("ranges").to_pylist()]
        gone = np.concatenate(gone) if gone else np.zeros(0, _RANGE)
        order = np.lexsort((gone["text"], gone["id"]))
        gone = gone[order]
        new = np.append(True, (gone["id"][1:] != gone["id"][:-1]) | (gone["text"][1:] != gone["text"][:-1])) if len(gone) else np.zeros(0, bool)
        first = np.append(np.flatnonzero(new), len(gone))
        at = {(int(gone["id"][f]), int(gone["text"][f])): (f, t) for f, t in zip(first[:-1], first[1:])}
        out = []
        for i, k, text in zip(ids, keys, texts):
            f, t = at.get((i, k), (0, 0))
            mask = kernel.covered(len(text), gone["start"][f:t].astype(np.int64), gone["end"][f:t].astype(np.int64))
            out.append([{"start": int(s), "end": int(e)} for s, e in zip(*kernel.runs(mask))])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table({"doc_id": left.column("doc_id"), "text": left.column("text"), "removed": pa.array(out, kind)})

    return docs.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(
        run, "doc_id long, text string, removed array<struct<start:int,end:int>>")


def summary(rows: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of ``marked`` rows."""

    def run(batches):
        for batch in batches:
            out = []
            for doc, text, removed in zip(*(c.to_pylist() for c in batch.columns)):
                data, at, kept, gone = (text or "").encode(), 0, hashlib.sha256(), 0
                for r in removed:
                    kept.update(data[at : r["start"]])
                    at, gone = r["end"], gone + r["end"] - r["start"]
                kept.update(data[at:])
                out.append((doc, len(data), gone, len(removed), kept.hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
