"""Source divergence audit by a minimal-perfect-hash recount.

How far apart are the sources of a language in the words they use, and which words set a source
off from its language?

1. Exact frequency filter: every task counts the documents of each (language, term), partial
   counts are summed by key, and terms in fewer than ``min_docs`` documents of a language go.
2. The kept terms of a language are dealt into shards by hash; each shard becomes a
   :class:`PerfectHash`, a dense numbering of its terms that stores them for verification.
3. Recount: the shards are broadcast in rounds of about ``round_bytes``, one round alive at a
   time, and a pass over the texts increments dense counters per (language, source) group. A
   term that is not stored fails the comparison with the key in its slot. A task holds at most
   ``dense_slots`` counters; beyond it writes them out and starts anew. The number of passes is
   the bytes of the kept terms over ``round_bytes``: raise it on executors with room.
4. The counters are summed per group and slot. Divergences between the sources are computed in
   tiles, for ``block`` slots and two sets of up to ``tile`` sources at a time, and summed.

Probabilities are integers in parts per ``ONE``: p = 1 + floor(ONE * (count + 1) / (N + V)), and
the divergence of p from q sums floor((p - q)**2 / q). All of it is exact integer arithmetic,
up to N + V of 9 * 10**15.

Defined results: NULL text, lang or source count as ''; every row is a document of its own, so
repeated rows count repeatedly; a group without terms has N = 0; a language without kept terms
has pairs of value 0 and no terms; ties are ranked by the item's UTF-8 bytes; an empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm import kernel
from sparkloom.session import materialize

ONE = 1_000_000_000
_CHUNK = 4 << 20
_EMIT = 1 << 18  # rows of a record batch
_LEVELS = 24
_byte = np.arange(256)
TERM = ((_byte >= 0x41) & (_byte <= 0x5A)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)


@dataclass(frozen=True)
class Settings:
    min_docs: int = 3
    top: int = 200  # ranked terms of a group
    shard_bytes: int = 8 << 20
    round_bytes: int = 64 << 20
    dense_slots: int = 1 << 25
    tile: int = 32
    block: int = 1 << 13  # slots of a tile


class PerfectHash:
    """Slots 0 .. n-1 for n distinct strings, found without storing which is where.

    Level by level, each key left sets a bit at a hashed place; a key alone on its bit keeps
    it, the others go on to the next level. A slot is the rank of the bit. Keys that no level
    separates (equal 64-bit hashes) follow in order and are found by comparison.
    """

    def __init__(self, sizes: list[int], bits: bytes, keys: pa.Array):
        self.sizes, self.keys = list(sizes), keys
        self.words = np.frombuffer(bits, np.uint64)
        before = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64))
        self.ranks, self.separated = before[:-1].astype(np.int32), int(before[-1])

    @classmethod
    def build(cls, hashes: np.ndarray, keys: pa.Array) -> PerfectHash:
        left, slots, levels, used = np.arange(len(hashes)), np.zeros(len(hashes), np.int64), [], 0
        while len(left) and len(levels) < _LEVELS:
            size = -(-2 * len(left) // 64) * 64
            place = _place(hashes[left], len(levels), size)
            bits = np.bincount(place, minlength=size) == 1
            alone = bits[place]
            slots[left[alone]] = used + (np.cumsum(bits) - 1)[place[alone]]
            used += int(alone.sum())
            left = left[~alone]
            levels.append(bits)
        slots[left] = used + np.arange(len(left))
        order = np.empty(len(slots), np.int64)
        order[slots] = np.arange(len(slots))
        packed = np.packbits(np.concatenate(levels), bitorder="little").tobytes() if levels else b""
        return cls([len(b) for b in levels], packed, keys.take(pa.array(order)))

    def find(self, hashes: np.ndarray, words: pa.Array) -> np.ndarray:
        """The slot of each word; -1 for words that are not stored."""
        slots, left, base = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            place = _place(hashes[left], level, size)
            word, bit = self.words[base + (place >> 6)], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            slots[left[hit]] = (self.ranks[base + (place >> 6)] + below)[hit]
            left, base = left[~hit], base + size // 64
        if len(left) and self.separated < len(self.keys):
            found = pc.index_in(words.take(pa.array(left)), self.keys[self.separated :])
            slots[left] = np.asarray(pc.fill_null(found, -self.separated - 1)) + self.separated
        some = np.flatnonzero(slots >= 0)
        same = pc.equal(self.keys.take(pa.array(slots[some])), words.take(pa.array(some)))
        slots[some[~np.asarray(same)]] = -1
        return slots


def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return (kernel.mix(hashes + salt) % np.uint64(size)).astype(np.int64)


def _hashes(words: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()], np.uint64)


def _terms(column: pa.Array):
    """Per chunk: (first row, last row + 1, text of each token, its place among the distinct
    terms of the chunk, those terms)."""
    for lo, hi, data, offsets in kernel.chunks(column, _CHUNK):
        data = kernel.LOWER[data]
        words = kernel.Words(data, offsets, TERM)
        ends = np.append(0, np.cumsum(words.ends - words.starts))
        tokens = pa.LargeStringArray.from_buffers(
            len(words.starts), pa.py_buffer(ends), pa.py_buffer(data[TERM[data]]))
        coded = tokens.dictionary_encode()
        yield lo, hi, words.text, np.asarray(coded.indices).astype(np.int64), coded.dictionary


def _coded(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), coded.dictionary.to_pylist()


def frequent_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """``(lang, term, hash)`` of the terms in at least ``min_docs`` documents of a language."""

    def run(batches):
        for batch in batches:
            langs, names = _coded(batch.column(0))
            for lo, hi, text, code, terms in _terms(batch.column(2)):
                if not len(code):
                    continue
                once = np.unique(text * len(terms) + code)  # a document counts once
                key, n = np.unique(langs[lo:hi][once // len(terms)] * len(terms) + once % len(terms), return_counts=True)
                hashes = _hashes(terms).view(np.int64)
                at = pa.array(key % len(terms))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()).take(pa.array(key // len(terms))), terms.take(at).cast(pa.string()),
                     pa.array(hashes[key % len(terms)]), pa.array(n.astype(np.int64))], names=["lang", "term", "hash", "n"])

    counted = docs.mapInArrow(run, "lang string, term string, hash long, n long")
    return counted.groupBy("lang", "term", "hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs).drop("n")


_INDEX = "lang string, shard int, n long, bytes long, sizes array<int>, bits binary, keys array<string>"


def index_terms(kept: DataFrame, shards: int) -> DataFrame:
    """One row per language and shard: its perfect hash, with the terms in slot order."""

    def build(key, table):
        made = PerfectHash.build(table.column("hash").to_numpy().view(np.uint64), table.column("term").combine_chunks())
        keys = made.keys.combine_chunks() if isinstance(made.keys, pa.ChunkedArray) else made.keys
        return pa.table({
            "lang": pa.array([key[0].as_py()]), "shard": pa.array([key[1].as_py()], pa.int32()),
            "n": pa.array([len(keys)], pa.int64()), "bytes": pa.array([keys.nbytes + made.words.nbytes], pa.int64()),
            "sizes": pa.array([made.sizes], pa.list_(pa.int32())), "bits": pa.array([made.words.tobytes()], pa.binary()),
            "keys": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys.cast(pa.string())),
        })

    return kept.withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int")).groupBy("lang", "shard").applyInArrow(build, _INDEX)


class Round:
    """The perfect hashes of one round. A language's slots lie side by side, shard by shard."""

    def __init__(self, table: pa.Table, shards: int):
        self.shards, self.langs = shards, {}
        for row in range(table.num_rows):
            keys = table.column("keys")[row].values
            keys = keys.take(pa.array(np.arange(len(keys))))  # a copy: a slice is pickled with its whole buffer
            own = PerfectHash(table.column("sizes")[row].as_py(), table.column("bits")[row].as_py(), keys)
            self.langs.setdefault(table.column("lang")[row].as_py(), []).append((table.column("shard")[row].as_py(), own))
        self.starts = {lang: np.append(0, np.cumsum([len(x.keys) for _, x in parts])) for lang, parts in self.langs.items()}

    def size(self, lang: str) -> int:
        return int(self.starts[lang][-1]) if lang in self.starts else 0

    def find(self, lang: str, hashes: np.ndarray, words: pa.Array) -> np.ndarray:
        out = np.full(len(words), -1, np.int64)
        shard = np.mod(hashes.view(np.int64), self.shards)
        for (number, table), start in zip(self.langs.get(lang, ()), self.starts.get(lang, ())):
            own = np.flatnonzero(shard == number)
            slots = table.find(hashes[own], words.take(pa.array(own)))
            out[own] = np.where(slots >= 0, slots + start, -1)
        return out

    def named(self, lang: str, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shard, slot in it) of positions among a language's slots."""
        part = np.searchsorted(self.starts[lang], at, "right") - 1
        return np.array([s for s, _ in self.langs[lang]], np.int32)[part], at - self.starts[lang][part]


def recount(docs: DataFrame, shared, dense_slots: int) -> DataFrame:
    """Occurrences per group and slot, partial per task: (lang, source, shard, slot, n)."""

    def run(batches):
        index, dense, held = shared.value, {}, 0

        def flush():
            for (lang, source), counts in dense.items():
                at = np.flatnonzero(counts)
                for s in range(0, len(at), _EMIT):
                    some = at[s : s + _EMIT]
                    shard, slot = index.named(lang, some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]).take(pa.array(np.zeros(len(some), int))), pa.array([source]).take(pa.array(np.zeros(len(some), int))),
                         pa.array(shard), pa.array(slot), pa.array(counts[some])], names=["lang", "source", "shard", "slot", "n"])
            dense.clear()

        for batch in batches:
            (langs, lang_names), (sources, source_names) = _coded(batch.column(0)), _coded(batch.column(1))
            groups = langs * len(source_names) + sources
            for lo, hi, text, code, terms in _terms(batch.column(2)):
                if not len(code):
                    continue
                hashes = _hashes(terms)
                cell, n = np.unique(groups[lo:hi][text] * len(terms) + code, return_counts=True)
                group, term = cell // len(terms), cell % len(terms)
                for lang in np.unique(group // len(source_names)).tolist():
                    own = np.flatnonzero(group // len(source_names) == lang)
                    name = lang_names[lang]
                    size = index.size(name)
                    if not size:
                        continue
                    some, back = np.unique(term[own], return_inverse=True)
                    slots = index.find(name, hashes[some], terms.take(pa.array(some)).cast(pa.string()))[back]
                    own, slots = own[slots >= 0], slots[slots >= 0]
                    for g in np.unique(group[own]).tolist():
                        key = (name, source_names[g % len(source_names)])
                        if key not in dense:
                            if dense and held + size > dense_slots:
                                yield from flush()
                                held = 0
                            dense[key] = np.zeros(size, np.int64)
                            held += size
                        mine = group[own] == g
                        dense[key][slots[mine]] += n[own[mine]]  # slots of a group are distinct here
        yield from flush()

    return docs.mapInArrow(run, "lang string, source string, shard int, slot long, n long")


def _scaled(count: Column, total: Column) -> Column:
    """1 + floor(ONE * (count + 1) / total), three digits at a time so that nothing overflows."""
    out, rest = F.lit(0).cast("long"), count + 1
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + F.call_function("div", rest, total)
        rest = rest % total
    return out + 1


def _scaled_array(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    out, rest = np.zeros(count.shape, np.int64), count + 1
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def _distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Summed floor((p - q)**2 / q) over the terms, for every row of p against every row of q."""
    return np.stack([(((x - q) ** 2) // q).sum(1) for x in p]) if len(p) else np.zeros((0, len(q)), np.int64)


def _pairs(cells: DataFrame, sources: DataFrame, index: DataFrame, tile: int, block: int) -> DataFrame:
    """``(lang, a, b, value)`` for every two sources (by number) of a language."""
    tiles = sources.groupBy("lang").agg((F.floor(F.max("number") / tile) + 1).cast("int").alias("tiles"))
    numbered = sources.withColumn("own", F.floor(F.col("number") / tile).cast("int")).join(tiles, "lang")

    def dealt(rows):
        """Each row under every pair of tiles that its own tile is in."""
        rows = rows.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        return rows.withColumn("x", F.least("own", "t")).withColumn("y", F.greatest("own", "t")).drop("own", "t", "tiles")

    blocks = index.select("lang", "shard", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / block).cast("int"))).alias("block"), "n").select(
        "lang", "shard", "block", F.least(F.lit(block).cast("long"), F.col("n") - F.col("block") * block).alias("size"))
    none = sources.filter("v = 0").select("lang").distinct().select(
        "lang", F.lit(-1).alias("shard"), F.lit(0).alias("block"), F.lit(0).cast("long").alias("size"))
    members = dealt(numbered).groupBy("lang", "x", "y").agg(
        F.collect_list(F.struct("number", (F.col("total") + F.col("v")).alias("total"))).alias("members"))  # 2 * tile at most
    key = ["lang", "shard", "block", "x", "y"]
    left = blocks.unionByName(none).join(members, "lang").select(*key, "size", "members")
    right = dealt(cells.join(numbered.select("lang", "source", "number", "own", "tiles"), ["lang", "source"]).withColumn(
        "block", (F.col("slot") / block).cast("int"))).select(*key, "number", "slot", "n")

    def run(tile_key, table, counted):
        lang, x, y = (tile_key[i].as_py() for i in (0, 3, 4))
        rows = sorted((m["number"], m["total"]) for m in table.column("members")[0].as_py())
        number, total = (np.array(v, np.int64) for v in zip(*rows))
        columns, at = np.unique(counted.column("slot").to_numpy(), return_inverse=True)
        # the last column stands for the terms of the block that no source here has
        count = np.zeros((len(number), len(columns) + 1), np.int64)
        count[np.searchsorted(number, counted.column("number").to_numpy()), at] = counted.column("n").to_numpy()
        p = _scaled_array(count, np.maximum(total, 1)[:, None])
        rest = table.column("size")[0].as_py() - len(columns)
        first, second = (np.flatnonzero(number // tile == t) for t in (x, y))
        made = {}
        for a, b in ((first, second), (second, first)):
            value = _distances(p[a][:, :-1], p[b][:, :-1]) + rest * _distances(p[a][:, -1:], p[b][:, -1:])
            made.update({(int(number[i]), int(number[j])): int(value[r, c]) for r, i in enumerate(a) for c, j in enumerate(b) if i != j})
        return pa.table({
            "lang": pa.array([lang] * len(made), pa.string()), "a": pa.array([a for a, _ in made], pa.int32()),
            "b": pa.array([b for _, b in made], pa.int32()), "value": pa.array(list(made.values()), pa.int64())})

    parts = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "lang string, a int, b int, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _marked(cells: DataFrame, sources: DataFrame, index: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` of the terms that a group has more often than its language."""
    at = ["lang", "shard", "slot"]
    whole = cells.groupBy(*at).agg(F.sum("n").alias("whole"))
    names = index.select("lang", "shard", F.posexplode("keys").alias("slot", "item")).withColumn("slot", F.col("slot").cast("long"))
    size = sources.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("v").alias("v"))
    known = whole.join(names, at).join(size, "lang").withColumn("q", _scaled(F.col("whole"), F.col("lang_total") + F.col("v")))
    p = _scaled(F.col("n"), F.col("total") + F.col("v"))
    both = (
        cells.join(sources.select("lang", "source", "total"), ["lang", "source"])
        .join(known.select(*at, "item", "q", "v"), at).withColumn("p", p).filter("p > q")
    )
    apart = F.col("p") - F.col("q")
    return both.select("lang", "source", "item", F.call_function("div", apart * apart, F.col("q")).alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cfg: Settings = Settings()) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: per group the divergence from every other
    source of its language (part ``pair``), and the ``cfg.top`` terms that it has more often
    than its language as a whole (part ``term``)."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    spark = docs.sparkSession
    kept = materialize(frequent_terms(docs, cfg.min_docs))
    size = kept.agg(F.sum(F.octet_length("term") + 5)).first()[0] or 0
    shards = max(1, -(-size // cfg.shard_bytes))
    index = materialize(index_terms(kept, shards))
    total = index.agg(F.sum("bytes")).first()[0] or 0
    rounds = min(shards, max(1, -(-total // cfg.round_bytes)))
    cells = None
    for number in range(rounds):
        own = index.filter(F.col("shard") % rounds == number).select("lang", "shard", "sizes", "bits", "keys").toArrow()
        shared = spark.sparkContext.broadcast(Round(own, shards))
        part = materialize(recount(docs, shared, cfg.dense_slots).groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n")))
        shared.destroy()
        cells = part if cells is None else cells.unionByName(part)

    volume = index.groupBy("lang").agg(F.sum("n").alias("v"))
    sources = materialize(
        docs.select("lang", "source").distinct()
        .join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(volume, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"),
                (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("number")))
    names = sources.select("lang", "number", "source")
    pairs = (
        _pairs(cells, sources, index, cfg.tile, cfg.block)
        .join(names.withColumnRenamed("number", "a"), ["lang", "a"])
        .join(names.select("lang", F.col("number").alias("b"), F.col("source").alias("item")), ["lang", "b"])
        .select("lang", "source", "item", "value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(by_value)).withColumn("part", F.lit("pair"))
    terms = _marked(cells, sources, index).withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= cfg.top)
    return ranked.unionByName(terms.withColumn("part", F.lit("term"))).select("lang", "source", "part", "item", "value", "rank")
