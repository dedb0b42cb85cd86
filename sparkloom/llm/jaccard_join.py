"""N-gram Jaccard join by vertical partitioning.

A document's set holds the hashes of its distinct word shingles. All sets are sorted in one
global order, frequent shingles last, and the order is cut into fragments.

1. One pass gives each document its set size and set digest, and the frequent shingles:
   each task reports what it saw several times, the sums rank them. Only the order depends on
   that list, never the result. Documents with equal sets are one class from here on.
2. Two sets with enough overlap share a shingle among the first few (the prefix) of both.
   Prefix shingles go to buckets by hash; a bucket pairs the documents of each shingle if
   size and position allow the overlap. A shingle with many documents pairs them with one
   hub only, the document whose shingles are the most frequent ones.
3. Each set has a parity sketch, a few bytes long: bit i tells whether an odd number of its
   shingles hash to i. Two sketches differ in no more bits than their sets differ in shingles,
   so pairs whose sketches differ in too many cannot be similar and go.
4. The other pairs are verified: the sets of both documents are cut into the fragments, each
   fragment counts its part of every pair's overlap, and the parts are summed per pair.
5. Links give components. Only then are the documents of a crowded shingle that are still in
   different components paired with each other and verified; pairs inside a component cannot
   change it. So no link between components is lost, and no group is expanded to all pairs.

A shingle that ``hot`` or more documents are expected to share is dealt over several buckets
(shares 1 and up); each of them, however few documents it gets, names a hub and lists its
members, and the hubs then meet. A crowded shingle's second round is dealt out in
blocks of ``block`` documents, and a hub with many partners in shares of ``block``.

Empty and edge input: a text without words has an empty set and links with nothing; a text
of fewer words than a shingle has its word sequence as one shingle; rows that repeat an id
are one document with the links of all its rows; NULL ids link with nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import kernel
from sparkloom.llm.components import components
from sparkloom.llm.tables import split_by_slot
from sparkloom.session import materialize

_LOCAL_REPEATS = 3  # a task reports shingles that it saw so often among _FLUSH
_FLUSH = 1 << 22
_CLASS_BITS = 6


@dataclass(frozen=True)
class Settings:
    words: int = 4  # words in a shingle
    percent: int = 85  # least similarity, as 100 * intersection >= percent * union
    fragments: int = 4
    crowd: int = 12  # documents of a shingle that are all paired with each other
    hot: int = 50_000
    block: int = 512
    frequent: int = 200_000  # length of the list of frequent shingles
    slots: int = 1 << 20  # of the table that keeps texts without a pair out of a join


def shingle_sets(words: kernel.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, sorted distinct shingle hashes) of the texts of a chunk."""
    hashes = words.hashes()
    at, key = words.windows(hashes, size)
    text = words.text[at] if len(at) else at
    for n in range(1, size):  # shorter texts: the whole word sequence
        short = np.flatnonzero(words.counts == n)
        if len(short):
            whole = kernel.window_hash(hashes, words.bounds[short], n) ^ np.uint64(n)
            text, key = np.append(text, short), np.append(key, whole)
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    text, key = text[new], key[new]
    return np.searchsorted(text, np.arange(len(words.counts) + 1)), key


def _digests(bounds: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set."""
    out = []
    for salt in (0x1234567, 0x7654321):
        sums = np.zeros(len(keys) + 1, np.uint64)
        np.cumsum(kernel.mix(keys ^ np.uint64(salt)), out=sums[1:])
        out.append(kernel.mix(sums[bounds[1:]] - sums[bounds[:-1]]))
    return out[0], out[1]


def parity_sketches(bounds: np.ndarray, keys: np.ndarray) -> pa.Array:
    """Parity of the number of shingles per bin of each set. The bins are a power of two, at
    least the set's size, so sketches of similar sets fold onto each other (see `_distance`)."""
    n = np.diff(bounds)
    bins = np.int64(1) << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    ends = np.cumsum(bins)
    owner = np.repeat(np.arange(len(n)), n)
    at = (keys & (bins[owner] - 1).astype(np.uint64)).astype(np.int64) + (ends - bins)[owner]
    odd = (np.bincount(at, minlength=int(ends[-1]) if len(ends) else 0) & 1).astype(np.uint8)
    offsets = np.append(0, ends // 8).astype(np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(np.packbits(odd, bitorder="little"))])


def _distance(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Bits in which the sketches of each pair differ, the longer one folded to the shorter."""
    short = np.array([min(len(x), len(y)) for x, y in zip(a, b)], np.int64)
    out = np.zeros(len(a), np.int64)

    def folded(sketch, length):
        bits = np.frombuffer(sketch, np.uint8)
        return np.bitwise_xor.reduce(bits.reshape(-1, length), 0)

    for length in np.unique(short).tolist():
        for some in np.array_split(own := np.flatnonzero(short == length), -(-len(own) * length // kernel.CHUNK_BYTES)):
            x, y = (np.stack([folded(side[i], length) for i in some]) for side in (a, b))
            out[some] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return out


def _chunk_sets(column, size):
    for lo, hi, data, offsets in kernel.chunks(column):
        words = kernel.Words(kernel.LOWER[data], offsets, kernel.NOT_SPACE)
        yield lo, hi, *shingle_sets(words, size)


def _profile(docs: DataFrame, cfg: Settings) -> DataFrame:
    """One pass: rows of kind 0 are documents (id, set size, two digests, their mix, sketch),
    rows of kind 1 are shingles that a task saw repeatedly (hash, occurrences)."""

    def run(batches):
        held, amount = [], 0

        def repeated():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            some = n >= _LOCAL_REPEATS
            none = np.zeros(some.sum(), np.int64)
            return _batch(1, key[some].view(np.int64), n[some], none, none, none, pa.nulls(len(none), pa.binary()))

        for batch in batches:
            for lo, hi, bounds, keys in _chunk_sets(batch.column(1), cfg.words):
                h1, h2 = _digests(bounds, keys)
                yield _batch(0, batch.column(0)[lo:hi], np.diff(bounds), h1.view(np.int64), h2.view(np.int64),
                             (h1 ^ kernel.mix(h2)).view(np.int64), parity_sketches(bounds, keys))
                held.append(keys)
                amount += len(keys)
                if amount > _FLUSH:
                    yield repeated()
                    held, amount = [], 0
        if held:
            yield repeated()

    def _batch(kind, a, n, h1, h2, h, sketch):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int32)), pa.array(a, pa.int64()), pa.array(np.asarray(n, np.int64)),
             pa.array(h1), pa.array(h2), pa.array(h), sketch], names=["kind", "id", "n", "h1", "h2", "h", "sketch"])

    return docs.mapInArrow(run, "kind int, id long, n long, h1 long, h2 long, h long, sketch binary")


class Order:
    """The global shingle order: rising frequency class (0 for shingles not in the list),
    then hash. A shingle's place in it is one uint64, with the class in the top bits."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, total: int, fragments: int):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        self.levels = np.minimum(np.log2(np.maximum(self.counts, 1)).astype(np.uint64) + 1, 63).astype(np.uint64)
        # fragment borders: hashes are uniform inside a class, so equal shares of the total
        mass = np.bincount(self.levels.astype(int), weights=self.counts, minlength=1 << _CLASS_BITS).astype(float)
        mass[0] += max(total - mass.sum(), 0) + 1
        ends = np.cumsum(mass)
        borders = []
        for share in np.arange(1, fragments) * ends[-1] / fragments:
            level = int(np.searchsorted(ends, share))
            inside = (share - (ends[level] - mass[level])) / mass[level]
            borders.append((level << 58) + int(inside * ((1 << 58) - 1)))
        self.borders = np.array(borders, np.uint64)

    def place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the order, frequency known of it) of each hash."""
        level, count = np.zeros(len(hashes), np.uint64), np.zeros(len(hashes), np.int64)
        if len(self.keys):
            row = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            known = self.keys[row] == hashes
            level[known], count[known] = self.levels[row[known]], self.counts[row[known]]
        return (level << np.uint64(64 - _CLASS_BITS)) | (hashes >> np.uint64(_CLASS_BITS)), count


def _ordered(bounds, keys, order):
    """Sets of a chunk sorted by the global order: (bounds, set of each, places, counts)."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place, count = order.place(keys)
    by = np.lexsort((place, owner))
    return owner, place[by], count[by]


_MEMBER = np.dtype([("token", "u8"), ("doc", "u4"), ("at", "u4")])
_DOC = np.dtype([("id", "i8"), ("h", "i8"), ("n", "i4"), ("weight", "f4")])


def _prefixes(docs: DataFrame, shared, cfg: Settings, buckets: int) -> DataFrame:
    """Prefix shingles in packed rows ``(bucket, share, members, docs)``."""

    def run(batches):
        order, seen = shared.value, set()
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, bounds, keys in _chunk_sets(batch.column(1), cfg.words):
                h1, h2 = _digests(bounds, keys)
                n = np.diff(bounds)
                owner, place, count = _ordered(bounds, keys, order)
                at = np.arange(len(place)) - bounds[owner]
                # one document per equal set and task is enough; its class has the others
                first = np.zeros(hi - lo, bool)
                for i, key in enumerate(zip(h1.tolist(), h2.tolist())):
                    if n[i] and ids[lo + i].is_valid and key not in seen:
                        first[i] = True
                        seen.add(key)
                if len(seen) > 1 << 18:
                    seen.clear()
                prefix = n - -(-cfg.percent * n // 100) + 1
                take = first[owner] & (at < prefix[owner])
                sums = np.append(0.0, np.cumsum(np.log1p(count)))
                docs = np.zeros(hi - lo, _DOC)
                docs["id"] = np.asarray(ids[lo:hi].fill_null(0))
                docs["h"] = (h1 ^ kernel.mix(h2)).view(np.int64)
                docs["n"] = n
                docs["weight"] = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(n, 1)
                token, doc = place[take], owner[take]
                mixed = kernel.mix(token)
                bucket = (mixed % np.uint64(buckets)).astype(np.int64)
                shares = 1 + count[take] // cfg.hot
                share = (kernel.mix(docs["h"].view(np.uint64))[doc] % shares.astype(np.uint64)).astype(np.int64)
                share += shares > 1  # share 0 is for the shingles that are in one bucket as a whole
                route = share * buckets + bucket
                by = np.lexsort((doc, route))
                cuts = np.flatnonzero(np.diff(route[by])) + 1
                rows = []
                for part in np.split(by, cuts) if len(by) else []:
                    own, local = np.unique(doc[part], return_inverse=True)
                    member = np.zeros(len(part), _MEMBER)
                    member["token"], member["doc"], member["at"] = token[part], local, at[take][part]
                    r = int(route[part[0]])
                    rows.append((r % buckets, r // buckets, member.tobytes(), docs[own].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                     pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary())],
                    names=["bucket", "share", "members", "docs"])

    return docs.mapInArrow(run, "bucket int, share int, members binary, docs binary")


def _possible(a, b, pa_, pb, percent):
    """May sets of sizes a and b be similar if the shingle at places pa_ and pb is the first
    that they share? A similar pair passes this at its first shared shingle, which lies in
    both prefixes, so pairs that fail it under other shingles are not lost."""
    most = 1 + np.minimum(a - pa_ - 1, b - pb - 1)
    return 100 * most >= percent * (a + b - most)


_GROUP_SCHEMA = "kind int, token long, a long, ah long, b long, bh long, n long, at long, weight double"


def _groups(packed: DataFrame, cfg: Settings) -> DataFrame:
    """Rows of kind 0: candidate pairs (a, b). Of crowded shingles also rows of kind 1: each
    member (token, a = id, n, at), and of kind 2: the hub of a share of a hot shingle."""

    def run(key, table):
        docs, members = [], []
        base = 0
        for d, m in zip(table.column("docs").to_pylist(), table.column("members").to_pylist()):
            d, m = np.frombuffer(d, _DOC), np.frombuffer(m, _MEMBER).copy()
            m["doc"] += base
            base += len(d)
            docs.append(d)
            members.append(m)
        docs, members = np.concatenate(docs), np.concatenate(members)
        # equal sets from different tasks: the one with the smallest id stands for them
        order = np.lexsort((docs["id"], docs["n"], docs["h"]))
        same = np.append(False, (docs["h"][order][1:] == docs["h"][order][:-1]) & (docs["n"][order][1:] == docs["n"][order][:-1]))
        stand = np.zeros(len(docs), np.int64)
        stand[order] = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        m = members.copy()
        m["doc"] = stand[members["doc"]]
        m = m[np.lexsort((m["at"], m["doc"], m["token"]))]
        new = np.append(True, (m["token"][1:] != m["token"][:-1]) | (m["doc"][1:] != m["doc"][:-1]))
        m = m[new]
        first = np.flatnonzero(np.append(True, m["token"][1:] != m["token"][:-1]))
        size = np.diff(np.append(first, len(m)))
        hot_share = key[1].as_py() > 0
        pairs, crowd, hubs = [], [], []
        for n in range(2, cfg.crowd + 1):
            at = first[size == n]
            for i in range(n):
                for j in range(i + 1, n):
                    pairs.append((at + i, at + j))
        ids = docs["id"][m["doc"]]
        weight = docs["weight"][m["doc"]]
        for f, n in zip(first.tolist(), size.tolist()):
            if n > cfg.crowd or hot_share:
                own = np.arange(f, f + n)
                hub = own[np.lexsort((ids[own], -weight[own]))[0]]
                rest = own[own != hub]
                pairs.append((np.full(len(rest), hub), rest))
                crowd.append(own)
                hubs.append(hub)
        x, y = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (list(z) for z in (zip(*pairs) if pairs else ((), ()))))
        dx, dy = m["doc"][x], m["doc"][y]
        ok = _possible(docs["n"][dx].astype(np.int64), docs["n"][dy].astype(np.int64),
                       m["at"][x].astype(np.int64), m["at"][y].astype(np.int64), cfg.percent) & (docs["id"][dx] != docs["id"][dy])
        dx, dy = dx[ok], dy[ok]
        # a pair that several shingles of the bucket propose counts once
        if len(dx):
            once = np.unique(dx.astype(np.int64) * len(docs) + dy)
            dx, dy = once // len(docs), once % len(docs)
        rows = [_pack(0, np.zeros(len(dx), np.int64), docs, dx, docs, dy, np.zeros(len(dx), np.int64))]
        for kind, rows_at in ((1, np.concatenate(crowd) if crowd else np.zeros(0, np.int64)), (2, np.array(hubs, np.int64))):
            own = m["doc"][rows_at]
            rows.append(_pack(kind, m["token"][rows_at].view(np.int64), docs, own, docs, own, m["at"][rows_at].astype(np.int64)))
        return pa.Table.from_batches(rows)

    def _pack(kind, token, da, ia, db, ib, at):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ia), kind, np.int32)), pa.array(token), pa.array(da["id"][ia]), pa.array(da["h"][ia]),
             pa.array(db["id"][ib]), pa.array(db["h"][ib]), pa.array(da["n"][ia].astype(np.int64)), pa.array(at),
             pa.array(da["weight"][ia].astype(np.float64))],
            names=["kind", "token", "a", "ah", "b", "bh", "n", "at", "weight"])

    return packed.groupBy("bucket", "share").applyInArrow(run, _GROUP_SCHEMA)


def _hub_pairs(groups: DataFrame) -> DataFrame:
    """The hubs of a shingle's shares, each with the first of them."""
    hubs = groups.filter("kind = 2")
    best = hubs.groupBy("token").agg(
        F.min(F.struct((-F.col("weight")).alias("w"), "a", "ah")).alias("best"), F.count("*").alias("shares")
    ).filter("shares > 1")
    return hubs.join(best, "token").select("best.a", "best.ah", F.col("a").alias("b"), F.col("ah").alias("bh")).filter("a <> b")


def _shares(pairs: DataFrame, cfg: Settings) -> tuple[DataFrame, DataFrame]:
    """``pairs`` with the share of its hub that each falls into, and the shares of each hub."""
    many = pairs.groupBy("a", "ah").agg(F.ceil(F.count("*") / cfg.block).alias("shares"))
    dealt = pairs.join(many, ["a", "ah"]).withColumn("share", F.pmod(F.xxhash64("b", "bh"), F.col("shares")).cast("int"))
    return dealt, many.select("a", "ah", F.explode(F.sequence(F.lit(0), (F.col("shares") - 1).cast("int"))).alias("share"))


def _near(pairs: DataFrame, sketches: DataFrame, cfg: Settings) -> DataFrame:
    """``pairs`` without those whose parity sketches differ too much for the similarity."""
    dealt, hubs = _shares(materialize(pairs.select("a", "ah", "b", "bh").distinct()), cfg)
    side = {x: sketches.select(F.col("id").alias(x), F.col("h").alias(f"{x}h"), F.col("n").alias(f"{x}n"),
                               F.col("sketch").alias(f"{x}s")) for x in "ab"}
    both = dealt.join(side["b"], ["b", "bh"]).join(hubs.join(side["a"], ["a", "ah"]), ["a", "ah", "share"])

    def run(batches):
        for batch in batches:
            # 100 * common >= percent * all, for sets that differ in ``apart`` shingles
            apart = _distance(batch.column("as").to_pylist(), batch.column("bs").to_pylist())
            total = batch.column("an").to_numpy() + batch.column("bn").to_numpy()
            yield batch.select(["a", "ah", "b", "bh"]).filter(
                pa.array((100 + cfg.percent) * apart <= (100 - cfg.percent) * total))

    return both.select("a", "ah", "b", "bh", "an", "as", "bn", "bs").mapInArrow(run, "a long, ah long, b long, bh long")


def _verify(docs: DataFrame, pairs: DataFrame, sketches: DataFrame, shared, cfg: Settings, buckets: int) -> DataFrame:
    """The linked ones of ``pairs (a, ah, b, bh)``, as ``(a, b)``.

    Each pair is worked on in its hub's share; a document's fragments go to every share it
    has a pair in. Fragments count separately, the sum decides."""
    dealt, hubs = _shares(materialize(_near(pairs, sketches, cfg)), cfg)
    target = F.struct("a", "ah", "share", "h", "hub")
    hub = hubs.select(F.col("a").alias("doc_id"), "a", "ah", "share", F.col("ah").alias("h"), F.lit(True).alias("hub"))
    partner = dealt.select(F.col("b").alias("doc_id"), "a", "ah", "share", F.col("bh").alias("h"), F.lit(False).alias("hub"))
    wanted = materialize(hub.unionAll(partner).groupBy("doc_id").agg(F.collect_list(target).alias("targets")))
    # most texts are in no pair and stay out of the join
    near, _ = split_by_slot(docs.select("doc_id", "text"), F.xxhash64("doc_id"), wanted, F.xxhash64("doc_id"), cfg.slots)
    rows = near.join(wanted, "doc_id").select("doc_id", "text", "targets")

    def cut(batches):
        order = shared.value
        for batch in batches:
            for lo, hi, bounds, keys in _chunk_sets(batch.column(1), cfg.words):
                h1, h2 = _digests(bounds, keys)
                h = (h1 ^ kernel.mix(h2)).view(np.int64)
                _, place, _ = _ordered(bounds, keys, order)
                out = []
                for i, targets in enumerate(batch.column(2)[lo:hi].to_pylist()):
                    own = place[bounds[i] : bounds[i + 1]]
                    parts = np.split(own, np.searchsorted(own, order.borders, "right"))
                    for t in targets:
                        if t["h"] == h[i]:
                            g = hash((t["a"], t["ah"], t["share"]))
                            for f, part in enumerate(parts):
                                if len(part) or f == 0:
                                    out.append((g % buckets, f, t["a"], t["ah"], t["share"], t["hub"], batch.column(0)[lo + i].as_py(), int(h[i]), len(own), part.tobytes()))
                for s in range(0, len(out), 20_000):
                    columns = list(zip(*out[s : s + 20_000]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, cut_type)], schema=cut_type)

    cut_schema = "bucket int, fragment int, a long, ah long, share int, hub boolean, b long, bh long, n long, keys binary"
    cut_type = pa.schema([("bucket", pa.int32()), ("fragment", pa.int32()), ("a", pa.int64()), ("ah", pa.int64()), ("share", pa.int32()),
                          ("hub", pa.bool_()), ("b", pa.int64()), ("bh", pa.int64()), ("n", pa.int64()), ("keys", pa.binary())])

    def count(table):
        col = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("a", "ah", "share", "hub", "b", "bh", "n")}
        blobs = table.column("keys").combine_chunks()
        blobs = blobs.chunk(0) if isinstance(blobs, pa.ChunkedArray) else blobs
        data, offsets = kernel.text_bytes(pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(blobs), blobs.cast(pa.large_binary()).buffers()).view(pa.large_string()))
        keys = np.frombuffer(data.tobytes(), np.uint64)
        size = np.diff(offsets) // 8
        group = kernel.mix(col["a"].view(np.uint64) ^ kernel.mix(col["ah"].view(np.uint64) + col["share"].astype(np.uint64)))
        tagged = kernel.mix(keys + np.repeat(group, size) * np.uint64(3))
        is_hub = np.repeat(col["hub"], size)
        hub_keys = np.unique(tagged[is_hub])
        part = np.zeros(len(size), np.int64)
        if len(hub_keys):
            row = np.minimum(np.searchsorted(hub_keys, tagged), len(hub_keys) - 1)
            sums = np.append(0, np.cumsum(hub_keys[row] == tagged))
            ends = np.cumsum(size)
            part = sums[ends] - sums[ends - size]
        # a hub's row carries its size; its own overlap is not a pair
        keep = np.arange(len(size))
        return pa.table({k: pa.array(v[keep]) for k, v in (("a", col["a"]), ("ah", col["ah"]), ("share", col["share"]), ("hub", col["hub"]), ("b", col["b"]), ("bh", col["bh"]), ("n", col["n"]), ("part", part))})

    parts = rows.mapInArrow(cut, cut_schema).groupBy("bucket", "fragment").applyInArrow(
        count, "a long, ah long, share int, hub boolean, b long, bh long, n long, part long")
    summed = parts.groupBy("a", "ah", "share", "hub", "b", "bh").agg(F.max("n").alias("n"), F.sum("part").alias("common"))
    summed = materialize(summed)
    hubs = summed.filter("hub").select("a", "ah", F.col("n").alias("na")).groupBy("a", "ah").agg(F.max("na").alias("na"))
    return (
        summed.filter("not hub").join(hubs, ["a", "ah"])
        .filter(100 * F.col("common") >= cfg.percent * (F.col("na") + F.col("n") - F.col("common")))
        .select("a", "b")
    )


def _second_round(groups: DataFrame, nodes: DataFrame, cfg: Settings) -> DataFrame:
    """Pairs of members of a crowded shingle that are still in different components."""
    members = groups.filter("kind = 1").select("token", "a", "ah", "n", "at")
    members = members.join(nodes, members.a == nodes.node, "left").select(
        "token", "a", "ah", "n", "at", F.coalesce("component", "a").alias("component"))
    members = materialize(members)
    sizes = members.groupBy("token", "component").agg(F.count("*").alias("m"))
    split = sizes.groupBy("token").agg(
        F.max(F.struct("m", "component"))["component"].alias("major"), F.sum("m").alias("size"), F.count("*").alias("parts")
    ).filter("parts > 1")
    rows = members.join(split, "token").withColumn("blocks", F.ceil(F.col("size") / cfg.block).cast("int"))
    all_rows = rows.withColumn("block", F.pmod(F.xxhash64("a", "ah"), F.col("blocks")).cast("int")).withColumn("minor", F.lit(False))
    minor = rows.filter("component <> major").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("minor", F.lit(True))
    columns = ["token", "block", "minor", "a", "ah", "n", "at", "component"]

    def pair(table):
        col = {c: table.column(c).to_numpy(zero_copy_only=False) for c in columns}
        some, rest = np.flatnonzero(col["minor"]), np.flatnonzero(~col["minor"])
        out = []
        for i in some:
            ok = rest[col["component"][rest] != col["component"][i]]
            ok = ok[_possible(col["n"][i], col["n"][ok], col["at"][i], col["at"][ok], cfg.percent)]
            a_first = col["a"][ok] < col["a"][i]
            out.append(np.stack([np.where(a_first, col["a"][ok], col["a"][i]), np.where(a_first, col["ah"][ok], col["ah"][i]),
                                 np.where(a_first, col["a"][i], col["a"][ok]), np.where(a_first, col["ah"][i], col["ah"][ok])]))
        found = np.concatenate(out, 1) if out else np.zeros((4, 0), np.int64)
        return pa.table({c: pa.array(x) for c, x in zip(("a", "ah", "b", "bh"), found)})

    return all_rows.select(*columns).unionAll(minor.select(*columns)).groupBy("token", "block").applyInArrow(
        pair, "a long, ah long, b long, bh long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cfg: Settings = Settings()) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    profile = materialize(_profile(docs, cfg))
    sets = profile.filter("kind = 0").select(F.col("id").alias("doc_id"), "n", "h1", "h2")
    sketches = materialize(
        profile.filter("kind = 0 and n > 0 and id is not null").groupBy("id", "h")
        .agg(F.max("n").alias("n"), F.first("sketch").alias("sketch")))
    total = sets.agg(F.sum("n"), F.count("*")).first()
    frequent = (
        profile.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "id").limit(cfg.frequent).toPandas()
    )
    order = Order(frequent["id"].to_numpy(np.int64).view(np.uint64), frequent["n"].to_numpy(np.int64), int(total[0] or 0), cfg.fragments)
    shared = spark.sparkContext.broadcast(order)
    buckets = max(8, int(total[0] or 0) // 1_500_000)

    groups = materialize(_groups(_prefixes(docs, shared, cfg, buckets), cfg))
    pairs = groups.filter("kind = 0").select("a", "ah", "b", "bh").unionByName(_hub_pairs(groups))
    links = materialize(_verify(docs, pairs, sketches, shared, cfg, buckets))

    # equal sets are one class, and repeated rows of an id are one document
    same = sets.filter("n > 0 and doc_id is not null").groupBy("n", "h1", "h2").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("m"))
    members = sets.filter("n > 0 and doc_id is not null").join(same.filter("m > 1"), ["n", "h1", "h2"])
    equal = materialize(members.filter("doc_id <> first").select(F.col("first").alias("u"), F.col("doc_id").alias("v")))

    def edges(links):
        return links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(equal)

    nodes = components(edges(links))
    if not groups.filter("kind = 1").isEmpty():
        more = _verify(docs, _second_round(groups, nodes, cfg), sketches, shared, cfg, buckets)
        extra = more.select(F.col("a").alias("u"), F.col("b").alias("v"))
        known = nodes.select(F.col("node").alias("u"), F.col("component").alias("v"))
        nodes = components(known.unionAll(extra))
    return sets.join(nodes, sets.doc_id == nodes.node, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cfg: Settings = Settings()) -> DataFrame:
    """``docs`` without the documents that have a smaller id in their component."""
    marked = materialize(classes(docs, id_col, text_col, cfg))
    drop = materialize(marked.filter("component_id <> doc_id").select("doc_id").distinct())
    near, far = split_by_slot(docs, F.xxhash64(F.col(id_col).cast("long")), drop, F.xxhash64("doc_id"), cfg.slots)
    drop = drop.withColumnRenamed("doc_id", "__drop")
    near = near.join(drop, near[id_col].cast("long") == drop["__drop"], "left_anti")
    return near.select(*docs.columns).unionAll(far.select(*docs.columns))
