"""Fill-in-middle transformation over indexable skip lists.

A text is a list of units (letter runs, and every other code point by itself). Two ranks drawn
from a hash of the document's id cut it into prefix, middle and suffix, which are written in
prefix-suffix-middle or suffix-prefix-middle form behind sentinels. :class:`SkipLists` holds the
units of every text of a chunk: the base lane has a node per unit, each express lane above it
the first of every ``FANOUT`` nodes, and a link carries the units and the code points it spans.
A cut descends from the top lane by accumulated units; it arrives at the byte where the unit of
that rank starts and has summed the code points before it on the way, so a text is never walked.

Whole texts are used, whatever their length; a chunk holds bounded bytes, or one text. Rows are
independent: no shuffle, no broadcast, nothing on the driver.

Defined results: a NULL text counts as empty; an empty text has 0 units and stays plain; a NULL
id is hashed as an empty one; repeated rows give repeated results; an empty table gives an
empty one; a table that already has one of the ``fim_`` columns is refused by name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import kernel
from sparkloom.llm.tables import extended, refuse_clash

SENTINELS = ("<P>", "<S>", "<M>")
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100: draws that leave a text plain, draws in spm form
FANOUT = 16
COLUMNS = {"fim_form": "string", "fim_units": "long", "fim_prefix_chars": "long", "fim_middle_chars": "long", "fim_text": "string"}

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


class SkipLists:
    """One indexable skip list per text: ``bounds[i]:bounds[i + 1]`` are its base nodes,
    ``chars`` the code points of each. ``find`` answers one rank per text."""

    def __init__(self, bounds: np.ndarray, chars: np.ndarray):
        self.lanes = [(bounds, np.ones(len(chars), np.int64), chars)]
        while len(bounds) > 1 and np.diff(bounds).max() > FANOUT:
            below, units, chars = self.lanes[-1]
            count = -(-np.diff(below) // FANOUT)
            bounds = np.append(0, np.cumsum(count))
            place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], count)
            first = np.repeat(below[:-1], count) + FANOUT * place
            self.lanes.append((bounds, np.add.reduceat(units, first), np.add.reduceat(chars, first)))

    def find(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(base node that starts after ``ranks[i]`` units of text i, code points before it)."""
        place = np.zeros(len(ranks), np.int64)  # of the current node in its list and lane
        units, chars = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for bounds, unit_width, char_width in reversed(self.lanes):
            size = np.diff(bounds)
            place = np.minimum(place * FANOUT, size)
            for _ in range(FANOUT):
                active = np.flatnonzero(place < size)
                node = bounds[active] + place[active]
                step = units[active] + unit_width[node] <= ranks[active]
                active, node = active[step], node[step]
                if not len(active):
                    break
                units[active] += unit_width[node]
                chars[active] += char_width[node]
                place[active] += 1
        return self.lanes[0][0][:-1] + place, chars


def units_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte of each unit, nodes per text as bounds, code points of each unit)."""
    letter, lead = _LETTER[data], (data & 0xC0) != 0x80
    start = lead.copy()
    start[1:] &= ~(letter[1:] & letter[:-1])
    start[offsets[:-1][np.diff(offsets) > 0]] = True  # texts lie side by side
    starts = np.flatnonzero(start)
    points = np.append(np.add.reduceat(lead, starts, dtype=np.int64) if len(starts) else [], []).astype(np.int64)
    return starts, np.searchsorted(starts, offsets), points


def _cut(batch: pa.RecordBatch, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray, draws: list[np.ndarray], forms: list[str]):
    starts, bounds, chars = units_of(data, offsets)
    lists, n = SkipLists(bounds, chars), np.diff(bounds)
    ranks = np.sort(np.stack([draws[0][lo:hi] % (n + 1), draws[1][lo:hi] % (n + 1)]), axis=0)
    (first, before), (last, within) = lists.find(ranks[0]), lists.find(ranks[1])
    starts = np.append(starts, len(data))
    # a cut after the last unit of a text is its end; the next node is another text's
    at = [np.where(node < bounds[1:], starts[node], offsets[1:]) for node in (first, last)]
    raw, p, s, m = data.tobytes(), *(x.encode() for x in SENTINELS)
    out, plain = [], np.zeros(hi - lo, bool)
    for i, (a, b, c, d) in enumerate(zip(offsets.tolist(), at[0].tolist(), at[1].tolist(), offsets[1:].tolist())):
        form = forms[lo + i]
        if form == "psm":
            out.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
        elif form == "spm":
            out.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
        else:
            plain[i] = True
            out.append(raw[a:d])
    return [pa.array(forms[lo:hi], pa.string()), pa.array(n, pa.int64()), pa.array(before, pa.int64(), mask=plain),
            pa.array(within - before, pa.int64(), mask=plain), pa.array(out, pa.binary()).view(pa.string())]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``fim_form`` (plain, psm or spm), ``fim_units``, the code points of prefix
    and middle (NULL if plain) and ``fim_text``, the text in its form."""
    refuse_clash(docs, *COLUMNS, "__form", "__h1", "__h2", "__text")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    plain = (text == "") | (h[2] % 100 >= PLAIN_FROM)
    for mark in SENTINELS:
        plain |= text.contains(mark)
    form = F.when(plain, "plain").when(h[3] % 100 < SPM_BELOW, "spm").otherwise("psm")
    # text first: the kernel finds its columns by place, other columns pass through
    rows = docs.select(text.alias("__text"), form.alias("__form"), h[0].alias("__h1"), h[1].alias("__h2"), "*")
    schema = extended(docs.schema, **COLUMNS)

    def run(batches):
        for batch in batches:
            forms = batch.column(1).to_pylist()
            draws = [batch.column(i).to_numpy() for i in (2, 3)]
            for lo, hi, data, offsets in kernel.chunks(batch.column(0)):
                kept = [batch.column(i)[lo:hi] for i in range(4, batch.num_columns)]
                made = _cut(batch, lo, hi, data, offsets, draws, forms)
                yield pa.RecordBatch.from_arrays(kept + made, names=schema.names)

    return rows.mapInArrow(run, schema)


def restore(text: Column, form: Column) -> Column:
    """The original text from a transformed one. A transformed text holds each sentinel once:
    texts that contain one stay plain, and no cut can make one, since only its first character
    may be the ``<`` that a sentinel starts with."""
    parts = F.split(text, "|".join(SENTINELS), -1)  # empty, then the parts in their order
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(text)
    )
