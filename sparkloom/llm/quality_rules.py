"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger row holds the raw measurements and
one long ``fail_bits`` in which bit i says that rule i failed. Policies are versioned masks
over those bits: applying or changing one, and asking what each rule contributes, reads only
the ledger and never a text again.

Empty and edge input: a NULL or empty text has no words, so all measurements are 0 and it
fails ``few_words``; every row is answered on its own, so ties and repeats need no rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import kernel

REPEAT_WINDOW = 8
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
UPPER = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
LETTER = UPPER | ((np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A)) | (np.arange(256) >= 0xC0)
CONTINUATION = (np.arange(256) & 0xC0) == 0x80

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_letters", "n_upper", "n_exclaim",
)


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the measurement columns."""

    name: str
    fails: str  # SQL over the measurements


@dataclass(frozen=True)
class Policy:
    """A versioned set of rule names; a document is kept when none of them failed."""

    name: str
    version: int
    rules: tuple[str, ...]


# The order fixes the bits, so new rules go to the end.
RULES: tuple[Rule, ...] = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbol_heavy", "100 * n_symbols > 25 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("few_letters", "100 * n_letters < 60 * word_chars"),
    Rule("shouting", "100 * n_upper > 50 * n_letters AND n_letters > 0"),
    Rule("exclaiming", "100 * n_exclaim > 30 * n_words"),
)
BASE = Policy("base", 1, ("few_words", "repeated_words"))
DEFAULT = Policy("default", 1, tuple(r.name for r in RULES))


def _repeat_words(words: kernel.Words, size: int) -> np.ndarray:
    """Per text: words inside a window of ``size`` words that occurs twice or more in it."""
    out = np.zeros(len(words.counts), np.int64)
    if not len(words.starts):
        return out
    at, key = words.windows(words.hashes(), size)
    if not len(at):
        return out
    text = words.text[at]
    order = np.lexsort((key, text))
    same = (key[order][1:] == key[order][:-1]) & (text[order][1:] == text[order][:-1])
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    hit = at[order[again]]
    # equal hashes are confirmed on the words themselves, group by group
    groups = np.cumsum(~np.append(False, same))[again]
    confirmed = []
    for run in np.split(hit, np.flatnonzero(np.diff(groups)) + 1) if len(hit) else []:
        seen: dict[bytes, list[int]] = {}
        for i in run.tolist():
            seen.setdefault(words.joined(i, size), []).append(i)
        confirmed += [i for same_words in seen.values() if len(same_words) > 1 for i in same_words]
    if confirmed:
        starts = np.array(confirmed)
        mask = kernel.covered(len(words.starts), starts, starts + size)
        np.add.at(out, words.text[mask], 1)
    return out


def _line_counts(text: bytes) -> tuple[int, int]:
    """(lines with a word, those of them equal to an earlier line)."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    return len(lines), len(lines) - len(set(lines))


def _measure(column: pa.Array) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {m: [] for m in MEASURES}

    def add(name, values):
        parts[name].append(np.asarray(values, np.int64))

    for _, _, data, offsets in kernel.chunks(column):
        words = kernel.Words(data, offsets, kernel.NOT_SPACE)
        n = len(offsets) - 1

        def per_text(mask, offsets=offsets):
            total = np.append(0, np.cumsum(mask, dtype=np.int64))
            return total[offsets[1:]] - total[offsets[:-1]]

        lines = [_line_counts(data[offsets[i] : offsets[i + 1]].tobytes()) for i in range(n)]
        add("n_words", words.counts)
        add("word_chars", per_text(kernel.NOT_SPACE[data] & ~CONTINUATION[data]))
        add("n_symbols", per_text(SYMBOLS[data]))
        add("n_dup_lines", [d for _, d in lines])
        add("n_repeat_words", _repeat_words(words, REPEAT_WINDOW))
        add("n_lines", [a for a, _ in lines])
        add("n_letters", per_text(LETTER[data]))
        add("n_upper", per_text(UPPER[data]))
        add("n_exclaim", per_text(data == 0x21))
    return {m: np.concatenate(v) if v else np.zeros(0, np.int64) for m, v in parts.items()}


def measure(docs: DataFrame, text_col: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The carried columns and one long column per measurement; one pass over the texts."""
    rows = docs.select(*carry, F.col(text_col).alias("__text"))
    n = len(carry)

    def run(batches):
        for batch in batches:
            found = _measure(batch.column(n))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], *(pa.array(found[m]) for m in MEASURES)],
                names=[*batch.schema.names[:n], *MEASURES],
            )

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:n]] + [f"{m} long" for m in MEASURES])
    return rows.mapInArrow(run, schema)


def with_fail_bits(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger: ``measured`` with ``fail_bits``, bit i set where ``rules[i]`` failed."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits)


def mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    """The policy's rules as a bit mask; an unknown rule name is an error."""
    names = [r.name for r in rules]
    return sum(1 << names.index(r) for r in set(policy.rules))


def fails(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) != 0


def ablation(ledger: DataFrame, policies: Sequence[Policy], rules: Sequence[Rule] = RULES) -> DataFrame:
    """What each rule does in each policy, from the counts of the distinct bit patterns.

    One row per (policy, version, rule): documents that fail the rule, documents that only
    this rule rejects (kept without it), and the policy's rejected and total documents. The
    shuffle carries one row per task and bit pattern, of which there are few.
    """
    patterns = ledger.groupBy("fail_bits").agg(F.count("*").alias("n"))
    names = [r.name for r in rules]
    # the handful of (policy, rule) pairs written in the code, beside every bit pattern
    pairs = F.array(*[
        F.struct(
            F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
            F.lit(1 << names.index(r)).cast("long").alias("bit"), F.lit(mask(p, rules)).cast("long").alias("mask"),
        )
        for p in policies for r in p.rules
    ])
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))

    def count(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return (
        patterns.select("fail_bits", "n", F.inline(pairs))
        .groupBy("policy", "version", "rule")
        .agg(
            count(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
            count(failed == F.col("bit")).alias("only_this_rule"),
            count(failed != 0).alias("rejected"),
            F.sum("n").alias("documents"),
        )
    )
