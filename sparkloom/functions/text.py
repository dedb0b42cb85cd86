"""Column builders for document lines and tokenisers.

All of them are built-in Spark expressions (whole-stage codegen, no Python workers), but for
:func:`letter_words`, which Arrow kernels call on the texts they count.
Character classes are written out explicitly so Java regex (Spark) and RE2 (DuckDB)
agree; ``\\p{L}``/``\\p{N}`` stand in for Python's Unicode ``\\w``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the surveyed jobs for equal results):
# characters stripped from both ends of a token by the topic-model word count
EDGE_CHARS = ".,<>()-[]:;?!"
# characters stripped from both ends of a token when building topic-model counts
# (Python's string.punctuation)
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# a raw token counts as a word when it contains a letter followed by word characters
WORD_PATTERN = r"[A-Za-z][\p{L}\p{N}_]+"
# the characters Python's str.split() treats as whitespace
PY_WHITESPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _class(chars: str) -> str:
    """A regex character class matching exactly ``chars``."""
    escaped = "".join("\\" + c if c in "\\]^-[" else c for c in chars)
    return "[" + escaped + "]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def doc_id_of_line(line: Column | str) -> Column:
    """Text between the first ``id="`` and the following ``" url=`` ('' when absent)."""
    return F.regexp_extract(_col(line), r'id="(.*?)" url=', 1)


def _python_slice(v: Column, start0: Column, end0: Column) -> Column:
    """``v[start0:end0]`` with Python semantics for the index value -1 (= last char)."""
    n = F.length(v)
    s = F.when(start0 < 0, F.greatest(n + start0, F.lit(0))).otherwise(start0)
    e = F.when(end0 < 0, F.greatest(n + end0, F.lit(0))).otherwise(end0)
    return F.substr(v, s + 1, F.greatest(e - s, F.lit(0)))


def body_of_line(line: Column | str) -> Column:
    """Everything after the first ``">``, minus the last six characters (``</doc>``).

    NULL when the line has no ``">`` (the surveyed job fails on such a line).
    """
    v = _col(line)
    p = F.instr(v, '">')
    return F.when(p > 0, F.substr(v, p + 2, F.greatest(F.length(v) - p - 1 - 6, F.lit(0))))


def header_of_line(line: Column | str) -> Column:
    """The first ``<…>`` tag of the line, '' when there is none."""
    return F.regexp_extract(_col(line), "(<[^>]+>)", 1)


def body_from_first_gt(line: Column | str) -> Column:
    """``line[find('>') : find('</doc>')]``: from the first ``>`` (kept) up to ``</doc>``.

    A missing marker is index -1, which Python slicing reads as the last character.
    """
    v = _col(line)
    return _python_slice(v, F.instr(v, ">") - 1, F.instr(v, "</doc>") - 1)


def strip_tags(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), "<[^>]+>", "")


def valid_doc_line(line: Column | str) -> Column:
    v = _col(line)
    return v.contains("id") & v.contains("url=")


def tokens_letters(text: Column | str) -> Column:
    """Non-letters to space, lower case, split on whitespace: ``array<string>``."""
    spaced = F.lower(F.regexp_replace(_col(text), "[^a-zA-Z]+", " "))
    return F.array_remove(F.split(spaced, " "), "")


_LOWER = np.array([c | 32 if chr(c).isalpha() and c < 128 else 0 for c in range(256)], np.uint8)


def letter_words(texts: pa.Array) -> pa.ListArray:
    """:func:`tokens_letters` of an Arrow batch of texts, on their UTF-8 bytes (no byte of a longer
    character is a letter); a NULL has no words."""
    texts = texts.cast(pa.string()).fill_null("")
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    lower = _LOWER[np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]]
    ends = ends - ends[0]
    letter = lower != 0
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    begin = ends[:-1][ends[:-1] < len(lower)]
    first[begin] = letter[begin]  # no word crosses texts
    at = np.flatnonzero(first)
    packed = lower[letter]
    starts = np.append(np.cumsum(letter, dtype=np.int32)[at] - 1, len(packed)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(starts), pa.py_buffer(packed))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(at, ends), pa.int32()), words)


def single_space_words(texts: pa.Array) -> pa.ListArray:
    """:func:`tokens_single_space` of an Arrow batch of texts, dictionary-encoded; a NULL has one
    empty token. The per-token rules below give for one of these tokens what they give for it in
    its text. So a token that ends with a line break keeps the space after it, unless it is the last
    of its text: ``$`` of a regex matches before a break that ends the text."""
    words = pc.split_pattern(texts.cast(pa.string()).fill_null(""), " ")
    coded = words.flatten().dictionary_encode()
    broken = np.asarray(pc.match_substring_regex(coded.dictionary, r"[\n\r\x{85}\x{2028}\x{2029}]\z"))
    if broken.any():
        inside = broken[np.asarray(coded.indices)]
        ends = np.cumsum(np.asarray(words.value_lengths()))
        inside[ends - 1] = False
        flat = coded.cast(pa.string())
        coded = pc.if_else(pa.array(inside), pc.binary_join_element_wise(flat, pa.scalar(""), " "), flat).dictionary_encode()
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.asarray(words.value_lengths()))), pa.int32()), coded)


# Whole-text forms of per-token rules: one regex pass over a document instead of one per
# token, and no lambda variables, so equal tokenisers give equal (reusable) plans.
_WS = PY_WHITESPACE
_NOT_WS = "[^" + PY_WHITESPACE[1:]


def tokens_stripped(text: Column | str, edge_chars: str = EDGE_CHARS, min_len: int = 2) -> Column:
    """Whitespace split, lower, strip ``edge_chars`` at both ends, keep length >= min_len."""
    cls = _class(edge_chars)
    t = F.lower(_col(text))
    t = F.regexp_replace(t, f"(?<=^|{_WS}){cls}+|{cls}+(?={_WS}|$)", "")
    if min_len > 1:
        t = F.regexp_replace(t, f"(?<=^|{_WS}){_NOT_WS}{{1,{min_len - 1}}}(?={_WS}|$)", "")
    return F.array_remove(F.split(t, _WS + "+"), "")


def tokens_whitespace(text: Column | str) -> Column:
    """Whitespace split, nothing else: the raw tokens of :func:`tokens_stripped`."""
    return F.split(_col(text), _WS + "+")


def stripped_token(token: Column, edge_chars: str = EDGE_CHARS, min_len: int = 2) -> Column:
    """The word that :func:`tokens_stripped` makes of one raw token, NULL when it drops it."""
    word = F.btrim(F.lower(token), F.lit(edge_chars))
    return F.when(F.length(word) >= max(min_len, 1), word)


def tokens_single_space(text: Column | str) -> Column:
    """Split on one space, keeping empty strings and case."""
    return F.split(_col(text), " ", -1)


def topic_tokens(text: Column | str) -> Column:
    """Tokens kept by the topic model's per-document counts (before the vocabulary join).

    Split on single spaces; a raw token must contain ``WORD_PATTERN``; it is lower-cased
    and stripped of ASCII punctuation at both ends, and must then be longer than 2.
    """
    cls = _class(ASCII_PUNCTUATION)
    t = F.regexp_replace(_col(text), f"(?<=^| )(?![^ ]*{WORD_PATTERN[:-1]})[^ ]+", "")
    t = F.lower(t)
    t = F.regexp_replace(t, f"(?<=^| ){cls}+|{cls}+(?= |$)", "")
    t = F.regexp_replace(t, "(?<=^| )[^ ]{1,2}(?= |$)", "")
    return F.array_remove(F.split(t, " ", -1), "")


def label_from_id(doc_id: Column | str, token: str = "AU", positive: int = 1, negative: int = 0) -> Column:
    """Class label: ``positive`` when the id contains ``token``, else ``negative``."""
    return F.when(_col(doc_id).contains(token), F.lit(positive)).otherwise(F.lit(negative))


def hour_text(ts: Column | str) -> Column:
    """Two-digit hour of a timestamp, as the text '00'..'23'."""
    return F.date_format(_col(ts), "HH")


def hour_of_datetime_text(value: Column | str) -> Column:
    """Hour field of a ``yyyy-MM-dd HH:mm:ss`` string, kept as text ('09')."""
    return F.get(F.split(F.get(F.split(_col(value), " ", -1), 1), ":", -1), 0)


def cluster_of_assignment(line: Column | str) -> Column:
    return F.regexp_extract(_col(line), r"^\((-?[0-9]+),", 1).try_cast("int")


def newsgroup_of_assignment(line: Column | str) -> Column:
    return F.regexp_extract(_col(line), r"20_newsgroups/([^/]+)/", 1)


def doc_of_assignment(line: Column | str) -> Column:
    return F.regexp_extract(_col(line), r'20_newsgroups/[^/]+/([^"]*)"', 1)
