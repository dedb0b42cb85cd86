"""Plain-Python statements of the contracts, for comparison with the operators."""

from __future__ import annotations

import hashlib
import re

import duckdb

SF = "/root/testdata/sf0.001"
NASTY = [None, "", " ", "\n\n", "a", "x" * 5000, "\x00 null \x00 byte", "ünï cödé 漢字 🙂 text", "word " * 3000, "\t\x0b\x0c\r"]


def table(name, sf=SF, columns="*"):
    return duckdb.sql(f"select {columns} from '{sf}/{name}.parquet'").fetchall()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
