"""Document-line parsing (P1-P5, F5), tokenisers (P6-P8), labels (P11), assignments (P14),
and the file readers/writers (S1-S11) on hand-written fixtures, each checked against a
plain-Python statement of the same rule."""

from __future__ import annotations

import glob
import os
import re

import pytest
from fixture_files import fixture_path
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.sources import files


def _lines(name):
    with open(fixture_path(name), encoding="utf-8") as fh:
        return fh.read().splitlines()


def test_wiki_line_parsing(spark):
    parsed = files.read_wiki_pages(spark, fixture_path("pages.txt")).collect()
    got = {r["doc_id"]: r["text"] for r in parsed}
    assert len(parsed) == 7
    assert got["101"] == "Hello World, hello SPARK spark spark!"
    assert got["102"] == "Caf\u00e9 cr\u00e8me: na\u00efve r\u00e9sum\u00e9 42 times"
    assert got["103"] == ""
    assert got["104"] == "12345 !!! ???"
    assert got["105"] == 'a "quoted">inside body'
    assert got["106"] == "no closing ta"  # the last six characters go, whatever they are
    assert got["AU107"] == "Repeated repeated REPEATED words words"


def test_header_and_body_variants(spark):
    rows = [('<doc id="7" url="">x <b>y</b></doc>', '<doc id="7" url="">', ">x <b>y</b>", "x y"),
            ("no header", "", "", "no header")]
    df = spark.createDataFrame([(r[0],) for r in rows], "value string").select(
        "value", T.header_of_line("value").alias("h"), T.body_from_first_gt("value").alias("b"),
        T.strip_tags("value").alias("s"))
    for got, (value, head, body, bare) in zip(df.collect(), rows):
        assert (got["value"], got["h"], got["s"]) == (value, head, bare)
        if head:
            assert got["b"] == body


def test_tokenisers(spark):
    text = "(Word), [x] -- ok. It's e-mail  a@b.com"
    r = spark.createDataFrame([(text,)], "t string").select(
        T.tokens_letters("t").alias("letters"), T.tokens_stripped("t").alias("stripped"),
        T.topic_tokens("t").alias("topic"), T.tokens_single_space("t").alias("raw")).first()
    assert r["letters"] == ["word", "x", "ok", "it", "s", "e", "mail", "a", "b", "com"]
    assert r["stripped"] == ["word", "ok", "it's", "e-mail", "a@b.com"]
    assert r["topic"] == ["word", "it's", "e-mail", "a@b.com"]
    assert r["raw"] == ["(Word),", "[x]", "--", "ok.", "It's", "e-mail", "", "a@b.com"]
    empty = spark.createDataFrame([("",)], "t string").select(
        T.tokens_letters("t").alias("a"), T.tokens_stripped("t").alias("b"), T.topic_tokens("t").alias("c")).first()
    assert tuple(empty) == ([], [], [])


def test_label_from_id(spark):
    df = spark.createDataFrame([("AU107",), ("101",), ("xAUx",)], "d string").select(
        T.label_from_id("d").alias("a"), T.label_from_id("d", negative=-1).alias("b"))
    assert [(r["a"], r["b"]) for r in df.collect()] == [(1, 1), (0, -1), (1, 1)]


def test_assignment_parsing(spark):
    parsed = files.parse_assignments(files.read_lines(spark, fixture_path("assignments.txt"))).collect()
    expected = []
    for v in _lines("assignments.txt"):
        cluster = int(v[1: v.index(",")])
        group, num = re.search(r"20_newsgroups/([^/]+)/([^\"]*)\"", v).groups()
        expected.append((cluster, num, group))
    assert sorted((r["cluster"], r["doc_id"], r["newsgroup"]) for r in parsed) == sorted(expected)
    assert {len(e[1]) for e in expected} == {4, 5, 6}


def test_category_links(spark):
    cats = files.read_category_links(spark, fixture_path("categories.csv")).collect()
    got = sorted((r["doc_id"], r["category"]) for r in cats)
    assert ("104", "Numbers, Symbols") in got
    assert ("105", "Quotes") in got
    assert [c for d, c in got if d == "101"] == ["Greeting", "Software"]
    assert len(got) == 6


def test_writers(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id"))
    small = str(tmp_path / "small")
    files.write_small_result(df.groupBy("g").count(), small)
    assert len(glob.glob(os.path.join(small, "part-*"))) == 1
    big = str(tmp_path / "big")
    files.write_table(df, big, partition_by=["g"])
    back = spark.read.parquet(big)
    assert back.count() == 100 and sorted(r["g"] for r in back.select("g").distinct().collect()) == [0, 1, 2]


def test_materialize_writes_and_drops_scratch_tables(spark):
    from sparkloom.session import _scratch_root, drop_scratch_tables, materialize

    df = materialize(spark.range(50).select((F.col("id") * 2).alias("x")))
    assert df.agg(F.sum("x")).first()[0] == 2450
    assert "InMemoryFileIndex" in df._jdf.queryExecution().executedPlan().toString() or df.inputFiles()
    root = _scratch_root(spark)
    assert os.path.isdir(root)
    drop_scratch_tables(spark)
    assert not os.path.exists(root)


def test_sorted_assignments(spark, tmp_path):
    df = spark.createDataFrame([(i % 3, f"d{i:02d}") for i in range(30)], "cluster int, doc_id string").repartition(4)
    files.write_sorted_assignments(df, str(tmp_path / "sorted"))
    parts = sorted(glob.glob(str(tmp_path / "sorted" / "part-*")))
    rows = [tuple(r) for p in parts for r in spark.read.parquet(p).collect()]
    assert rows == sorted(rows) and len(rows) == 30


def test_bz2_files_and_directories_of_part_files(spark, tmp_path):
    """Compressed input, and several part files read as one table."""
    import bz2
    import shutil

    folder = tmp_path / "parts"
    folder.mkdir()
    for i, name in enumerate(("trips.csv", "trips.csv")):
        with open(fixture_path(name), "rb") as source:
            (folder / f"part-{i:05d}.bz2").write_bytes(bz2.compress(source.read()))
    one = sorted(map(repr, files.read_trips(spark, fixture_path("trips.csv")).collect()))
    assert sorted(map(repr, files.read_trips(spark, str(folder / "part-00000.bz2")).collect())) == one
    assert sorted(map(repr, files.read_trips(spark, str(folder)).collect())) == sorted(2 * one)
    shutil.copy(fixture_path("trips.csv"), folder / "part-00002")
    assert files.read_lines(spark, str(folder)).count() == 3 * len(one)


def test_category_links_have_a_given_schema(spark, tmp_path):
    path = tmp_path / "links.csv"
    path.write_text('"007","A, b"\n"8","c","extra"\n"9"\n')
    df = files.read_category_links(spark, str(path))
    assert df.dtypes == [("doc_id", "string"), ("category", "string")]
    assert sorted((r.doc_id, r.category or "") for r in df.collect()) == [("007", "A, b"), ("8", "c"), ("9", "")]


@pytest.mark.parametrize("piece", [slice(None), slice(2, 6), slice(1, 1)])
def test_letter_words_of_an_arrow_batch_are_tokens_letters(spark, piece):
    import pyarrow as pa

    texts = ["The cat, the CAT\n42x", None, "", "  é\u212aelvin naïve\U0001f600end ", "...", "a", "B c\x00d", "tail"]
    texts = texts[piece]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = [r["w"] or [] for r in df.select("i", T.tokens_letters("t").alias("w")).orderBy("i").collect()]
    assert T.letter_words(pa.array(["x y", *texts], pa.string())[1:]).to_pylist() == want
