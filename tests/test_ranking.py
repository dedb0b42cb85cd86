"""Distributed numbering and cuts (T2, T3, T10): equal to a sort in plain Python."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import evaluate
from sparkloom.operators import vocab as V
from sparkloom.operators.ranking import kth_largest, numbered


def _counts(spark, values):
    return spark.createDataFrame([(f"w{i:05d}", int(n)) for i, n in enumerate(values)], "word string, count long")


@pytest.mark.parametrize("values", [
    [5] * 50, list(range(1, 400)), [2**62, 2**62 - 1, 2**40, 1, 1, 1], [1], np.random.default_rng(1).zipf(1.3, 3000).clip(1, 10**12).tolist()])
def test_cut_and_positions(spark, values):
    counts = _counts(spark, values).repartition(5)
    want = sorted(((n, f"w{i:05d}") for i, n in enumerate(values)), key=lambda x: (-x[0], x[1]))
    for k in (1, 3, 49, len(values) - 1, len(values), len(values) + 1):
        if k < 1:
            continue
        cut = kth_largest(counts, "count", k)
        assert cut == ((want[k - 1][0], sum(n > want[k - 1][0] for n in values)) if k <= len(values) else None)
        got = sorted((r["pos"], r["count"], r["word"]) for r in V.top_k(counts, k).collect())
        assert got == [(i, *x) for i, x in enumerate(want[:k])]


def test_cut_of_no_rows(spark):
    counts = _counts(spark, [1]).limit(0)
    assert kth_largest(counts, "count", 1) is None and V.top_k(counts, 3).count() == 0


def test_numbering_equals_sort(spark):
    rng = np.random.default_rng(2)
    rows = [(int(rng.integers(0, 20)), i) for i in range(1000)] + [(None, 1000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = {r.b: r.place for r in numbered(df, [F.col("a").desc(), F.col("b").asc()], "place").collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert got == {b: i for i, (_, b) in enumerate(order, 1)}
    assert numbered(df.limit(0), [F.col("a").asc()], "place").count() == 0


def test_cluster_ranks_have_no_single_task_window(spark):
    assign = spark.createDataFrame([(i % 13 * (i % 3), i) for i in range(500)], "cluster int, doc long")
    sizes = evaluate.cluster_sizes(assign)
    plan = sizes._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    rows = sizes.collect()
    want = sorted(rows, key=lambda r: (-r.n_docs, r.cluster))
    assert [r.size_rank for r in want] == list(range(1, len(rows) + 1))
