from __future__ import annotations

import sys

from helpers import SF, table

import corpus_pipeline
import test_decontaminate
import test_jaccard_join
import test_secrets
from sparkloom.llm.quality_cnn import held_out  # noqa: F401  (the package must import as a whole)
from sparkloom.session import materialize


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = materialize(corpus_pipeline.STAGES[0][1](spark, docs, SF))
    assert kept.columns == columns
    labels = dict(table("labels", columns="doc_id, quality"))
    ids = {r.doc_id for r in kept.collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert len(good) - len(ids & set(good)) <= 0.02 * len(good)

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    single = materialize(corpus_pipeline.STAGES[1][1](spark, kept, SF))
    assert single.columns == columns
    expected = {d for d, _, c in test_jaccard_join.brute(rows, 5, 80) if d == c}
    assert {r.doc_id for r in single.collect()} == expected

    rows = [(r.doc_id, r.text) for r in single.collect()]
    clean = materialize(corpus_pipeline.STAGES[2][1](spark, single, SF))
    assert clean.columns == columns
    expected = {r[0] for r in test_decontaminate.brute(rows, table("benchmark", columns="item_id, text")) if not r[5]}
    assert {r.doc_id for r in clean.collect()} == expected

    redacted = materialize(corpus_pipeline.STAGES[3][1](spark, clean, SF))
    assert redacted.columns == columns
    after = [(r.doc_id, r.text) for r in redacted.collect()]
    assert {d for d, _ in after} == expected
    assert all(sum(r[1:4]) == 0 for r in test_secrets.brute(after))
    assert all(r.n_chars == len(r.text) for r in redacted.collect())

    mixed = corpus_pipeline.STAGES[4][1](spark, redacted, SF)
    assert {(r.doc_id, r.text) for r in mixed.collect()} == set(after)
    assert all(0 <= r.mix_copies <= 3 for r in mixed.collect())


def test_run_repeats_and_empty_input(spark, tmp_path):
    got = sorted((r.doc_id, r.mix_copies, r.text) for r in corpus_pipeline.run(spark, SF).collect())
    assert got and got == sorted((r.doc_id, r.mix_copies, r.text) for r in corpus_pipeline.run(spark, SF).collect())
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    entry = sys.modules.get("__spark_entry__") or __import__("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
