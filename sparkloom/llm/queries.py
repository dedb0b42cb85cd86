"""The registered query of each operator: production parameters, whole tables, full result."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.llm import (
    decontaminate, divergence, fill_middle, html_text, jaccard_join, language, mixing, posting_lists, quality_cnn, quality_rules,
    secrets, suffix_dedup, url_filter,
)
from sparkloom.llm.oracle import ORACLE_SQL  # noqa: F401  (registered with the queries)
from sparkloom.llm.tables import read


def op1_decontaminate(spark, sf_dir):
    marked = decontaminate.annotate(
        read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark")
    )
    return marked.select(
        "doc_id",
        F.col("bench_words").alias("n_words"),
        F.aggregate("bench_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_hit"),
        F.size("bench_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("bench_items", ","), 256).alias("items_sha256"),
        (F.size("bench_spans") > 0).alias("contaminated"),
    )


def op2_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


def op3_quality_classifier(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality_cnn.fit(docs, read(spark, sf_dir, "labels"))
    return quality_cnn.score(docs, net).select(
        "doc_id", quality_cnn.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_quality_rules(spark, sf_dir):
    ledger = quality_rules.with_fail_bits(quality_rules.measure(read(spark, sf_dir, "documents")))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.fails(quality_rules.BASE).alias("base_failed"),
        (~quality_rules.fails(quality_rules.DEFAULT)).alias("kept"),
        "fail_bits",
    )


URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def op5_url_filter(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "url_score")


def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.summary(suffix_dedup.marked(read(spark, sf_dir, "documents")))


def op7_jaccard_join(spark, sf_dir):
    return jaccard_join.classes(read(spark, sf_dir, "documents"))


def op8_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    profiles = language.Profiles(language.learn(docs))
    return language.identify(docs.select("doc_id", "text"), profiles).select(
        "doc_id", quality_cnn.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op9_secrets(spark, sf_dir):
    found = secrets.scan(read(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{secrets.KINDS[kind]}")

    return found.select(
        "doc_id", count(0), count(1), count(2),
        F.sha2(secrets.rendered(F.col("base")), 256).alias("base_sha256"),
        secrets.rendered(F.col("spans")).alias("spans"),
    )


def op10_html_text(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op11_nearest_vectors(spark, sf_dir):
    return posting_lists.nearest(read(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark, sf_dir):
    made = fill_middle.transform(read(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fill_middle.restore(F.col("fim_text"), F.col("fim_form"))
    return made.select(
        "doc_id", F.col("fim_units").alias("n"), F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"), F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2("fim_text", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


def op13_source_divergence(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_mixing": op2_mixing,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_quality_rules": op4_quality_rules,
    "op5_url_filter": op5_url_filter,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_language_id": op8_language_id,
    "op9_secrets": op9_secrets,
    "op10_html_text": op10_html_text,
    "op11_nearest_vectors": op11_nearest_vectors,
    "op12_fill_middle": op12_fill_middle,
    "op13_source_divergence": op13_source_divergence,
}
