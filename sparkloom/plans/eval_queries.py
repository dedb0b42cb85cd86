"""Registered evaluation queries: confusion matrix / F1, false positives, cluster reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators import classify, evaluate
from sparkloom.plans.registry import register
from sparkloom.sources.files import parse_assignments
from sparkloom.sources.tables import documents_as_assignments, table

# Fixed values of the stand-in linear scorer over all 64 embedding dimensions.
SCORER_WEIGHTS = [1.0, -1.0] * 32


def scored_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    xs = [F.col("embedding").getItem(i).cast("double") for i in range(len(SCORER_WEIGHTS))]
    z = classify.dot_columns(SCORER_WEIGHTS, xs)
    return emb.select(
        "vec_id",
        F.when(F.col("label") >= 5, 1).otherwise(0).alias("label"),
        classify.predict(z, "ge0").alias("prediction"),
    )


@register("confusion_f1")
def confusion_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.binary_summary(scored_embeddings(spark, sf_dir))


@register("confusion_matrix")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_counts(scored_embeddings(spark, sf_dir))


@register("false_positives")
def false_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.false_positives(scored_embeddings(spark, sf_dir), "vec_id", 3)


@register("cluster_label_top3")
def cluster_label_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M21 with ``source`` as the cluster and ``lang`` as the true label, every cluster."""
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("cluster"), F.col("lang").alias("label"))
    return evaluate.cluster_label_top(docs, "cluster", "label", 3)


@register("assignment_parse")
def assignment_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14 + A18 + T10: parse assignment text lines, then cluster sizes and their ranking."""
    parsed = parse_assignments(documents_as_assignments(spark, sf_dir))
    return evaluate.cluster_sizes(parsed, "cluster")


@register("assignment_newsgroups")
def assignment_newsgroups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14 + A20: top-3 newsgroups of every parsed cluster with their share of the cluster."""
    parsed = parse_assignments(documents_as_assignments(spark, sf_dir))
    return evaluate.cluster_label_top(parsed.withColumnRenamed("newsgroup", "label"), "cluster", "label", 3)
