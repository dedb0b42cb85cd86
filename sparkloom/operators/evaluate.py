"""Evaluation reports: word presence per class, confusion matrix / F1, false positives,
cluster composition.

All are grouped aggregations on (label, prediction) or (cluster, label) keys with a
handful of groups, so map-side partial aggregation leaves almost nothing to shuffle; the
per-group top-n uses ``row_number() <= n`` which Spark runs as a WindowGroupLimit before
the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators.ranking import numbered

RATE_DIGITS = 9


def presence_rate_by_class(
    labelled_docs: DataFrame, tokens: Column, words: list[str], vocab=None, label: str = "label"
) -> DataFrame:
    """Per probe word and class, the share of the class's documents containing it.

    One pass: every document contributes 0/1 flags for all probe words; the class base is
    every document of the class (a document without any dictionary word counts as 0).
    Output ``(word, pos, label, n_docs, n_with_word, rate)``; ``pos`` is the word's
    dictionary position (F8 point lookup), NULL when it is not in the dictionary.
    """
    toks = labelled_docs.select(F.col(label).alias("label"), tokens.alias("tokens"))
    flags = [F.array_contains("tokens", w).cast("int").alias(f"w{i}") for i, w in enumerate(words)]
    per_class = toks.select("label", *flags).groupBy("label").agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(f"w{i}").cast("long").alias(f"w{i}") for i in range(len(words))]
    )
    long = per_class.unpivot(["label", "n_docs"], [f"w{i}" for i in range(len(words))], "slot", "n_with_word")
    names = F.create_map(*[x for i, w in enumerate(words) for x in (F.lit(f"w{i}"), F.lit(w))])
    long = long.withColumn("word", names[F.col("slot")]).drop("slot")
    if vocab is not None:
        positions = vocab.table.where(F.col("word").isin(words)).select("word", "pos")
        long = long.join(F.broadcast(positions), "word", "left")
    else:
        long = long.withColumn("pos", F.lit(None).cast("int"))
    return long.select(
        "word", "pos", "label", "n_docs", "n_with_word",
        F.round(F.col("n_with_word") / F.col("n_docs"), RATE_DIGITS).alias("rate"),
    )


def confusion_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)`` rows, one per observed cell."""
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def binary_summary(
    scored: DataFrame, positive=1, label: str = "label", prediction: str = "prediction", digits: int = 9
) -> DataFrame:
    """One row ``tp, fp, fn, tn, f1`` (F1 of the positive class; 0 when undefined)."""
    y = F.col(label) == F.lit(positive)
    p = F.col(prediction) == F.lit(positive)
    cnt = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    agg = scored.agg(
        cnt(y & p).alias("tp"), cnt(~y & p).alias("fp"), cnt(y & ~p).alias("fn"), cnt(~y & ~p).alias("tn")
    )
    denom = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    f1 = F.when(denom > 0, (2 * F.col("tp")).cast("double") / denom).otherwise(F.lit(0.0))
    return agg.withColumn("f1", F.round(f1, digits))


def false_positives(
    scored: DataFrame, id_col: str, n: int = 3, negative=0, positive=1, label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """the first ``n`` ids (by id) predicted positive whose label is negative."""
    fp = scored.where((F.col(label) == F.lit(negative)) & (F.col(prediction) == F.lit(positive)))
    return fp.select(id_col, label, prediction).orderBy(id_col).limit(n)


def cluster_sizes(assign: DataFrame, cluster: str = "cluster") -> DataFrame:
    """A18 + T10: ``(cluster, n_docs, size_rank)``, rank 1 = largest (ties by cluster)."""
    sizes = assign.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_docs"))
    return numbered(sizes, [F.col("n_docs").desc(), F.col(cluster).asc()], "size_rank")


def cluster_label_top(
    assign: DataFrame, cluster: str = "cluster", label: str = "label", n: int = 3, digits: int = 9
) -> DataFrame:
    """A20 + M21: per cluster its size rank and its ``n`` most common labels with their share.

    Output ``(cluster, n_docs, size_rank, label, label_count, label_rank, share)`` where
    share = label count / cluster size. Every cluster is reported, not a chosen few.
    """
    counts = assign.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("label_count"))
    w = Window.partitionBy(cluster).orderBy(F.col("label_count").desc(), F.col(label).asc())
    top = counts.withColumn("label_rank", F.row_number().over(w).cast("long")).where(F.col("label_rank") <= n)
    sizes = cluster_sizes(assign, cluster)
    out = top.join(sizes, cluster)
    return out.select(
        cluster, "n_docs", "size_rank", label, "label_count", "label_rank",
        F.round(F.col("label_count") / F.col("n_docs"), digits).alias("share"),
    )
