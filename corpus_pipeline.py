"""The corpus pipeline: five operators of ``sparkloom.llm``, each on what the one before kept.

1. quality: documents that the byte network scores below 0.5 go.
2. near duplicates: of documents linked by five-word shingles at similarity 0.8, the one
   with the smallest id stays.
3. decontamination: documents in which a benchmark window occurs go.
4. secrets: found secrets are replaced in the text; ``n_chars`` follows the text.
5. mix: every document gets its number of copies in the mix (0 to 3).

All stages but the last return the columns of ``documents``; the last adds its decisions.
Between stages the rows are a Parquet table in the shared folder, so a lost executor costs a
re-read. Rows that repeat, NULLs and empty tables are as each operator defines them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import decontaminate, jaccard_join, mixing, quality_cnn, secrets
from sparkloom.llm.tables import read
from sparkloom.session import materialize, ship_package

NEAR_DUPLICATES = jaccard_join.Settings(words=5, percent=80)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality_cnn.keep_good(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard_join.keep_one(docs, cfg=NEAR_DUPLICATES)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    if "n_chars" in clean.columns:
        kind = clean.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("mixing sources", mix_sources),
]

#: SQL cannot express the trained network of the first stage
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
