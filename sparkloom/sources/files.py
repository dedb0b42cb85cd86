"""Readers for the file formats of the surveyed jobs, and result writers.

Text scans are ``spark.read.text`` (bz2 and gzip are decoded transparently; bz2 splits),
so a directory of part files reads as one input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions import clean
from sparkloom.functions import text as TX


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, ``value string``."""
    return spark.read.text(path)


def read_trips(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S3: positional 17-field trip records without quoting -> typed trip columns."""
    return clean.parse_trip_lines(read_lines(spark, path))


def read_trips_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S3 via the CSV reader: malformed lines keep their text in ``_corrupt_record``."""
    fields = [
        T.StructField(n, T.StringType() if n in clean.STRING_FIELDS else T.DoubleType())
        for n in clean.TRIP_FIELDS
    ]
    schema = T.StructType(fields + [T.StructField("_corrupt_record", T.StringType())])
    df = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("quote", "\u0000")
        .csv(path)
    )
    # CSV column pruning parses only the referenced fields, so a bad value in an unread
    # field would not mark the record; n_fields therefore reads every field, and any
    # filter on it makes the scan parse whole records.
    every_field = F.length(F.concat_ws("\u0001", *[F.col(n).cast("string") for n in clean.TRIP_FIELDS])) >= 0
    ok = F.col("_corrupt_record").isNull() & every_field
    return df.withColumn("n_fields", F.when(ok, F.lit(clean.N_FIELDS)).otherwise(F.lit(-1)))


def parse_wiki_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """P1 + P2 + F5: ``<doc id="ID" url=… …>BODY</doc>`` lines -> ``doc_id, text``."""
    v = F.col(value)
    return lines.where(TX.valid_doc_line(v)).select(
        TX.doc_id_of_line(v).alias("doc_id"), TX.body_of_line(v).alias("text")
    )


def read_wiki_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_wiki_lines(read_lines(spark, path))


def read_category_links(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Quoted ``"ID","CATEGORY"`` CSV -> ``doc_id, category``, with the schema given, so the
    input is read once and no type is guessed (extra fields ignored, a missing one is NULL)."""
    return spark.read.schema("doc_id string, category string").option("quote", '"').option("header", "false").csv(path)


def parse_assignments(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(CLUSTER, '<doc id="20_newsgroups/GROUP/NUM" …>')`` -> cluster, doc_id, newsgroup."""
    v = F.col(value)
    return lines.select(
        TX.cluster_of_assignment(v).alias("cluster"),
        TX.doc_of_assignment(v).alias("doc_id"),
        TX.newsgroup_of_assignment(v).alias("newsgroup"),
    )


def write_small_result(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """One output file; only for results bounded by construction (top-n reports)."""
    writer = df.coalesce(1).write.mode(mode)
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.format(fmt).save(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """A distributed Parquet write (one file per task, optional partition columns)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_sorted_assignments(assignments: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``(cluster, doc_id)`` rows in order of cluster, then document.

    A range-partitioned sort: part files follow each other in order, and a large cluster
    spreads over several of them."""
    assignments.orderBy("cluster", "doc_id").write.mode(mode).parquet(path)
