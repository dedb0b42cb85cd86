"""Driver tables and the stand-in views built from them.

The surveyed jobs read taxi CSV files and one-document-per-line corpora that are not
shipped; the registry runs the same operators on the driver's Parquet tables through the
views below. Every view is a projection over a full table (no row subset), so the work
grows with the tables, and every mapping is mirrored by the oracle SQL in
``sparkloom.plans.oracle``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; Catalyst prunes columns and pushes filters into the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Trip view of lineitem. Column roles follow the 17-field taxi layout:
#   medallion <- l_suppkey, hack_license <- l_partkey, pickup/dropoff <- l_shipdate,
#   trip_time_secs <- l_quantity minutes in seconds, trip_distance <- l_quantity * (1 + l_discount),
#   fare_amount <- l_extendedprice / 1000, surcharge <- l_discount, mta_tax <- l_tax,
#   tolls_amount <- l_linenumber, total_amount <- fare * (1 + tax).
def lineitem_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    fare = F.col("l_extendedprice") / F.lit(1000.0)
    return li.select(
        F.col("l_suppkey").alias("medallion"),
        F.col("l_partkey").alias("hack_license"),
        F.col("l_shipdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        (F.col("l_quantity") * F.lit(60)).cast("int").alias("trip_time_secs"),
        (F.col("l_quantity") * (F.lit(1.0) + F.col("l_discount"))).alias("trip_distance"),
        F.lit(0.0).alias("pickup_lon"),
        F.lit(0.0).alias("pickup_lat"),
        F.lit(0.0).alias("dropoff_lon"),
        F.lit(0.0).alias("dropoff_lat"),
        F.col("l_returnflag").alias("payment_type"),
        fare.alias("fare_amount"),
        F.col("l_discount").alias("surcharge"),
        F.col("l_tax").alias("mta_tax"),
        F.lit(0.0).alias("tip_amount"),
        F.col("l_linenumber").cast("double").alias("tolls_amount"),
        (fare * (F.lit(1.0) + F.col("l_tax"))).alias("total_amount"),
    )


# Trip view of events for hour-of-day reports: pickup <- ts, surcharge <- value,
# trip_distance <- the number k of props '{"k": n}', trip_time_secs <- k minutes,
# fare/total <- value.
def events_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract(F.col("props"), r'"k":\s*(-?[0-9]+)', 1).try_cast("double")
    return ev.select(
        F.col("user_id").alias("medallion"),
        F.col("user_id").alias("hack_license"),
        F.col("ts").alias("pickup_datetime"),
        F.col("ts").alias("dropoff_datetime"),
        (k * F.lit(60)).cast("int").alias("trip_time_secs"),
        k.alias("trip_distance"),
        F.col("event_type").alias("payment_type"),
        F.col("value").alias("fare_amount"),
        F.col("value").alias("surcharge"),
        F.col("value").alias("total_amount"),
    )


def trips_as_csv_lines(trips: DataFrame) -> DataFrame:
    """Render typed trips as 17-field comma-separated text, ``value string``.

    Used to drive the positional CSV parser over real data: the parser then sees the same
    text a ``spark.read.text`` over a taxi file would give.
    """
    order = [
        "medallion", "hack_license", "pickup_datetime", "dropoff_datetime", "trip_time_secs",
        "trip_distance", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat",
        "payment_type", "fare_amount", "surcharge", "mta_tax", "tip_amount", "tolls_amount",
        "total_amount",
    ]

    def text(c: str) -> Column:
        if c in ("pickup_datetime", "dropoff_datetime"):
            return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    return trips.select(F.concat_ws(",", *[text(c) for c in order]).alias("value"))


def documents_as_wiki_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` wrapped as one ``<doc id=… url=… title=…>BODY</doc>`` line each."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.concat(
            F.lit('<doc id="'), F.col("doc_id").cast("string"),
            F.lit('" url="http://'), F.col("lang"), F.lit(".example.org/"),
            F.col("doc_id").cast("string"), F.lit('" title="'), F.col("source"),
            F.lit('">'), F.col("text"), F.lit("</doc>"),
        ).alias("value")
    )


def documents_as_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` rendered as cluster-assignment text lines.

    ``(CLUSTER, '<doc id="20_newsgroups/GROUP/NUM" url="" title="…">')`` with CLUSTER the
    number of ``source`` (``src7`` -> 7), GROUP = ``lang`` and NUM = ``doc_id``.
    """
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.concat(
            F.lit("("), F.regexp_extract(F.col("source"), "([0-9]+)", 1),
            F.lit(", '<doc id=\"20_newsgroups/"), F.col("lang"), F.lit("/"),
            F.col("doc_id").cast("string"), F.lit('" url="" title="'), F.col("source"),
            F.lit("\">')"),
        ).alias("value")
    )
