"""Registered trip queries on the lineitem / events trip views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import clean
from sparkloom.operators import reports
from sparkloom.plans.registry import register
from sparkloom.sources.tables import events_trips, lineitem_trips, trips_as_csv_lines


@register("active_key_top10")
def active_key_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.most_active(lineitem_trips(spark, sf_dir), "medallion", 10)


@register("ratio_of_sums_top10")
def ratio_of_sums_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.best_earners(lineitem_trips(spark, sf_dir), "hack_license", 10)


@register("hourly_ratio_top10")
def hourly_ratio_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.surcharge_by_hour(events_trips(spark, sf_dir), 10)


@register("csv_roundtrip_clean")
def csv_roundtrip_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips rendered as text lines, parsed back positionally, counted per filter."""
    parsed = clean.parse_trip_lines(trips_as_csv_lines(lineitem_trips(spark, sf_dir)))
    flag = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return parsed.agg(
        F.count(F.lit(1)).alias("n_lines"),
        flag(clean.well_formed(parsed)).alias("n_f1"),
        flag(clean.with_time_and_total(parsed)).alias("n_f2"),
        flag(clean.with_distance_and_surcharge(parsed)).alias("n_f3"),
        flag(clean.in_clean_range(parsed)).alias("n_f4"),
        F.round(F.sum(F.when(clean.in_clean_range(parsed), F.col("total_amount"))), 6).alias("f4_total"),
    )


@register("range_filter_clean")
def range_filter_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = lineitem_trips(spark, sf_dir)
    return trips.where(clean.in_clean_range(trips)).select(
        "medallion", "hack_license", "trip_time_secs", "trip_distance", "fare_amount", "tolls_amount",
        "total_amount",
    )
