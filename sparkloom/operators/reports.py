"""Top-k and ratio-of-sums reports over trips.

All reports are one ``groupBy`` (partial + final HashAggregate, so a key holding a third
of the rows is pre-aggregated map-side) followed by TakeOrderedAndProject for the top-n;
no global sort, nothing but n rows per partition reaches the final task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import clean
from sparkloom.functions.text import hour_text

RATIO_DIGITS = 9
EXACT = "decimal(28,10)"  # of a summand; its sums have 38 digits


def top_n(df: DataFrame, value: str, key: str, n: int = 10) -> DataFrame:
    """The ``n`` rows with the largest ``value``; ties go to the smaller ``key``."""
    return df.orderBy(F.col(value).desc(), F.col(key).asc()).limit(n)


def count_per_key(trips: DataFrame, key: str, name: str = "trips") -> DataFrame:
    return trips.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def ratio_of_sums(
    df: DataFrame, key: str, numerator: str, denominator: str, name: str, denominator_scale: float = 1.0,
    digits: int = RATIO_DIGITS,
) -> DataFrame:
    """``sum(numerator) / (sum(denominator) / denominator_scale)`` per key, rounded.

    Summands are taken to ten decimals, and their sums are exact: the result depends neither on
    the order of the rows nor on how they are partitioned, and small summands survive beside
    large ones. Values that are not finite or have 19 digits before the point are left out.
    """
    above, below = (F.sum(F.col(c).try_cast(EXACT)).cast("double") for c in (numerator, denominator))
    # a key whose denominators sum to zero has no ratio: NULL, which ranks last
    ratio = F.try_divide(above, below / F.lit(float(denominator_scale)))
    return df.groupBy(key).agg(F.round(ratio, digits).alias(name))


def most_active(trips: DataFrame, key: str = "medallion", n: int = 10) -> DataFrame:
    """A3 + T1: keys with most well-formed trips."""
    return top_n(count_per_key(trips.where(clean.well_formed(trips)), key), "trips", key, n)


def best_earners(trips: DataFrame, key: str = "hack_license", n: int = 10) -> DataFrame:
    """A4 + T1: money per minute = total amount / (trip seconds / 60), largest first."""
    ok = trips.where(clean.with_time_and_total(trips))
    ratios = ratio_of_sums(ok, key, "total_amount", "trip_time_secs", "dollars_per_minute", 60.0)
    return top_n(ratios, "dollars_per_minute", key, n)


def surcharge_by_hour(trips: DataFrame, n: int = 10, hour_col=None) -> DataFrame:
    """A5 + P10 + T1: surcharge per unit distance by pickup hour ('00'..'23')."""
    ok = trips.where(clean.with_distance_and_surcharge(trips))
    hour = hour_col if hour_col is not None else hour_text("pickup_datetime")
    ratios = ratio_of_sums(ok.withColumn("hour", hour), "hour", "surcharge", "trip_distance",
                           "surcharge_per_distance")
    return top_n(ratios, "surcharge_per_distance", "hour", n)
