"""Trip record parsing and cleaning predicates (positional 17-field CSV).

Parsing never fails a job: every numeric field goes through ``try_cast`` (ANSI mode makes
a plain cast raise), so a malformed value becomes NULL and the predicates drop the row.
Predicates are plain Column expressions; on Parquet input they reach the scan as
``PushedFilters`` wherever they compare a source column with a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 17 positions of a trip record, in file order.
TRIP_FIELDS = [
    "medallion", "hack_license", "pickup_datetime", "dropoff_datetime", "trip_time_secs",
    "trip_distance", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat",
    "payment_type", "fare_amount", "surcharge", "mta_tax", "tip_amount", "tolls_amount",
    "total_amount",
]
STRING_FIELDS = {"medallion", "hack_license", "pickup_datetime", "dropoff_datetime", "payment_type"}
N_FIELDS = len(TRIP_FIELDS)

# Inclusive bounds of the clean-trip range filter.
F4_BOUNDS = {
    "trip_time_secs": (120, 3600),
    "trip_distance": (1, 50),
    "fare_amount": (3, 200),
}
F4_MIN_TOLLS = 3


def parse_trip_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``value string`` lines -> ``n_fields`` + the 17 trip columns.

    Numeric fields are doubles (``try_cast``); identifiers and date-times stay text, as in
    the source files. Lines of the wrong arity keep ``n_fields`` for the filters to test.
    """
    parts = F.split(F.col(value), ",", -1)
    cols = [F.size(parts).alias("n_fields")]
    for i, name in enumerate(TRIP_FIELDS):
        field = F.get(parts, i)  # NULL past the end of a short line (getItem raises under ANSI)
        if name in STRING_FIELDS:
            cols.append(field.alias(name))
        else:
            number = field.try_cast("double")
            cols.append(F.when(~F.isnan(number), number).alias(name))  # NaN is not a number either
    return lines.select(*cols)


def _arity(df_cols: list[str]) -> Column:
    return F.col("n_fields") == N_FIELDS if "n_fields" in df_cols else F.lit(True)


def _number(name: str) -> Column:
    """The column holds a number: neither NULL nor NaN (parsed text has no NaN, native columns may)."""
    return F.col(name).isNotNull() & ~F.isnan(name)


def well_formed(df: DataFrame, require_nonzero: bool = False) -> Column:
    """17 fields and numeric distance and fare.

    The surveyed job's zero test on distance compares a string with 0 and is therefore a
    no-op; ``require_nonzero=True`` applies the intended ``distance <> 0``.
    """
    cond = _arity(df.columns) & _number("trip_distance") & _number("fare_amount")
    if require_nonzero:
        cond = cond & (F.col("trip_distance") != 0)
    return cond


def with_time_and_total(df: DataFrame) -> Column:
    """F1 and non-zero, numeric trip time and total amount."""
    return (
        well_formed(df)
        & _number("trip_time_secs") & (F.col("trip_time_secs") != 0)
        & _number("total_amount") & (F.col("total_amount") != 0)
    )


def with_distance_and_surcharge(df: DataFrame) -> Column:
    """F2 and non-zero distance and surcharge."""
    return (
        with_time_and_total(df)
        & (F.col("trip_distance") != 0)
        & _number("surcharge") & (F.col("surcharge") != 0)
    )


def in_clean_range(df: DataFrame, bounds: dict | None = None, min_tolls: float = F4_MIN_TOLLS) -> Column:
    """F1 and every bounded column within its inclusive range, tolls >= ``min_tolls``."""
    cond = well_formed(df)
    for name, (lo, hi) in (bounds or F4_BOUNDS).items():
        cond = cond & F.col(name).between(lo, hi)
    # NaN is greater than any number in Spark's order
    return cond & _number("tolls_amount") & (F.col("tolls_amount") >= min_tolls)
