"""Trip parsing, cleaning predicates F1-F4 and the top-n / ratio reports."""

from __future__ import annotations

from fixture_files import fixture_path
from pyspark.sql import functions as F

from sparkloom.functions import clean
from sparkloom.functions.text import hour_of_datetime_text, hour_text
from sparkloom.operators import reports
from sparkloom.sources import files


def _kept(df, cond):
    return sorted(r["medallion"] for r in df.where(cond).select("medallion").collect())


def test_parse_keeps_arity_and_nulls_bad_numbers(spark):
    trips = files.read_trips(spark, fixture_path("trips.csv"))
    rows = {(r["medallion"], r["n_fields"]): r for r in trips.collect()}
    assert len(rows) == 12 or trips.count() == 12
    by_med = {}
    for r in trips.collect():
        by_med.setdefault(r["medallion"], []).append(r)
    assert sorted(r["n_fields"] for r in by_med["M01"]) == [16, 17]
    assert sorted(r["n_fields"] for r in by_med["M02"]) == [17, 18]
    bad_dist = [r for r in by_med["M02"] if r["n_fields"] == 17][0]
    assert bad_dist["trip_distance"] is None
    assert by_med["M03"][0]["fare_amount"] is None
    assert by_med["M10"][0]["total_amount"] == 41.83


def test_filters_f1_f2_f3(spark):
    trips = files.read_trips(spark, fixture_path("trips.csv"))
    assert _kept(trips, clean.well_formed(trips)) == ["M01", "M04", "M05", "M06", "M07", "M08", "M09", "M10"]
    assert _kept(trips, clean.with_time_and_total(trips)) == ["M01", "M04", "M07", "M09", "M10"]
    assert _kept(trips, clean.with_distance_and_surcharge(trips)) == ["M01", "M10"]
    # the intended distance <> 0 test drops M04 already in F1
    assert "M04" not in _kept(trips, clean.well_formed(trips, require_nonzero=True))


def test_csv_reader_marks_bad_arity(spark):
    df = files.read_trips_csv(spark, fixture_path("trips.csv"))
    rows = df.select("medallion", "n_fields").collect()
    assert len(rows) == 12
    # 16 and 18 fields, a non-numeric distance, time and surcharge
    assert sorted(r["medallion"] for r in rows if r["n_fields"] == -1) == ["M01", "M02", "M02", "M08", "M09"]
    assert df.where(F.col("n_fields") == 17).count() == 7


def test_f4_bounds_are_inclusive(spark):
    base = {"medallion": "", "trip_time_secs": 600.0, "trip_distance": 2.5, "fare_amount": 10.0,
            "tolls_amount": 3.0}
    cases = [("trip_time_secs", 119, False), ("trip_time_secs", 120, True), ("trip_time_secs", 3600, True),
             ("trip_time_secs", 3601, False), ("trip_distance", 0.99, False), ("trip_distance", 1, True),
             ("trip_distance", 50, True), ("trip_distance", 50.01, False), ("fare_amount", 2.99, False),
             ("fare_amount", 3, True), ("fare_amount", 200, True), ("fare_amount", 200.01, False),
             ("tolls_amount", 2.99, False), ("tolls_amount", 3, True)]
    rows = []
    for i, (col, v, _) in enumerate(cases):
        r = dict(base, medallion=f"c{i:02d}")
        r[col] = float(v)
        rows.append(r)
    df = spark.createDataFrame(rows)
    kept = set(_kept(df, clean.in_clean_range(df)))
    assert kept == {f"c{i:02d}" for i, (_, _, ok) in enumerate(cases) if ok}


def test_top_n_ties_go_to_smaller_key(spark):
    # keys k00..k11; k09, k10 and k11 share the count at rank 10
    rows = []
    for i in range(12):
        n = 20 - i if i < 9 else 5
        rows += [(f"k{i:02d}",)] * n
    df = spark.createDataFrame(rows, "medallion string")
    top = reports.top_n(reports.count_per_key(df, "medallion"), "trips", "medallion", 10).collect()
    assert [r["medallion"] for r in top] == [f"k{i:02d}" for i in range(10)]
    assert [r["trips"] for r in top][-1] == 5


def test_reports_on_fixture(spark):
    trips = files.read_trips(spark, fixture_path("trips.csv"))
    active = reports.most_active(trips).collect()
    assert active[0]["medallion"] == "M01" and active[0]["trips"] == 1
    earners = {r["hack_license"]: r["dollars_per_minute"] for r in reports.best_earners(trips).collect()}
    assert earners["H10"] == round(41.83 / (1800 / 60), 9)
    assert earners["H01"] == round(12 / 10, 9)
    assert set(earners) == {"H01", "H04", "H07", "H09", "H10"}
    hourly = reports.surcharge_by_hour(trips, hour_col=hour_of_datetime_text("pickup_datetime")).collect()
    assert [(r["hour"], r["surcharge_per_distance"]) for r in hourly] == [("09", round(1.5 / 12.5, 9))]


def test_hour_keeps_leading_zero(spark):
    df = spark.createDataFrame([("2013-01-01 09:15:00",)], "v string").select(
        hour_of_datetime_text("v").alias("a"), hour_text(F.to_timestamp("v")).alias("b"))
    assert df.first().asDict() == {"a": "09", "b": "09"}


def test_zero_denominators_and_nan(spark):
    from sparkloom.functions import clean
    from sparkloom.operators import reports

    rows = spark.createDataFrame([("a", 5.0, 60.0), ("a", 5.0, -60.0), ("b", 1.0, 60.0)], "k string, x double, y double")
    got = reports.top_n(reports.ratio_of_sums(rows, "k", "x", "y", "r", 60.0), "r", "k").collect()
    assert [(r["k"], r["r"]) for r in got] == [("b", 1.0), ("a", None)]
    fields = ["m", "h", "p", "d", "600", "2", "0", "0", "0", "0", "CRD", "10", "1", "1", "1", "nan", "NaN"]
    line = clean.parse_trip_lines(spark.createDataFrame([(",".join(fields),)], "value string"))
    assert line.filter(clean.with_time_and_total(line)).count() == 0
    assert line.filter(clean.in_clean_range(line)).count() == 0


def test_exact_ratios_under_any_partitioning(spark):
    """1e16 swallows 1 in a double; the order of the rows must not decide what is left."""
    rows = [("a", x, 1.0) for x in (1e16, 1.0, -1e16, 0.1, 0.2) * 3] + [("b", 1.0, 0.0), ("c", float("inf"), 2.0), ("c", 3.0, 2.0)]
    want = {"a": round(3.9 / 15, 9), "b": None, "c": 0.75}
    for n in (1, 2, 7):
        df = spark.createDataFrame(rows, "key string, up double, down double").repartition(n)
        assert {r.key: r.ratio for r in reports.ratio_of_sums(df, "key", "up", "down", "ratio").collect()} == want


def test_nan_of_native_columns_is_rejected(spark):
    names = ["trip_distance", "fare_amount", "trip_time_secs", "total_amount", "surcharge", "tolls_amount"]
    good = [2.0, 5.0, 300.0, 9.0, 1.0, 4.0]
    rows = [("ok", *good)] + [(name, *[float("nan") if n == name else x for n, x in zip(names, good)]) for name in names]
    df = spark.createDataFrame(rows, "medallion string, " + ", ".join(f"{n} double" for n in names))
    assert _kept(df, clean.well_formed(df)) == ["ok", "surcharge", "tolls_amount", "total_amount", "trip_time_secs"]
    assert _kept(df, clean.with_time_and_total(df)) == ["ok", "surcharge", "tolls_amount"]
    assert _kept(df, clean.with_distance_and_surcharge(df)) == ["ok", "tolls_amount"]
    assert _kept(df, clean.in_clean_range(df)) == ["ok", "surcharge", "total_amount"]
