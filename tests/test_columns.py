"""Column expressions on hand-made edge frames (nulls, sentinels, clock change, rounding, overflow)."""

import datetime as dt

from pyspark.sql import functions as F

from tripcraft.functions import columns as C


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_any_negative_never_null_and_no_meter_null(spark):
    df = spark.createDataFrame(
        [(None, None, 0.75, 0.0, 0.0), (-6.94, 2.5, 0.75, 0.0, None), (0.0, None, -0.75, None, 0.0)],
        "tolls_amount double, congestion_surcharge double, cbd_congestion_fee double, trip_distance double, fare_amount double")
    rows = df.select(C.any_negative().alias("neg"), C.no_meter().alias("nm")).collect()
    assert [r.neg for r in rows] == [False, True, True]
    assert rows[1].nm is None and rows[2].nm is None


def test_money_filter_three_valued(spark):
    from tripcraft.operators.quality import money_ok
    df = spark.createDataFrame(
        [(-6.94, 2.5, 0.75, None, 0.0, 10.0),    # negative fee, no_meter null -> condition null -> dropped
         (0.0, 2.5, 0.75, None, 0.0, 10.0),      # no negative, no_meter null -> kept
         (0.0, 2.5, 0.75, 1.0, 5.0, None),       # total null -> dropped
         (-6.94, 2.5, 0.75, 0.0, 0.0, 10.0)],    # ghost refund -> dropped
        "tolls_amount double, congestion_surcharge double, cbd_congestion_fee double, trip_distance double, "
        "fare_amount double, total_amount double")
    assert df.filter(money_ok()).count() == 1


def test_sentinel_and_null_rate_code(spark):
    df = spark.createDataFrame([(99,), (None,), (3,)], "RatecodeID long")
    assert [r.c for r in df.select(C.sentinel_to_null("RatecodeID").alias("c")).collect()] == [None, None, 3]


def test_duration_clock_change_fractions_and_overflow(spark):
    df = spark.createDataFrame([
        (ts("2025-03-09 01:30:00"), ts("2025-03-09 03:30:00")),          # US clock change: wall clock 7200 s
        (ts("2025-01-01 00:00:00.900"), ts("2025-01-01 00:01:00.100")),  # fractions truncated per side
        (ts("1900-01-01 00:00:00"), ts("2100-01-01 00:00:00")),          # beyond int range -> null
    ], "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz")
    got = [r.d for r in df.select(C.duration_seconds().alias("d")).collect()]
    assert got == [7200, 60, None]


def test_round_half_up_on_decimal_text(spark):
    df = spark.createDataFrame([(2.675,)], "x double")
    assert df.select(F.round("x", 2).alias("r")).first().r == 2.68


def test_temporal_flags(spark):
    from tripcraft.operators.features import temporal_features
    df = spark.createDataFrame([(ts("2025-03-08 08:15:00"),),   # Saturday -> weekend, not rush
                                (ts("2025-03-10 17:00:00"),),   # Monday 17h -> rush
                                (ts("2025-03-11 10:00:00"),)],  # Tuesday 10h -> neither
                               "tpep_pickup_datetime timestamp_ntz")
    rows = temporal_features(df).collect()
    assert [(r.pickup_dayofweek, r.is_weekend, r.is_rush_hour) for r in rows] == [(7, 1, 0), (2, 0, 1), (3, 0, 0)]


def test_labels_roundtrip(spark):
    from tripcraft import schema as S
    df = spark.createDataFrame([(1,), (7,), (9,)], "d int")
    out = df.select(C.label("d", S.DAY_NAMES).alias("l")).select("l", C.unlabel("l", S.DAY_NAMES).alias("c")).collect()
    assert [(r.l, r.c) for r in out] == [("Sunday", 1), ("Saturday", 7), (None, None)]


def test_format_duration(spark):
    df = spark.createDataFrame([(725.9,), (59.0,)], "s double")
    assert [r.t for r in df.select(C.format_duration("s").alias("t")).collect()] == ["12 min 5 sec", "0 min 59 sec"]
