"""Registered queries: one per operator of the inventory, each `(spark, sf_dir) -> DataFrame`.

Every query reads the driver's tables (or tables Spark derives from them) in full. Oracle twins
live in `ORACLE` under the same key; keys without a twin are random or iterative operators that
get a rows-only check (their pytest suites check them against brute force on small inputs).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.functions import columns as C
from tripcraft.operators import features as FE
from tripcraft.operators import quality as Q
from tripcraft.plans import oracle_sql as O
from tripcraft.plans import pipeline as P
from tripcraft.session import checkpoint_dir, stored
from tripcraft.sources import fixtures as X
from tripcraft.sources import io as IO

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def trips(spark, sf):
    return X.trips_from_star(spark, sf)


def bounds(spark, sf) -> P.Bounds:
    return P.learn_bounds(trips(spark, sf), quantiles="exact")


def clean_pipeline(spark, sf) -> DataFrame:
    """The full cleaning plan (bounds learnt with exact quantiles so DuckDB can repeat them)."""
    raw = trips(spark, sf)
    return P.clean_trips(raw, P.learn_bounds(raw, quantiles="exact"))


def cleaned(spark, sf) -> DataFrame:
    """The cleaned table as downstream jobs see it: written once by the cleaning job, then scanned."""
    return X.derived_table(spark, sf, "cleaned", "lineitem", clean_pipeline)


def raw_features(spark, sf) -> DataFrame:
    return P.raw_features(trips(spark, sf))


W = O.with_ctes
CLEAN_CTES = (O.TRIPS, O.BOUNDS, O.CLEANED)
CLEAN_COLS = ", ".join(S.CLEAN_COLUMNS)

# ---------------------------------------------------------------- B: cleaning stages


@query("clean_trips", W(*CLEAN_CTES, body=f"SELECT {CLEAN_COLS} FROM cleaned"))
def q_clean_trips(spark, sf):
    return clean_pipeline(spark, sf)


@query("flag_negative_fee", W(O.TRIPS, body=f"""
SELECT tolls_amount, congestion_surcharge, cbd_congestion_fee, total_amount,
  CAST(CASE WHEN {O.NEG} THEN 1 ELSE 0 END AS INTEGER) AS has_negative_fee FROM trips"""))
def q_flag_negative_fee(spark, sf):
    return trips(spark, sf).select(*S.NEG_FEE_COLUMNS, "total_amount",
                                   C.as_flag(C.any_negative()).alias("has_negative_fee"))


@query("flag_no_meter", W(O.TRIPS, body=f"""
SELECT trip_distance, fare_amount, CAST(CASE WHEN {O.NO_METER} THEN 1 ELSE 0 END AS INTEGER) AS no_meter FROM trips"""))
def q_flag_no_meter(spark, sf):
    return trips(spark, sf).select("trip_distance", "fare_amount", C.as_flag(C.no_meter()).alias("no_meter"))


@query("flag_overcharge")
def q_flag_overcharge(spark, sf):
    raw = trips(spark, sf)
    (q75,) = Q.quantiles(raw, "total_amount", [0.75], "exact")
    return raw.select(*S.NEG_FEE_COLUMNS, "total_amount", C.as_flag(C.overcharge(q75)).alias("flag_overcharge"))


ORACLE["flag_overcharge"] = "WITH " + O.TRIPS + """,
q AS (SELECT quantile_cont(total_amount, 0.75) AS q75 FROM trips)
SELECT tolls_amount, congestion_surcharge, cbd_congestion_fee, total_amount,
  CAST(CASE WHEN """ + O.NEG + """ AND total_amount > (SELECT q75 FROM q) THEN 1 ELSE 0 END AS INTEGER) AS flag_overcharge
FROM trips"""

MONEY_COLS = "VendorID, trip_distance, fare_amount, total_amount, tolls_amount, congestion_surcharge, cbd_congestion_fee, flag_no_meter, flag_overcharge"


@query("clean_money", W(O.TRIPS, O.BOUNDS, body=f"SELECT {MONEY_COLS} FROM money"))
def q_clean_money(spark, sf):
    raw = trips(spark, sf)
    (q75,) = Q.quantiles(raw, "total_amount", [0.75], "exact")
    return Q.clean_money(raw, q75).select(*MONEY_COLS.split(", "))


@query("clean_distance", W(*CLEAN_CTES, body="SELECT VendorID, trip_distance, total_amount, flag_overcharge FROM dist"))
def q_clean_distance(spark, sf):
    raw = trips(spark, sf)
    b = P.learn_bounds(raw, "exact")
    df = Q.iqr_fence(Q.clean_money(raw, b.q75_total), "trip_distance", b.distance_upper)
    return df.select("VendorID", "trip_distance", "total_amount", "flag_overcharge")


@query("trip_duration", W(O.TRIPS, body=f"""
SELECT tpep_pickup_datetime, tpep_dropoff_datetime, {O.DUR} AS trip_duration_seconds FROM trips"""))
def q_trip_duration(spark, sf):
    return FE.with_duration(trips(spark, sf)).select("tpep_pickup_datetime", "tpep_dropoff_datetime",
                                                     "trip_duration_seconds")


@query("clean_duration", W(*CLEAN_CTES, body="SELECT VendorID, trip_distance, trip_duration_seconds FROM durok"))
def q_clean_duration(spark, sf):
    raw = trips(spark, sf)
    b = P.learn_bounds(raw, "exact")
    df = Q.iqr_fence(Q.clean_money(raw, b.q75_total), "trip_distance", b.distance_upper)
    return FE.clean_duration(FE.with_duration(df)).select("VendorID", "trip_distance", "trip_duration_seconds")


@query("temporal_features", W(O.TRIPS, body=f"""
SELECT tpep_pickup_datetime, {O.HOUR} AS pickup_hour, {O.DOW} AS pickup_dayofweek, {O.MONTH} AS pickup_month,
  CAST(CASE WHEN {O.DOW} IN (1, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  CAST(CASE WHEN {O.DOW} NOT IN (1, 7) AND ({O.HOUR} BETWEEN 7 AND 9 OR {O.HOUR} BETWEEN 16 AND 19)
       THEN 1 ELSE 0 END AS INTEGER) AS is_rush_hour
FROM trips"""))
def q_temporal_features(spark, sf):
    return FE.temporal_features(trips(spark, sf)).select(
        "tpep_pickup_datetime", "pickup_hour", "pickup_dayofweek", "pickup_month", "is_weekend", "is_rush_hour")


@query("encode_categoricals", W(O.TRIPS, body="""
SELECT store_and_fwd_flag, RatecodeID,
  CAST(CASE WHEN store_and_fwd_flag = 'Y' THEN 1 ELSE 0 END AS INTEGER) AS store_fwd_flag_int,
  CASE WHEN RatecodeID = 99 THEN NULL ELSE CAST(RatecodeID AS INTEGER) END AS ratecode_clean
FROM trips"""))
def q_encode_categoricals(spark, sf):
    return FE.encode_categoricals(trips(spark, sf)).select(
        "store_and_fwd_flag", "RatecodeID", "store_fwd_flag_int", "ratecode_clean")


@query("speed_proxy", W(*CLEAN_CTES, body="SELECT trip_distance, trip_duration_seconds, speed_mph_proxy FROM cleaned"))
def q_speed_proxy(spark, sf):
    return cleaned(spark, sf).select("trip_distance", "trip_duration_seconds", "speed_mph_proxy")


@query("speed_proxy_raw", W(O.TRIPS, O.RAWF, body="SELECT trip_distance, trip_duration_seconds, speed_mph_proxy FROM rawf"))
def q_speed_proxy_raw(spark, sf):
    return raw_features(spark, sf).select("trip_distance", "trip_duration_seconds", "speed_mph_proxy")


FULL_KEEP = [c for c in S.CLEAN_COLUMNS if c not in ("speed_mph_proxy", "PULocationID", "DOLocationID")]
REDUCED_KEEP = S.REDUCED_FEATURES + [S.TARGET]


def not_null(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


@query("training_full", W(*CLEAN_CTES, body=f"SELECT {', '.join(FULL_KEEP)} FROM cleaned WHERE {not_null(FULL_KEEP)}"))
def q_training_full(spark, sf):
    return FE.training_frame(cleaned(spark, sf), "full")


@query("training_reduced", W(*CLEAN_CTES, body=f"SELECT {', '.join(REDUCED_KEEP)} FROM cleaned WHERE {not_null(REDUCED_KEEP)}"))
def q_training_reduced(spark, sf):
    return FE.training_frame(cleaned(spark, sf), "reduced")


# ---------------------------------------------------------------- D1-D3: audit, bounds, describe


@query("stage_audit", W(*CLEAN_CTES, body="""
SELECT 'raw' AS stage, count(*) AS rows FROM trips
UNION ALL SELECT 'money', count(*) FROM money
UNION ALL SELECT 'overcharge_flagged', count(*) FROM money WHERE flag_overcharge = 1
UNION ALL SELECT 'distance', count(*) FROM dist
UNION ALL SELECT 'duration', count(*) FROM durok"""))
def q_stage_audit(spark, sf):
    raw = trips(spark, sf)
    return P.stage_audit(raw, P.learn_bounds(raw, "exact"))


@query("quantile_bounds", W(O.TRIPS, O.BOUNDS, body="""
SELECT round((SELECT q75 FROM q75), 9) AS q75_total, round(q1, 9) AS q1_distance, round(q3, 9) AS q3_distance,
  round((SELECT upper FROM fence), 9) AS distance_upper FROM dq"""))
def q_quantile_bounds(spark, sf):
    b = P.bounds_frame(trips(spark, sf), "exact")
    return b.select(*[F.round(c, 9).alias(c) for c in b.columns])


@query("read_mixed_trips", W(O.TRIPS, body="SELECT * FROM trips"))
def q_read_mixed_trips(spark, sf):
    """The raw trips from a folder whose files store the whole-number columns as 64-bit, 32-bit or double."""
    raw = trips(spark, sf)
    path = f"{checkpoint_dir(spark).rstrip('/')}/mixed/{uuid.uuid4().hex}"
    whole = [f.name for f in S.RAW_TRIP_SCHEMA if f.dataType.simpleString() == "bigint"]
    for k, kind in enumerate(("bigint", "int", "double")):
        raw.filter(F.pmod("PULocationID", F.lit(3)) == k).withColumns({c: F.col(c).cast(kind) for c in whole}).write.parquet(f"{path}/part={k}")
    return IO.read_trips_mixed(spark, path)[0]


@query("sketch_bounds", W(O.TRIPS, O.BOUNDS, body="""
SELECT 'total' AS name, 0.75e0 AS prob, count(total_amount) AS n, true AS within_error FROM trips
UNION ALL SELECT 'distance', 0.25e0, count(trip_distance), true FROM money
UNION ALL SELECT 'distance', 0.75e0, count(trip_distance), true FROM money"""))
def q_sketch_bounds(spark, sf):
    """Cleaning bounds from stored daily sketches: each estimate's true rank lies within 1 % of its probability."""
    raw = trips(spark, sf)
    days = Q.day_sketches(raw)
    stored_days, _ = stored(days, "day-sketches")
    b = P.bounds_from_sketches(stored_days)
    money = raw.filter(Q.money_ok())
    out = None
    for name, column, df, prob, bound in (("total", "total_amount", raw, 0.75, b.q75_total), ("distance", "trip_distance", money, 0.25, b.q1_distance),
                                          ("distance", "trip_distance", money, 0.75, b.q3_distance)):
        x = F.col(column)
        n = F.count(x)
        # the ranks that hold the estimate reach into the allowed band
        row = df.agg(n.cast("bigint").alias("n"), ((F.count_if(x < bound) <= (prob + S.QUANTILE_ERROR) * n)
                                                   & (F.count_if(x <= bound) >= (prob - S.QUANTILE_ERROR) * n)).alias("within_error"))
        row = row.select(F.lit(name).alias("name"), F.lit(prob).alias("prob"), "n", "within_error")
        out = row if out is None else out.unionByName(row)
    return out


DESCRIBE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
  CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM cleaned"""
    for c in S.DESCRIBE_COLUMNS)


@query("describe_cleaned", W(*CLEAN_CTES, body=DESCRIBE_SQL))
def q_describe_cleaned(spark, sf):
    return P.describe(cleaned(spark, sf))


@query("preview", W(*CLEAN_CTES, body=f"SELECT {CLEAN_COLS} FROM cleaned ORDER BY {', '.join(c + ' NULLS FIRST' for c in S.CLEAN_COLUMNS)} LIMIT 5"))
def q_preview(spark, sf):
    from tripcraft.sources.io import preview
    return preview(cleaned(spark, sf), S.CLEAN_COLUMNS, 5)
