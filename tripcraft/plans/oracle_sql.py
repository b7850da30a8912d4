"""DuckDB SQL twins of the Spark queries (the correctness oracle).

Shared CTE blocks rebuild the derived tables (trips, cleaned trips, requests, request log) from
the driver's pre-registered views with the same arithmetic as `sources.fixtures`. DuckDB
differences handled here: day of week counts Sunday = 0 (+1), `hour`/`month` are BIGINT (cast to
INTEGER), `CAST(double AS BIGINT)` rounds (so `trunc` first), exact quantiles are `quantile_cont`.
"""

from __future__ import annotations

TRIPS = """
li AS (
  SELECT l_orderkey*31 + l_partkey*17 + l_suppkey*7 + l_linenumber AS h,
         l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate
  FROM lineitem),
lp AS (SELECT *, CAST(l_shipdate AS TIMESTAMP) + to_seconds((h*7919) % 86400) AS pickup FROM li),
trips AS (
  SELECT
    CAST(CASE h % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 6 ELSE 7 END AS INTEGER) AS VendorID,
    pickup AS tpep_pickup_datetime,
    pickup + to_seconds(CASE WHEN h % 53 = 0 THEN -300 WHEN h % 47 = 0 THEN 20000
                             ELSE CAST(trunc(l_quantity*45e0) AS BIGINT) + h % 901 END) AS tpep_dropoff_datetime,
    CAST(CASE WHEN h % 29 = 0 THEN NULL ELSE h % 7 END AS BIGINT) AS passenger_count,
    CASE WHEN h % 31 = 0 THEN 0e0 WHEN h % 997 = 0 THEN 400e0 ELSE l_quantity*0.3e0 END AS trip_distance,
    CAST(CASE WHEN h % 29 = 0 THEN NULL WHEN h % 23 = 0 THEN 99 ELSE 1 + h % 6 END AS BIGINT) AS RatecodeID,
    CASE WHEN h % 29 = 0 THEN NULL WHEN h % 19 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(1 + l_partkey % 265 AS BIGINT) AS PULocationID,
    CAST(1 + (l_suppkey*13) % 265 AS BIGINT) AS DOLocationID,
    CAST(h % 6 AS BIGINT) AS payment_type,
    CASE WHEN h % 62 = 0 THEN 0e0 ELSE l_extendedprice/1500e0 END AS fare_amount,
    l_tax*10e0 AS extra,
    0.5e0 AS mta_tax,
    l_discount*40e0 AS tip_amount,
    CASE WHEN h % 37 = 0 OR h % 310 = 0 THEN -6.94e0 WHEN h % 5 = 0 THEN 6.94e0 ELSE 0e0 END AS tolls_amount,
    1e0 AS improvement_surcharge,
    CASE WHEN h % 101 = 0 THEN -(l_extendedprice/1000e0) ELSE l_extendedprice/1000e0 END AS total_amount,
    CASE WHEN h % 29 = 0 THEN NULL WHEN h % 41 = 0 THEN -2.5e0 ELSE 2.5e0 END AS congestion_surcharge,
    CASE WHEN h % 29 = 0 THEN NULL WHEN h % 11 = 0 THEN 1.75e0 ELSE 0e0 END AS Airport_fee,
    CASE WHEN h % 43 = 0 THEN -0.75e0 ELSE 0.75e0 END AS cbd_congestion_fee
  FROM lp)"""

# Whole seconds between two timestamps, truncating fractions like Spark's unix_timestamp.
def secs(a: str, b: str) -> str:
    return (f"TRY_CAST(CAST(floor(epoch_us({b}) / 1000000.0) AS BIGINT)"
            f" - CAST(floor(epoch_us({a}) / 1000000.0) AS BIGINT) AS INTEGER)")


NEG = ("(greatest(CASE WHEN tolls_amount < 0 THEN 1 ELSE 0 END, CASE WHEN congestion_surcharge < 0 THEN 1 ELSE 0 END,"
       " CASE WHEN cbd_congestion_fee < 0 THEN 1 ELSE 0 END) > 0)")
NO_METER = "(trip_distance = 0 AND fare_amount = 0)"
DUR = secs("tpep_pickup_datetime", "tpep_dropoff_datetime")
HOUR = "CAST(hour(tpep_pickup_datetime) AS INTEGER)"
DOW = "CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER)"
MONTH = "CAST(month(tpep_pickup_datetime) AS INTEGER)"

# Spark rounds a double HALF_UP on its shortest decimal text; DuckDB rounds the binary value.
def round2(x: str, places: int = 2) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,24)), {places}) AS DOUBLE)"


SPEED = round2("trip_distance / (trip_duration_seconds / 3600.0e0)")

BOUNDS = """
q75 AS (SELECT quantile_cont(total_amount, 0.75) AS q75 FROM trips),
money AS (
  SELECT t.*,
    CAST(CASE WHEN """ + NO_METER + """ THEN 1 ELSE 0 END AS INTEGER) AS flag_no_meter,
    CAST(CASE WHEN """ + NEG + """ AND total_amount > (SELECT q75 FROM q75) THEN 1 ELSE 0 END AS INTEGER) AS flag_overcharge
  FROM trips t
  WHERE NOT (""" + NEG + " AND " + NO_METER + """) AND total_amount >= 0),
dq AS (SELECT quantile_cont(trip_distance, 0.25) AS q1, quantile_cont(trip_distance, 0.75) AS q3 FROM money),
fence AS (SELECT greatest(q3 + 3.0e0*(q3 - q1), 250e0) AS upper FROM dq)"""

CLEANED = """
dist AS (SELECT * FROM money WHERE trip_distance > 0 AND trip_distance <= (SELECT upper FROM fence)),
dur AS (SELECT *, """ + DUR + """ AS trip_duration_seconds FROM dist),
durok AS (SELECT * FROM dur WHERE trip_duration_seconds BETWEEN 60 AND 10800),
cleaned AS (
  SELECT VendorID, passenger_count, trip_distance, PULocationID, DOLocationID, payment_type,
    flag_no_meter, flag_overcharge, trip_duration_seconds,
    """ + HOUR + """ AS pickup_hour,
    """ + DOW + """ AS pickup_dayofweek,
    """ + MONTH + """ AS pickup_month,
    CAST(CASE WHEN """ + DOW + """ IN (1, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    CAST(CASE WHEN """ + DOW + " NOT IN (1, 7) AND (" + HOUR + " BETWEEN 7 AND 9 OR " + HOUR + """ BETWEEN 16 AND 19)
         THEN 1 ELSE 0 END AS INTEGER) AS is_rush_hour,
    CAST(CASE WHEN store_and_fwd_flag = 'Y' THEN 1 ELSE 0 END AS INTEGER) AS store_fwd_flag_int,
    CASE WHEN RatecodeID = 99 THEN NULL ELSE CAST(RatecodeID AS INTEGER) END AS ratecode_clean,
    """ + SPEED + """ AS speed_mph_proxy
  FROM durok)"""

RAWF = """
rawf AS (
  SELECT t.*, """ + DUR + """ AS trip_duration_seconds,
    """ + DUR + """ / 60.0e0 AS trip_duration_min,
    CAST(CASE WHEN """ + NEG + """ THEN 1 ELSE 0 END AS INTEGER) AS has_negative_fee,
    CAST(CASE WHEN """ + NO_METER + """ THEN 1 ELSE 0 END AS INTEGER) AS no_meter,
    CASE WHEN """ + DUR + " > 0 THEN " + round2("trip_distance / (" + DUR + " / 3600.0e0)") + """ ELSE NULL END AS speed_mph_proxy,
    """ + HOUR + """ AS pickup_hour,
    """ + DOW + """ AS pickup_dayofweek,
    """ + MONTH + """ AS pickup_month
  FROM trips t)"""

REQUESTS = """
rq AS (
  SELECT l_orderkey*31 + l_partkey*17 + l_suppkey*7 + l_linenumber AS h, l_quantity FROM lineitem),
requests AS (
  SELECT
    CAST(CASE WHEN h % 29 = 0 THEN NULL ELSE h % 11 END AS BIGINT) AS passenger_count,
    l_quantity*0.3e0 AS trip_distance,
    CAST(h % 7 AS BIGINT) AS payment_type,
    CAST(h % 25 AS BIGINT) AS pickup_hour,
    CAST(h % 8 AS BIGINT) AS pickup_dayofweek,
    CAST(h % 13 AS BIGINT) AS pickup_month,
    CAST(h % 3 AS BIGINT) AS is_weekend,
    CASE h % 4 WHEN 0 THEN 'full' WHEN 1 THEN 'compressed' WHEN 2 THEN NULL ELSE 'other' END AS model_type
  FROM rq)"""

LOG = """
logbase AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS run_id, event_id, make_timestamp(epoch_us(CAST(ts AS TIMESTAMP)) // 3600) AS ts,
    value / 1000e0 AS latency,
    CAST(CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS INTEGER) AS status,
    event_type <> 'error' AS success
  FROM events),
log AS (
  SELECT run_id, event_id, ts, latency, status, success,
    CAST(row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS BIGINT) AS request_num,
    (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY run_id)) / 1e6 AS elapsed
  FROM logbase)"""


def with_ctes(*blocks: str, body: str) -> str:
    return "WITH " + ",".join(blocks) + "\n" + body
