"""Trip, request and request-log tables derived from the driver's star-schema tables.

The driver ships no trip table, so each trip is derived from one `lineitem` row by fixed
arithmetic on a row hash `h` (recipes in FIXTURES.md). Everything is a narrow projection:
no shuffle, scan columns pruned, so the derived tables scale with `lineitem` / `events`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Scans smaller than this are not spread over cores.
SPREAD_MIN_BYTES = 1 << 20

_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                  "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ensure_parallelism(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores (e.g. one small file
    with a single row group) evenly over all cores. A large many-file input is left untouched.

    The always-true filter on `spark_partition_id()` is nondeterministic, so the optimizer keeps
    later (deterministic) filters above it instead of pushing them below the exchange into the
    single scan task."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    # Tiny tables (dimensions) stay as they are: spreading them costs more than it saves.
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(size if isinstance(size, int) else size.toString()) < SPREAD_MIN_BYTES:
        return df
    return df.repartition(target).filter(F.spark_partition_id() >= 0)


def _row_hash() -> Column:
    return (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17
            + F.col("l_suppkey") * 7 + F.col("l_linenumber").cast("bigint"))


def _add_seconds(ts: Column, secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs.cast("int"), ts)


def _mod(k: int) -> Column:
    return F.col("h") % k


_DERIVED: dict[tuple, str] = {}


def input_stamp(spark: SparkSession, sf_dir: str, source: str) -> tuple:
    """What identifies an input table in this application: its path, and its files' names, lengths and times."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{source}.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return (spark.sparkContext.applicationId, path.toString(),
            tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)))


def derived_table(spark: SparkSession, sf_dir: str, name: str, source: str, build) -> DataFrame:
    """Write a table derived from the driver tables once per application into the shared
    checkpoint folder (Parquet, one file per task), then scan it like any raw input table.

    Queries then read real columns: their filters reach the Parquet scan as pushed filters instead
    of re-deriving (and inlining) the recipe per predicate, and the written table survives the
    loss of an executor."""
    from tripcraft.session import checkpoint_dir
    key = (*input_stamp(spark, sf_dir, source), name)
    path = _DERIVED.get(key)
    if path is None:
        path = f"{checkpoint_dir(spark).rstrip('/')}/derived/{name}-{uuid.uuid4().hex[:12]}"
        build(spark, sf_dir).write.mode("overwrite").parquet(path)
        _DERIVED[key] = path
    return spark.read.parquet(path)


def trips_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips (20 columns, raw trip schema) with planted nulls, negatives, zeros and sentinels."""
    return derived_table(spark, sf_dir, "trips", "lineitem", lambda s, d: trips_from_lineitem(table(s, d, "lineitem")))


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The trip recipe on any lineitem frame, batch or streaming (a pure projection)."""
    li = lineitem.select(*_LINEITEM_COLS).withColumn("h", _row_hash())
    null_row = _mod(29) == 0
    duration = (F.when(_mod(53) == 0, F.lit(-300))
                .when(_mod(47) == 0, F.lit(20000))
                .otherwise((F.col("l_quantity") * 45).cast("bigint") + _mod(901)))
    pickup = _add_seconds(F.col("l_shipdate").cast("timestamp_ntz"), (F.col("h") * 7919) % 86400)
    li = li.withColumn("pickup", pickup)
    return li.select(
        F.when(_mod(4) == 0, 1).when(_mod(4) == 1, 2).when(_mod(4) == 2, 6).otherwise(7)
        .cast("int").alias("VendorID"),
        F.col("pickup").alias("tpep_pickup_datetime"),
        _add_seconds(F.col("pickup"), duration).alias("tpep_dropoff_datetime"),
        F.when(null_row, F.lit(None)).otherwise(_mod(7)).cast("bigint").alias("passenger_count"),
        F.when(_mod(31) == 0, 0.0).when(_mod(997) == 0, 400.0)
        .otherwise(F.col("l_quantity") * 0.3).alias("trip_distance"),
        F.when(null_row, F.lit(None)).when(_mod(23) == 0, F.lit(99))
        .otherwise(_mod(6) + 1).cast("bigint").alias("RatecodeID"),
        F.when(null_row, F.lit(None)).when(_mod(19) == 0, F.lit("Y"))
        .otherwise(F.lit("N")).alias("store_and_fwd_flag"),
        (F.col("l_partkey") % 265 + 1).cast("bigint").alias("PULocationID"),
        ((F.col("l_suppkey") * 13) % 265 + 1).cast("bigint").alias("DOLocationID"),
        _mod(6).cast("bigint").alias("payment_type"),
        F.when(_mod(62) == 0, 0.0).otherwise(F.col("l_extendedprice") / 1500).alias("fare_amount"),
        (F.col("l_tax") * 10).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (F.col("l_discount") * 40).alias("tip_amount"),
        F.when((_mod(37) == 0) | (_mod(310) == 0), -6.94).when(_mod(5) == 0, 6.94)
        .otherwise(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.when(_mod(101) == 0, -F.col("l_extendedprice") / 1000)
        .otherwise(F.col("l_extendedprice") / 1000).alias("total_amount"),
        F.when(null_row, F.lit(None).cast("double")).when(_mod(41) == 0, -2.5)
        .otherwise(2.5).alias("congestion_surcharge"),
        F.when(null_row, F.lit(None).cast("double")).when(_mod(11) == 0, 1.75)
        .otherwise(0.0).alias("Airport_fee"),
        F.when(_mod(43) == 0, -0.75).otherwise(0.75).alias("cbd_congestion_fee"),
    )


def requests_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction requests (7 features + model_type); about a quarter pass the range rules."""
    return derived_table(spark, sf_dir, "requests", "lineitem", lambda s, d: requests_from_lineitem(table(s, d, "lineitem")))


def bodies_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request bodies as JSON text, with planted faults (quoted, fractional, absent and nested values, broken text)."""
    return derived_table(spark, sf_dir, "bodies", "lineitem", lambda s, d: bodies_from_lineitem(table(s, d, "lineitem")))


# Field -> its text by SQL that Spark and DuckDB read alike (h: the row hash, q: the quantity).
BODY_FIELDS = {
    "passenger_count": "CASE WHEN h % 29 = 0 THEN 'null' WHEN h % 13 = 0 THEN concat('\"', CAST(h % 11 AS STRING), '\"') "
                       "WHEN h % 17 = 0 THEN concat(CAST(h % 11 AS STRING), '.0') ELSE CAST(h % 11 AS STRING) END",
    "trip_distance": "CASE WHEN h % 23 = 0 THEN '\"far\"' WHEN h % 19 = 0 THEN concat('\" ', CAST(q AS STRING), '.25\"') "
                     "ELSE concat(CAST(q % 15 AS STRING), '.', CAST(h % 10 AS STRING)) END",
    "payment_type": "CASE WHEN h % 31 = 0 THEN '1.5' ELSE CAST(h % 7 AS STRING) END",
    "pickup_hour": "CAST(h % 25 AS STRING)",
    "pickup_dayofweek": "CASE WHEN h % 41 = 0 THEN '[1]' WHEN h % 7 = 0 THEN '1e0' ELSE CAST(h % 8 AS STRING) END",
    "pickup_month": "CASE WHEN h % 61 = 0 THEN '{\"m\": 1}' ELSE CAST(h % 13 AS STRING) END",
    "is_weekend": "CASE WHEN h % 5 = 0 THEN CASE WHEN h % 2 = 0 THEN 'true' ELSE 'false' END ELSE CAST(h % 3 AS STRING) END",
}
_PARTS = ", ".join(f"CASE WHEN h % 37 = 0 AND '{c}' = 'pickup_hour' THEN NULL ELSE concat('\"{c}\": ', {x}) END" for c, x in BODY_FIELDS.items())
BODY_SQL = f"""CASE WHEN h % 59 = 0 THEN NULL WHEN h % 53 = 0 THEN '' WHEN h % 43 = 0 THEN concat('{{', concat_ws(', ', {_PARTS}))
  WHEN h % 47 = 0 THEN concat('[{{', concat_ws(', ', {_PARTS}), '}}]') ELSE concat('{{', concat_ws(', ', {_PARTS}), '}}') END"""


def bodies_from_lineitem(lineitem: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity").withColumn("h", _row_hash())
    return li.withColumn("q", F.col("l_quantity").cast("bigint")).select("l_orderkey", "l_linenumber", F.expr(BODY_SQL).alias("body"))


def requests_from_lineitem(lineitem: DataFrame) -> DataFrame:
    li = (lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
          .withColumn("h", _row_hash()))
    return li.select(
        F.when(_mod(29) == 0, F.lit(None)).otherwise(_mod(11)).cast("bigint").alias("passenger_count"),
        (F.col("l_quantity") * 0.3).alias("trip_distance"),
        _mod(7).cast("bigint").alias("payment_type"),
        _mod(25).cast("bigint").alias("pickup_hour"),
        _mod(8).cast("bigint").alias("pickup_dayofweek"),
        _mod(13).cast("bigint").alias("pickup_month"),
        _mod(3).cast("bigint").alias("is_weekend"),
        F.when(_mod(4) == 0, "full").when(_mod(4) == 1, "compressed")
        .when(_mod(4) == 2, F.lit(None).cast("string")).otherwise("other").alias("model_type"),
    )


def request_log_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log without the per-run sequence columns (6 columns)."""
    return derived_table(spark, sf_dir, "request_log", "events", lambda s, d: log_from_events(table(s, d, "events")))


def log_from_events(events: DataFrame) -> DataFrame:
    """The request-log recipe on any events frame: a narrow projection, no shuffle. One hour of event time is one
    second of log time, so that the log looks like a load test."""
    fast = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz)) div 3600")
    second = F.timestamp_add("SECOND", F.floor(fast / 1_000_000).cast("int"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    ev = events.select("event_id", "ts", "user_id", "event_type", "value")
    return ev.select(
        F.when(F.col("user_id") % 2 == 0, "A").otherwise("B").alias("run_id"),
        F.col("event_id"),
        F.timestamp_add("MICROSECOND", F.pmod(fast, F.lit(1_000_000)).cast("int"), second).alias("ts"),
        (F.col("value") / 1000).alias("latency"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).cast("int").alias("status"),
        (F.col("event_type") != "error").alias("success"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log (8 columns): adds completion order and elapsed seconds per run (range-partitioned)."""
    from tripcraft.operators.loadtest import with_sequence
    return with_sequence(request_log_base(spark, sf_dir))
