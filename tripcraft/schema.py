"""Schemas, feature lists and fixed code/label tables of the trip data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw trip table: 20 columns, physical types of the 2025 yellow-taxi Parquet files.
RAW_TRIP_SCHEMA = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("RatecodeID", T.LongType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("PULocationID", T.LongType()),
    T.StructField("DOLocationID", T.LongType()),
    T.StructField("payment_type", T.LongType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("Airport_fee", T.DoubleType()),
    T.StructField("cbd_congestion_fee", T.DoubleType()),
])

RAW_COLUMNS = [f.name for f in RAW_TRIP_SCHEMA.fields]
MONEY_COLUMNS = [f.name for f in RAW_TRIP_SCHEMA.fields if isinstance(f.dataType, T.DoubleType)]

# Cleaned trip table: 17 columns, in this order.
CLEAN_COLUMNS = [
    "VendorID", "passenger_count", "trip_distance", "PULocationID", "DOLocationID", "payment_type",
    "flag_no_meter", "flag_overcharge", "trip_duration_seconds",
    "pickup_hour", "pickup_dayofweek", "pickup_month", "is_weekend", "is_rush_hour",
    "store_fwd_flag_int", "ratecode_clean", "speed_mph_proxy",
]

# Fee columns whose negative value marks a refund.
NEG_FEE_COLUMNS = ["tolls_amount", "congestion_surcharge", "cbd_congestion_fee"]

# Columns removed from the cleaned table: target leakage and raw columns superseded by features.
LEAKAGE_COLUMNS = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
    "Airport_fee", "cbd_congestion_fee",
    "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "store_and_fwd_flag",
    "RatecodeID",
]

TARGET = "trip_duration_seconds"

FULL_FEATURES = [
    "VendorID", "passenger_count", "trip_distance", "payment_type",
    "flag_no_meter", "flag_overcharge", "pickup_hour", "pickup_dayofweek",
    "pickup_month", "is_weekend", "is_rush_hour", "store_fwd_flag_int",
    "ratecode_clean",
]

# Also the fixed feature order of a prediction request.
REDUCED_FEATURES = [
    "passenger_count", "trip_distance", "payment_type",
    "pickup_hour", "pickup_dayofweek", "pickup_month", "is_weekend",
]

# Columns of the cleaned-data correlation heatmap.
CLEAN_CORR_COLUMNS = [
    "trip_duration_seconds", "trip_distance", "passenger_count",
    "pickup_hour", "pickup_dayofweek", "pickup_month",
    "is_weekend", "is_rush_hour", "store_fwd_flag_int",
    "ratecode_clean", "speed_mph_proxy",
    "flag_overcharge", "flag_no_meter",
]

# Columns of the raw-data correlation heatmap.
RAW_CORR_COLUMNS = [
    "trip_duration_seconds", "trip_distance", "passenger_count",
    "fare_amount", "extra", "tip_amount", "tolls_amount",
    "total_amount", "congestion_surcharge", "cbd_congestion_fee",
    "pickup_hour", "pickup_dayofweek", "pickup_month",
    "speed_mph_proxy", "has_negative_fee", "no_meter",
]

# Columns summarised by `describe` at the end of the cleaning job.
DESCRIBE_COLUMNS = ["trip_duration_seconds", "trip_distance", "speed_mph_proxy", "passenger_count", "pickup_hour"]

# --- Fixed values: code -> label tables (must equal the published labels) ---
DAY_SHORT = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat"}
MONTH_SHORT = {1: "Jan", 2: "Feb", 3: "Mar", 4: "Apr", 5: "May", 6: "Jun",
               7: "Jul", 8: "Aug", 9: "Sep", 10: "Oct", 11: "Nov", 12: "Dec"}
RATECODE_LABELS = {1: "Standard", 2: "JFK", 3: "Newark", 4: "Nassau/West.", 5: "Negotiated", 6: "Group"}
DAY_NAMES = {1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday",
             5: "Thursday", 6: "Friday", 7: "Saturday"}
PAYMENT_TYPES = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute", 5: "Unknown"}
MONTH_NAMES = {1: "January", 2: "February", 3: "March", 4: "April", 5: "May",
               6: "June", 7: "July", 8: "August", 9: "September", 10: "October",
               11: "November", 12: "December"}

# --- Fixed values: cleaning thresholds ---
DISTANCE_IQR_K = 3.0
DISTANCE_FLOOR = 250.0
DURATION_MIN = 60
DURATION_MAX = 10_800
QUANTILE_ERROR = 0.01

# --- Fixed values: accepted request ranges (inclusive unless noted) ---
# trip_distance is (0, 12]: lower bound exclusive.
REQUEST_RANGES = {
    "passenger_count": (0, 9),
    "trip_distance": (0.0, 12.0),
    "payment_type": (1, 5),
    "pickup_hour": (0, 23),
    "pickup_dayofweek": (1, 7),
    "pickup_month": (1, 12),
    "is_weekend": (0, 1),
}

REQUEST_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType() if c == "trip_distance" else T.LongType()) for c in REDUCED_FEATURES]
    + [T.StructField("model_type", T.StringType())]
)

# Model variants a request may choose; the compressed one is the default.
MODEL_VARIANTS = ("full", "compressed")
DEFAULT_VARIANT = "compressed"

# --- Fixed values: load-test summary metric names, in report order ---
SUMMARY_METRICS = [
    ("total_requests", "Total Requests"),
    ("successful", "Successful"),
    ("failed", "Failed"),
    ("error_rate_pct", "Error Rate (%)"),
    ("total_time_s", "Total Time (s)"),
    ("throughput_rps", "Throughput (req/s)"),
    ("mean_latency_ms", "Mean Latency (ms)"),
    ("median_latency_ms", "Median Latency (ms)"),
    ("p95_latency_ms", "P95 Latency (ms)"),
    ("p99_latency_ms", "P99 Latency (ms)"),
    ("min_latency_ms", "Min Latency (ms)"),
    ("max_latency_ms", "Max Latency (ms)"),
]

# Zone dimension (CSV with header).
ZONE_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

# Sizes the models are fitted at.
FOREST_ROWS = 100_000
SAMPLE_ROWS = 200_000
