"""Feature derivation: duration, temporal parts, categorical encodings, speed, leakage drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.functions import columns as C


def with_duration(df: DataFrame) -> DataFrame:
    return df.withColumn("trip_duration_seconds", C.duration_seconds())


def clean_duration(df: DataFrame, lo: int = S.DURATION_MIN, hi: int = S.DURATION_MAX) -> DataFrame:
    return df.filter(F.col("trip_duration_seconds").between(lo, hi))


def temporal_features(df: DataFrame, ts: str = "tpep_pickup_datetime") -> DataFrame:
    """Hour, day of week (1 = Sunday), month, weekend and rush-hour flags of the pickup time."""
    t = F.col(ts)
    return (df.withColumns({
        "pickup_hour": F.hour(t),
        "pickup_dayofweek": F.dayofweek(t),
        "pickup_month": F.month(t),
        "is_weekend": C.is_weekend(F.dayofweek(t)),
    }).withColumn("is_rush_hour", C.is_rush_hour(F.col("pickup_hour"), F.col("is_weekend"))))


def encode_categoricals(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "store_fwd_flag_int": C.yes_no_flag("store_and_fwd_flag"),
        "ratecode_clean": C.sentinel_to_null("RatecodeID"),
    })


def with_speed(df: DataFrame, guarded: bool = False) -> DataFrame:
    return df.withColumn("speed_mph_proxy", C.speed_mph(guarded))


def drop_leakage(df: DataFrame) -> DataFrame:
    return df.drop(*S.LEAKAGE_COLUMNS)


def training_frame(df: DataFrame, population: str = "full") -> DataFrame:
    """Modelling population from the cleaned table.

    full:    drop speed and zone ids, then drop rows with any null (code-99 rows go).
    reduced: keep the 7 request features and the target first, then drop nulls (code-99 rows stay).
    Both are projections before the null filter, so the Parquet scan reads only the needed columns.
    """
    if population == "full":
        return df.drop("speed_mph_proxy", "PULocationID", "DOLocationID").dropna("any")
    if population == "reduced":
        return df.select(*S.REDUCED_FEATURES, S.TARGET).dropna("any")
    raise ValueError(f"population must be 'full' or 'reduced', not {population!r}")


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).dropna("any")


def keep_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Select the listed columns that exist, in list order."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def to_double(df: DataFrame, cols: Sequence[str], strict: bool = True) -> DataFrame:
    """Cast columns to double. strict=False uses try_cast: failures become null instead of errors."""
    conv = {c: (F.col(c).cast("double") if strict else F.col(c).try_cast("double")) for c in cols}
    return df.withColumns(conv)


def zoom(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Keep rows inside every inclusive [lo, hi] range; None leaves a side open."""
    cond = F.lit(True)
    for c, (lo, hi) in ranges.items():
        if lo is not None:
            cond = cond & (F.col(c) >= lo)
        if hi is not None:
            cond = cond & (F.col(c) <= hi)
    return df.filter(cond)


def known_codes(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    return df.filter(F.col(column).isin(list(mapping)))
