"""Column expressions used by the cleaning, exploration and scoring operators.

All are built-in Spark expressions, so they compile into whole-stage codegen and push
through projections; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripcraft import schema as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_flag(cond: Column) -> Column:
    """Boolean condition -> int 0/1; a null condition counts as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def any_negative(cols: Sequence[str] = S.NEG_FEE_COLUMNS) -> Column:
    """True when any of the columns is negative; never null (a null fee counts as not negative)."""
    return F.greatest(*[as_flag(F.col(c) < 0) for c in cols]) > 0


def no_meter() -> Column:
    """Zero distance and zero fare; null when either is null."""
    return (F.col("trip_distance") == 0) & (F.col("fare_amount") == 0)


def overcharge(q75: float, cols: Sequence[str] = S.NEG_FEE_COLUMNS) -> Column:
    """Negative fee on a trip whose total is above the raw 75th percentile of the total."""
    return any_negative(cols) & (F.col("total_amount") > F.lit(float(q75)))


def duration_seconds(start: str = "tpep_pickup_datetime", end: str = "tpep_dropoff_datetime") -> Column:
    """Whole seconds between two wall-clock timestamps, as int.

    `unix_timestamp` on timestamp_ntz ignores the session zone (a clock-change night is not
    shortened) and truncates fractions; `try_cast` yields null instead of an ANSI overflow error.
    """
    return (F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))).try_cast("int")


def speed_mph(guarded: bool = False) -> Column:
    """distance / hours, rounded to 2 places. Guarded form: null unless duration > 0."""
    value = F.round(F.col("trip_distance") / (F.col("trip_duration_seconds") / 3600.0), 2)
    if guarded:
        return F.when(F.col("trip_duration_seconds") > 0, value).otherwise(F.lit(None).cast("double"))
    return value


def is_weekend(dow: Column) -> Column:
    """Day 1 (Sunday) or 7 (Saturday) -> 1; a null day -> 0."""
    return as_flag(dow.isin(1, 7))


def is_rush_hour(hour: Column, weekend: Column) -> Column:
    """Weekday hours 7-9 or 16-19 inclusive."""
    return as_flag((weekend == 0) & (hour.between(7, 9) | hour.between(16, 19)))


def yes_no_flag(c: str | Column) -> Column:
    """'Y' -> 1, anything else including null -> 0."""
    return as_flag(col(c) == "Y")


def sentinel_to_null(c: str | Column, sentinel: int = 99) -> Column:
    """Sentinel code -> null, any other value (null stays null) -> int."""
    c = col(c)
    return F.when(c == F.lit(sentinel).cast("bigint"), F.lit(None).cast("int")).otherwise(c.cast("int"))


def minutes(c: str | Column) -> Column:
    return col(c) / 60.0


def label(c: str | Column, mapping: Mapping[int, str]) -> Column:
    """Code -> label through a literal map; unmatched codes give null."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[col(c).cast("int")] if pairs else F.lit(None).cast("string")


def unlabel(c: str | Column, mapping: Mapping[int, str]) -> Column:
    """Label -> code, the inverse of `label`; unmatched labels give null."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(v), F.lit(k)]
    return F.create_map(*pairs)[col(c)]


def flag_label(flags: Sequence[str], sep: str = ", ", names: Sequence[str] | None = None) -> Column:
    """Composite label such as 'neg_fee=1, no_meter=0' from integer flag columns."""
    fmt = sep.join(f"{name}=%d" for name in (names or flags))
    return F.format_string(fmt, *[F.col(f).cast("int") for f in flags])


def hour_band(hour: str | Column) -> Column:
    """'rush' for hours 7-9 and 16-19, else 'other'."""
    h = col(hour)
    return F.when(h.between(7, 9) | h.between(16, 19), "rush").otherwise("other")


def day_kind(dow: str | Column) -> Column:
    """'weekend' for days 1 and 7, else 'weekday'."""
    return F.when(col(dow).isin(1, 7), "weekend").otherwise("weekday")


def format_duration(seconds: str | Column) -> Column:
    """Whole minutes and remaining whole seconds of a non-negative duration, e.g. '12 min 5 sec'."""
    s = col(seconds)
    return F.format_string("%d min %d sec", F.floor(s / 60).cast("bigint"), F.floor(F.pmod(s, F.lit(60.0))).cast("bigint"))


def nan_to_null(c: str | Column) -> Column:
    """NaN -> null, so NaN behaves as missing (pandas semantics) in aggregates."""
    return F.nanvl(col(c), F.lit(None).cast("double"))
