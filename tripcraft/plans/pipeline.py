"""The cleaning pipeline: learn bounds, then one declarative plan from raw trips to the cleaned table.

Scans: pass 1 learns q75 of the raw total, pass 2 learns the distance quartiles after the money
filters, pass 3 is the cleaned plan itself (counts come from `stage_audit` / `Observation` on the
write, not from extra actions). The bounds enter the plan as literals, so `total_amount >= 0` and
the distance fence reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.functions import columns as C
from tripcraft.operators import features as FE
from tripcraft.operators import quality as Q


@dataclass(frozen=True)
class Bounds:
    q75_total: float
    q1_distance: float
    q3_distance: float
    k: float = S.DISTANCE_IQR_K
    floor: float = S.DISTANCE_FLOOR
    duration_min: int = S.DURATION_MIN
    duration_max: int = S.DURATION_MAX

    @property
    def distance_upper(self) -> float:
        return Q.distance_fence(self.q1_distance, self.q3_distance, self.k, self.floor)

    def as_dict(self) -> dict:
        return {**asdict(self), "distance_upper": self.distance_upper}

    def to_frame(self, spark) -> DataFrame:
        """One-row table of the bounds, to persist next to the cleaned data (streaming reuses it)."""
        return spark.createDataFrame([self.as_dict()])

    @classmethod
    def from_frame(cls, df: DataFrame) -> Bounds:
        row = df.first().asDict()
        return cls(**{k: row[k] for k in cls.__dataclass_fields__})


def learn_bounds(raw: DataFrame, quantiles: str = "approx", error: float = S.QUANTILE_ERROR) -> Bounds:
    """q75 of the raw total; q1/q3 of distance after the money filters (two column-pruned scans)."""
    (q75,) = Q.quantiles(raw, "total_amount", [0.75], quantiles, error)
    money = raw.select("trip_distance", "fare_amount", "total_amount", *S.NEG_FEE_COLUMNS).filter(Q.money_ok())
    q1, q3 = Q.quantiles(money, "trip_distance", [0.25, 0.75], quantiles, error)
    return Bounds(q75, q1, q3)


def bounds_from_sketches(sketches: DataFrame) -> Bounds:
    """Bounds of all days in a table of `quality.day_sketches` rows, without the data (rank error below 1 %)."""
    (q75,) = Q.sketch_quantiles(sketches, "total", [0.75])
    q1, q3 = Q.sketch_quantiles(sketches, "distance", [0.25, 0.75])
    return Bounds(q75, q1, q3)


def clean_trips(raw: DataFrame, bounds: Bounds | None = None, quantiles: str = "approx") -> DataFrame:
    """Raw trips (20 columns) -> cleaned trips (17 columns), lazily."""
    b = bounds or learn_bounds(raw, quantiles)
    df = Q.clean_money(raw, b.q75_total)
    df = Q.iqr_fence(df, "trip_distance", b.distance_upper)
    df = FE.clean_duration(FE.with_duration(df), b.duration_min, b.duration_max)
    df = FE.encode_categoricals(FE.temporal_features(df))
    df = FE.with_speed(df)
    return FE.drop_leakage(df).select(*S.CLEAN_COLUMNS)


def stage_audit(raw: DataFrame, b: Bounds) -> DataFrame:
    """Row counts after each cleaning stage, from ONE scan (conditional counts), tall (stage, rows)."""
    money = Q.money_ok()
    distance = (F.col("trip_distance") > 0) & (F.col("trip_distance") <= F.lit(b.distance_upper))
    duration = C.duration_seconds().between(b.duration_min, b.duration_max)
    over = C.overcharge(b.q75_total)
    wide = raw.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(money).alias("money"),
        F.count_if(money & over).alias("overcharge_flagged"),
        F.count_if(money & distance).alias("distance"),
        F.count_if(money & distance & duration).alias("duration"),
    )
    stages = ["raw", "money", "overcharge_flagged", "distance", "duration"]
    return wide.unpivot([], stages, "stage", "rows").select("stage", F.col("rows").cast("bigint").alias("rows"))


def describe(df: DataFrame, cols=S.DESCRIBE_COLUMNS) -> DataFrame:
    """count, mean, sample stddev, min, max per column in one aggregate; tall typed rows."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.col(f"{c}__count").cast("bigint").alias("n"),
                     F.round(F.col(f"{c}__mean"), 6).alias("mean"),
                     F.round(F.col(f"{c}__stddev"), 6).alias("stddev"),
                     F.col(f"{c}__min").alias("min_value"),
                     F.col(f"{c}__max").alias("max_value")) for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def raw_features(raw: DataFrame) -> DataFrame:
    """Derived columns of the raw-data exploration (no filtering): duration, minutes,
    int flags, guarded speed, temporal parts."""
    df = FE.with_duration(raw)
    return df.withColumns({
        "trip_duration_min": C.minutes("trip_duration_seconds"),
        "has_negative_fee": C.as_flag(C.any_negative()),
        "no_meter": C.as_flag(C.no_meter()),
        "speed_mph_proxy": C.speed_mph(guarded=True),
        "pickup_hour": F.hour("tpep_pickup_datetime"),
        "pickup_dayofweek": F.dayofweek("tpep_pickup_datetime"),
        "pickup_month": F.month("tpep_pickup_datetime"),
    })


def bounds_frame(raw: DataFrame, quantiles: str = "approx", error: float = S.QUANTILE_ERROR) -> DataFrame:
    """The cleaning bounds as a lazy one-row DataFrame (no driver round trip).

    Two global aggregates (raw q75; q1/q3 after the money filters), each a single row; the second
    is attached to the first as a scalar subquery.
    """
    money = raw.select("trip_distance", "fare_amount", "total_amount", *S.NEG_FEE_COLUMNS).filter(Q.money_ok())
    if quantiles == "exact":
        a = Q.exact_quantiles(raw, "total_amount", [0.75], names=["q75_total"])
        b = Q.exact_quantiles(money, "trip_distance", [0.25, 0.75], names=["q1_distance", "q3_distance"])
    else:
        acc = F.lit(int(round(1 / error)))
        a = raw.agg(F.percentile_approx("total_amount", F.lit(0.75), acc).cast("double").alias("q75_total"))
        b = money.agg(F.percentile_approx("trip_distance", F.lit(0.25), acc).cast("double").alias("q1_distance"),
                      F.percentile_approx("trip_distance", F.lit(0.75), acc).cast("double").alias("q3_distance"))
    upper = F.greatest(F.col("q3_distance") + S.DISTANCE_IQR_K * (F.col("q3_distance") - F.col("q1_distance")),
                       F.lit(S.DISTANCE_FLOOR))
    from tripcraft.operators.explore import with_scalars
    return with_scalars(a, b).select("q75_total", "q1_distance", "q3_distance", upper.alias("distance_upper"))
