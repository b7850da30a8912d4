"""Data-quality operators: refund/no-meter flags, money filters, quantile fences, stage audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.functions import columns as C


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, weight: str | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (per group when `by`), nulls and NaN ignored. `weight` names a
    count column of a table that is already (value, count).

    No task sees all values of a group. Rows collapse to (group, value, count) by a hash aggregate;
    that table is range-partitioned on (group, value) and written once; the counts per (group,
    partition) give the partition that holds each wanted rank; and only those partitions are
    summed in order, each in its own task. A group's quantile at p lies at rank (n - 1) p between
    the two neighbouring ranks."""
    from tripcraft.operators.explore import join_small
    from tripcraft.session import stored
    names, keys = list(names or [f"q{i}" for i in range(len(probs))]), list(by)
    x = F.col(column)
    real = df.filter(x.isNotNull() & ~F.isnan(x.cast("double"))).select(
        *keys, x.cast("double").alias("_v"), (F.col(weight) if weight else F.lit(1)).alias("_w"))
    counts = real.groupBy(*keys, "_v").agg(F.sum("_w").alias("_w"))
    values, _ = stored(counts.repartitionByRange(*keys, "_v").withColumn("_pid", F.spark_partition_id()), "values")
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    parts = values.groupBy(*keys, "_pid").agg(F.sum("_w").alias("_n")).withColumns({
        "_upto": F.sum("_n").over(whole.orderBy("_pid")), "_total": F.sum("_n").over(whole)})
    ranks = F.array(*(F.struct(F.lit(2 * i + side).alias("slot"), f((F.col("_total") - 1) * F.lit(float(p))).cast("long").alias("k"))
                      for i, p in enumerate(probs) for side, f in enumerate((F.floor, F.ceil))))
    here = F.filter(ranks, lambda r: (r["k"] < F.col("_upto")) & (r["k"] >= F.col("_upto") - F.col("_n")))
    parts = parts.select(*keys, "_pid", "_total", (F.col("_upto") - F.col("_n")).alias("_before"), here.alias("_here")).filter(
        F.size("_here") > 0)
    inside = join_small(values, parts, [*keys, "_pid"])
    upto = F.col("_before") + F.sum("_w").over(Window.partitionBy(*keys, "_pid").orderBy("_v"))
    hits = inside.withColumn("_upto", upto).select(*keys, "_v", "_total", F.explode(F.filter(
        "_here", lambda r: (r["k"] < F.col("_upto")) & (r["k"] >= F.col("_upto") - F.col("_w")))).alias("r"))
    ends = hits.groupBy(*keys).agg(F.max("_total").alias("_total"), *(
        F.max(F.when(F.col("r.slot") == k, F.col("_v"))).alias(f"_s{k}") for k in range(2 * len(probs))))

    def between(i: int, p: float) -> Column:
        at, low, high = (F.col("_total") - 1) * F.lit(float(p)), F.col(f"_s{2 * i}"), F.col(f"_s{2 * i + 1}")
        return F.when((F.floor(at) == F.ceil(at)) | (low == high), low).otherwise(
            (F.ceil(at) - at) * low + (at - F.floor(at)) * high)

    return ends.select(*keys, *(between(i, p).alias(n) for i, (p, n) in enumerate(zip(probs, names, strict=True))))


def quantiles(df: DataFrame, column: str, probs: Sequence[float], method: str = "approx",
              error: float = S.QUANTILE_ERROR) -> list[float]:
    """Quantiles of a column, nulls ignored.

    approx: Greenwald-Khanna sketches per partition merged on the driver (`approxQuantile`),
            state O(1/error) per task, result is an existing value within rank error.
    exact:  linear interpolation (as pandas / numpy) via `exact_quantiles`; no task holds all values.
    """
    probs = [float(p) for p in probs]
    if method == "approx":
        return [float(v) for v in df.approxQuantile(column, probs, error)]
    if method != "exact":
        raise ValueError(f"method must be 'approx' or 'exact', not {method!r}")
    row = exact_quantiles(df, column, probs).first()
    if row is None:
        return [None] * len(probs)
    return [None if row[i] is None else float(row[i]) for i in range(len(probs))]


SKETCH_K = 800  # normalised rank error of a sketch about 0.4 %


def day_sketches(raw: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One row per pickup day with mergeable KLL sketches of what the cleaning bounds need: `total`, the raw total
    amounts, and `distance`, the distances of rows that pass the money rules. One scan and one aggregate with map-side
    sketches; a new day's rows make a new row, and no earlier day is read again."""
    present = lambda c: F.when(~F.isnan(c), c)
    return raw.groupBy(F.to_date("tpep_pickup_datetime").alias("day")).agg(
        F.kll_sketch_agg_double(present(F.col("total_amount")), F.lit(k)).alias("total"),
        F.kll_sketch_agg_double(F.when(money_ok(), present(F.col("trip_distance"))), F.lit(k)).alias("distance"))


def sketch_quantiles(sketches: DataFrame, column: str, probs: Sequence[float], k: int = SKETCH_K) -> list[float]:
    """Quantiles from the merged sketches of all rows (k is the merged sketch's size)."""
    merged = sketches.agg(F.kll_merge_agg_double(column, F.lit(k)).alias("s")).where(F.kll_sketch_get_n_double("s") > 0)
    row = merged.select(*(F.kll_sketch_get_quantile_double("s", F.lit(float(p))) for p in probs)).first()
    return [None] * len(probs) if row is None else [float(v) for v in row]


def money_ok() -> Column:
    """Row survives the money rules: not a refunded no-meter trip, and a non-negative total.

    Three-valued: a null `no_meter` with a negative fee gives null, and the row is dropped.
    """
    return ~(C.any_negative() & C.no_meter()) & (F.col("total_amount") >= 0)


def with_money_flags(df: DataFrame, q75: float) -> DataFrame:
    return df.withColumns({
        "flag_no_meter": C.as_flag(C.no_meter()),
        "flag_overcharge": C.as_flag(C.overcharge(q75)),
    })


def clean_money(df: DataFrame, q75: float) -> DataFrame:
    """Flag no-meter and overcharge trips, drop ghost refunds and negative totals."""
    return with_money_flags(df, q75).filter(~(C.any_negative() & C.no_meter())).filter(F.col("total_amount") >= 0)


def distance_fence(q1: float, q3: float, k: float = S.DISTANCE_IQR_K, floor: float = S.DISTANCE_FLOOR) -> float:
    """Upper fence q3 + k*IQR, never below the domain floor."""
    return max(q3 + k * (q3 - q1), floor)


def iqr_fence(df: DataFrame, column: str, upper: float) -> DataFrame:
    """Keep 0 < x <= upper (both comparisons push down to the Parquet scan)."""
    return df.filter((F.col(column) > 0) & (F.col(column) <= F.lit(float(upper))))


def duration_ok(lo: int = S.DURATION_MIN, hi: int = S.DURATION_MAX) -> Column:
    return F.col("trip_duration_seconds").between(lo, hi)


def negative_counts(df: DataFrame, cols: Sequence[str] = S.NEG_FEE_COLUMNS) -> DataFrame:
    """Negative-value count per fee column and its share of all rows, in one scan."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(F.col(c) < 0).alias(c) for c in cols]
    wide = df.agg(*aggs)
    tall = wide.unpivot(["_n"], list(cols), "column_name", "negative_rows")
    return tall.select(
        "column_name",
        F.col("negative_rows").cast("bigint").alias("negative_rows"),
        F.round(F.try_divide(F.col("negative_rows") * 100.0, F.col("_n")), 6).alias("pct_of_rows"),
    )
