"""Scans, sinks and small source operators (inventory A1-A11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft import schema as S


def read_trips(spark: SparkSession, path: str, nan_as_null: bool = False) -> DataFrame:
    """Raw trip Parquet directory with the declared schema (no footer inference across files).

    Columns are read as they are, so the cleaning predicates reach the scan as pushed filters
    (Spark semantics: NaN compares greater than any number). `nan_as_null=True` turns NaN doubles
    into nulls first, as pandas treats them, at the cost of that pushdown.
    """
    df = spark.read.schema(S.RAW_TRIP_SCHEMA).parquet(path)
    if not nan_as_null:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in S.MONEY_COLUMNS})


def file_schemas(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(file, its footer's schema as text) of every Parquet file below a folder or glob, in name order."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.parquet.hadoop
    files = [r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(path).select("path").collect()]
    out = []
    for name in sorted(files):
        reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(name), conf))
        try:
            out.append((name, reader.getFileMetaData().getSchema().toString()))
        finally:
            reader.close()
    return out


def read_trips_mixed(spark: SparkSession, path: str, schema=S.RAW_TRIP_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """Raw trips from files whose columns differ in physical type, name case or presence, and a report of it.

    Monthly files store a column as 32-bit, as 64-bit or as double; one declared schema cannot read them all. Files are
    grouped by the schema in their footer (one small read a file), each group is one scan with its own types, its
    columns are cast to the declared ones, and the groups are united: as many scans as distinct schemas, so filters
    and column pruning still reach Parquet. Values that the declared type cannot hold become null.

    The report has one row per (schema group, column) that differs: files, column, found (null if absent), declared."""
    groups: dict[str, list[str]] = {}
    for name, text in file_schemas(spark, path):
        groups.setdefault(text, []).append(name)
    union, report = None, []
    for files in groups.values():
        part = spark.read.parquet(*files)
        found = {f.name.lower(): f for f in part.schema}
        columns = []
        for want in schema:
            have = found.get(want.name.lower())
            if have is None:
                columns.append(F.lit(None).cast(want.dataType).alias(want.name))
            else:
                same = have.dataType == want.dataType
                columns.append((F.col(have.name) if same else F.col(have.name).try_cast(want.dataType)).alias(want.name))
            if have is None or have.dataType != want.dataType:
                report.append((len(files), want.name, have.dataType.simpleString() if have else None, want.dataType.simpleString()))
        part = part.select(*columns)
        union = part if union is None else union.unionByName(part)
    if union is None:
        union = spark.createDataFrame([], schema)
    return union, spark.createDataFrame(report, "files int, column string, found string, declared string")


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_cleaned(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite Parquet sink; optional partition columns (e.g. pickup_month) for later pruning."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def bounded_sample(df: DataFrame, n: int = S.SAMPLE_ROWS, seed: int = 42, total: int | None = None,
                   key: Column | None = None) -> DataFrame:
    """Seeded Bernoulli sample of about n rows: fraction min(1, n / count). With an integer `key`, the sample is
    repeatable in any engine: rows whose key modulo 1,000,000 is below the fraction."""
    total = df.count() if total is None else total
    frac = 1.0 if total == 0 else min(1.0, n / total)
    if frac >= 1.0:
        return df
    return df.sample(fraction=frac, seed=seed) if key is None else df.filter(F.pmod(key, F.lit(1_000_000)) < int(frac * 1_000_000))


def eval_sample(df: DataFrame, fraction: float = 0.05, seed: int = 42, key: Column | None = None) -> DataFrame:
    if key is not None:
        return df.filter(F.pmod(key, F.lit(1_000_000)) < int(fraction * 1_000_000))
    return df.sample(fraction=fraction, seed=seed)


def preview(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """First n rows under a stable order (a top-n: each task keeps n rows, no full sort)."""
    return df.orderBy(*keys).limit(n)


def summary_to_tall(df: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
    """Wide one-row-per-run summary -> tall (metric, value) rows in report order."""
    names = dict(S.SUMMARY_METRICS)
    value_cols = [c for c, _ in S.SUMMARY_METRICS if c in df.columns]
    casted = df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in value_cols])
    tall = casted.unpivot(list(id_cols), value_cols, "metric_key", "value")
    label = F.create_map(*[x for c in value_cols for x in (F.lit(c), F.lit(names[c]))])
    order = F.create_map(*[x for i, c in enumerate(value_cols) for x in (F.lit(c), F.lit(i + 1))])
    return tall.select(*id_cols, order[F.col("metric_key")].alias("position"),
                       label[F.col("metric_key")].alias("metric"), "value")


def read_summary_csv(spark: SparkSession, path: str) -> DataFrame:
    """Published load-test summary CSV (BOM, empty first header -> `_c0`) -> (metric, value)."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    first, second = df.columns[0], df.columns[1]
    return df.select(F.regexp_replace(F.col(first), "^﻿", "").alias("metric"),
                     F.col(second).cast("double").alias("value"))


def write_summary_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def synthetic_requests(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """n random valid requests (ranges of the reference load generator), generated on executors.

    Day 1-7, passengers 0-6, distance U(0.1, 11.0) rounded to 2, payment in {1,2,3,4},
    hour 0-23, month 1-12, weekend derived from the day.
    """
    def uniform_int(lo: int, hi: int, k: int):
        return (F.floor(F.rand(seed + k) * (hi - lo + 1)) + lo).cast("bigint")

    base = spark.range(n).select(
        F.col("id").alias("request_id"),
        uniform_int(0, 6, 1).alias("passenger_count"),
        F.round(F.rand(seed + 2) * 10.9 + 0.1, 2).alias("trip_distance"),
        uniform_int(1, 4, 3).alias("payment_type"),
        uniform_int(0, 23, 4).alias("pickup_hour"),
        uniform_int(1, 7, 5).alias("pickup_dayofweek"),
        uniform_int(1, 12, 6).alias("pickup_month"),
    )
    return base.withColumn("is_weekend", F.col("pickup_dayofweek").isin(1, 7).cast("bigint"))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV (265 rows); the literal text 'N/A' stays a string."""
    return spark.read.option("header", True).schema(S.ZONE_SCHEMA).csv(path)
