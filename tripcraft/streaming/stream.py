"""Structured Streaming jobs (inventory I1-I3), each with a batch twin.

I1 `stream_metrics`: live request metrics per tumbling event-time window; late rows beyond the
   watermark are dropped (Spark filters late input with the previous batch's watermark), state is
   bounded by the watermark. `run_to_latest` drives it with the windows still open at the end.
I2 `stream_score`: validates and scores a request stream; `foreachBatch` writes accepted and
   rejected rows to two sinks (idempotent per batch id, so a retried batch does not duplicate).
I3 `stream_clean`: stateless cleaning of a trip stream with bounds learnt by the batch job.

Watermarks need `timestamp` (not timestamp_ntz) columns, so wall-clock times are cast first.
Sinks and checkpoints are folders that the caller names; they have to be shared by all executors.
"""

from __future__ import annotations

import uuid
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripcraft import schema as S
from tripcraft.functions import columns as C
from tripcraft.operators import features as FE
from tripcraft.operators import quality as Q
from tripcraft.operators import score as SC
from tripcraft.plans.pipeline import Bounds


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet file stream (a directory or a glob); new files are picked up as they land."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def stream_metrics(log: DataFrame, window: str = "1 second", delay: str = "10 seconds", run: str = "run_id",
                   ts: str = "ts") -> DataFrame:
    """Per run and tumbling window: requests, mean and max latency (ms), error rate (%)."""
    t = F.col(ts).cast("timestamp")
    return (log.withColumn("_t", t).withWatermark("_t", delay)
            .groupBy(F.col(run), F.window("_t", window).alias("w"))
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.avg(F.col("latency") * 1000.0).alias("mean_latency_ms"),
                 F.max(F.col("latency") * 1000.0).alias("max_latency_ms"),
                 F.avg(F.when(F.col("success"), 0.0).otherwise(100.0)).alias("error_rate_pct"))
            .select(run, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    F.col("requests").cast("bigint").alias("requests"),
                    F.round("mean_latency_ms", 6).alias("mean_latency_ms"),
                    F.round("max_latency_ms", 6).alias("max_latency_ms"),
                    F.round("error_rate_pct", 6).alias("error_rate_pct")))


def stream_clean(trips: DataFrame, bounds: Bounds) -> DataFrame:
    """Cleaning with frozen bounds: every step is a per-row filter or projection (no state)."""
    df = Q.clean_money(trips, bounds.q75_total)
    df = Q.iqr_fence(df, "trip_distance", bounds.distance_upper)
    df = FE.clean_duration(FE.with_duration(df), bounds.duration_min, bounds.duration_max)
    df = FE.with_speed(FE.encode_categoricals(FE.temporal_features(df)))
    return FE.drop_leakage(df).select(*S.CLEAN_COLUMNS)


def score_batch(batch: DataFrame, models, scaler_params, **kw) -> tuple[DataFrame, DataFrame]:
    valid, rejected = SC.validate_requests(batch)
    return SC.score_requests(valid, models, scaler_params, **kw), rejected.withColumn("reasons", F.array_join("reasons", ","))


def stream_score(requests: DataFrame, models, scaler_params, scored_path: str, rejected_path: str,
                 checkpoint: str, trigger: dict | None = None, **kw) -> StreamingQuery:
    """Score a request stream; scored and rejected rows go to two Parquet sinks per micro-batch.

    `checkpoint` must be the same folder in every run into the same sinks: batch numbers go on where the
    last run stopped, so a restart neither repeats nor overwrites what is there."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        # The micro-batch feeds two sinks: keep it once instead of re-reading the source twice.
        batch = batch.persist()
        try:
            scored, rejected = score_batch(batch.withColumn("_batch_id", F.lit(batch_id)), models, scaler_params, **kw)
            # Per-batch partitions make a retried batch overwrite itself instead of appending twice.
            scored.write.mode("overwrite").parquet(f"{scored_path}/batch_id={batch_id}")
            rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    w = requests.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Drive a stateless streaming DataFrame over all available input into a Parquet sink; return the table.
    The sink's log makes each micro-batch count once, also over restarts with the same checkpoint."""
    df.writeStream.outputMode("append").format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_to_latest(df: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Drive a streaming aggregate in update mode: every micro-batch writes the rows it changed to its own
    folder (a repeated batch overwrites itself), and the table is each key's row of the last batch. Windows
    that are still open when the input ends are part of it."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    df.writeStream.outputMode("update").foreachBatch(sink).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    rows = df.sparkSession.read.schema(f"{_ddl(df)}, batch_id long").option("basePath", path).parquet(path)
    rest = [c for c in df.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_r"))
    return last.select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest)).select(*df.columns)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def with_stream_log(events: DataFrame) -> DataFrame:
    """Request-log columns from an events stream (same recipe as the batch fixture)."""
    return events.select(
        F.when(F.col("user_id") % 2 == 0, "A").otherwise("B").alias("run_id"),
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), (F.col("value") / 1000).alias("latency"),
        (F.col("event_type") != "error").alias("success"))

