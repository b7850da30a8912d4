"""Registered streaming queries: each drives a Structured Streaming job over the whole input table
(file stream, availableNow trigger) and returns what its sink received."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tripcraft.plans import oracle_sql as O
from tripcraft.plans.q_ml import linear_variants, train_test
from tripcraft.plans.queries import ORACLE, W, query, trips
from tripcraft.plans import pipeline as P
from tripcraft.session import checkpoint_dir
from tripcraft.sources import fixtures as X
from tripcraft.streaming import live as LV
from tripcraft.streaming import stream as ST


def _stream(spark, sf, name):
    schema = X.table(spark, sf, name).schema
    return ST.read_stream(spark, f"{sf}/{name}*.parquet", schema)


def _base(spark, prefix):
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{prefix}_{uuid.uuid4().hex[:8]}"


@query("stream_window_metrics", """
WITH l AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS run_id, CAST(ts AS TIMESTAMP) AS ts,
                  value / 1000e0 AS latency, event_type <> 'error' AS success FROM events),
g AS (SELECT run_id, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
             count(*) AS requests, round(avg(latency * 1000.0e0), 6) AS mean_latency_ms,
             round(max(latency * 1000.0e0), 6) AS max_latency_ms,
             round(avg(CASE WHEN success THEN 0.0e0 ELSE 100.0e0 END), 6) AS error_rate_pct
      FROM l GROUP BY ALL)
SELECT * FROM g""")
def q_stream_window_metrics(spark, sf):
    """Hourly event-time windows per run, 10-minute watermark; open windows are flushed at the end of the input."""
    log = ST.with_stream_log(_stream(spark, sf, "events"))
    base = _base(spark, "win")
    return ST.run_to_latest(ST.stream_metrics(log, window="1 hour", delay="10 minutes"),
                            ["run_id", "window_start", "window_end"], f"{base}/out", f"{base}/checkpoint")


@query("stream_clean_trips")
def q_stream_clean_trips(spark, sf):
    """Streaming cleaning of trips derived from a lineitem file stream, bounds from the batch job."""
    bounds = P.learn_bounds(trips(spark, sf), quantiles="exact")
    stream_trips = X.trips_from_lineitem(_stream(spark, sf, "lineitem"))
    base = _base(spark, "clean")
    return ST.run_to_table(ST.stream_clean(stream_trips, bounds), f"{base}/out", f"{base}/checkpoint")


ORACLE["stream_clean_trips"] = ORACLE["clean_trips"]


@query("stream_score_requests")
def q_stream_score_requests(spark, sf):
    """Request stream -> validation -> scoring; accepted and rejected rows land in two sinks."""
    train, _ = train_test(spark, sf)
    models, params = linear_variants(train)
    base = _base(spark, "score")
    q = ST.stream_score(X.requests_from_lineitem(_stream(spark, sf, "lineitem")), models, params,
                        f"{base}/scored", f"{base}/rejected", f"{base}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/scored").drop("_batch_id", "batch_id")


ORACLE["stream_score_requests"] = ORACLE["score_requests"]


@query("live_latency", W(O.LOG, body="""
SELECT run_id, event_id, request_num, round(elapsed, 6) AS elapsed, round(latency * 1000.0e0, 6) AS latency_ms,
  round(CAST(sum(CAST(latency AS DECIMAL(38, 9))) OVER w AS DOUBLE) / least(request_num, 100) * 1000.0e0, 6) AS rolling_avg_ms,
  round(CAST(sum(CAST(latency AS DECIMAL(38, 9))) OVER a AS DOUBLE) / request_num * 1000.0e0, 6) AS mean_latency_ms,
  CAST(sum(CASE WHEN success THEN 0 ELSE 1 END) OVER a AS BIGINT) AS failed, CAST(0 AS BIGINT) AS late
FROM log WINDOW w AS (PARTITION BY run_id ORDER BY request_num ROWS BETWEEN 99 PRECEDING AND CURRENT ROW),
  a AS (PARTITION BY run_id ORDER BY request_num ROWS UNBOUNDED PRECEDING)"""))
def q_live_latency(spark, sf, files=4):
    """The whole request log as a stream of files in order of arrival, up to 8 seconds (hash of the request) after
    their time, so that files overlap: live number, rolling mean of 100, running mean, failures; late requests."""
    log = X.request_log_base(spark, sf)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    log = log.withColumn("arrival", micros + F.pmod(F.xxhash64("event_id"), F.lit(8_000_000)))
    ends = log.agg(F.min("arrival"), F.max("arrival")).first()
    base, first = _base(spark, "live"), ends[0] or 0
    step = ((ends[1] or 0) - first) // files + 1
    tasks = max(1, log.sparkSession.sparkContext.defaultParallelism)
    for k in range(files):  # one after the other: a file stream goes by modification time
        log.where(F.floor((F.col("arrival") - first) / step) == k).drop("arrival").coalesce(tasks).write.parquet(f"{base}/log/{k}")
    live = LV.live_requests(ST.read_stream(spark, f"{base}/log/*/*.parquet", log.drop("arrival").schema, max_files=tasks))
    out, late = LV.run_live(live, f"{base}/out", f"{base}/checkpoint")
    numbers = ("elapsed", "latency_ms", "rolling_avg_ms", "mean_latency_ms")
    return out.withColumns({c: F.round(c, 6) for c in numbers}).withColumn("late", F.lit(late).cast("long"))
