"""Registered request-log queries (A9, D16-D19, D21, E1-E3, H) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.functions import columns as C
from tripcraft.operators import loadtest as L
from tripcraft.plans import oracle_sql as O
from tripcraft.plans.queries import CLEAN_CTES, W, cleaned, query
from tripcraft.sources import fixtures as X
from tripcraft.sources.io import summary_to_tall

R2 = O.round2

SUMMARY = """
summ AS (
  SELECT run_id, count(*) AS n, count(*) FILTER (WHERE success) AS ok, max(elapsed) AS wall, avg(latency) AS mean,
    quantile_cont(latency, 0.5) AS p50, quantile_cont(latency, 0.95) AS p95, quantile_cont(latency, 0.99) AS p99,
    min(latency) AS mn, max(latency) AS mx FROM log GROUP BY run_id),
summary AS (
  SELECT run_id, n AS total_requests, ok AS successful, n - ok AS failed,
    """ + R2("(n - ok) * 100.0e0 / n") + """ AS error_rate_pct,
    """ + R2("wall") + """ AS total_time_s,
    CASE WHEN wall = 0 THEN NULL ELSE """ + R2("n / wall") + """ END AS throughput_rps,
    """ + R2("mean * 1000.0e0") + """ AS mean_latency_ms,
    """ + R2("p50 * 1000.0e0") + """ AS median_latency_ms,
    """ + R2("p95 * 1000.0e0") + """ AS p95_latency_ms,
    """ + R2("p99 * 1000.0e0") + """ AS p99_latency_ms,
    """ + R2("mn * 1000.0e0") + """ AS min_latency_ms,
    """ + R2("mx * 1000.0e0") + """ AS max_latency_ms
  FROM summ)"""

TALL = """
tall AS (""" + " UNION ALL ".join(
    f"SELECT run_id, {i + 1} AS position, '{label}' AS metric, CAST({key} AS DOUBLE) AS value FROM summary"
    for i, (key, label) in enumerate(S.SUMMARY_METRICS)) + ")"

SEQ = """
seq AS (
  SELECT *, sum(CAST(latency AS DECIMAL(38,18))) OVER (PARTITION BY run_id ORDER BY request_num
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         count(*) OVER (PARTITION BY run_id) AS n
  FROM log)"""


def log(spark, sf):
    return X.request_log(spark, sf)


@query("request_sequence", W(O.LOG, body="SELECT * FROM log"))
def q_request_sequence(spark, sf):
    return log(spark, sf)


@query("loadtest_summary", W(O.LOG, SUMMARY, body="SELECT * FROM summary"))
def q_loadtest_summary(spark, sf):
    return L.summarize_log(X.request_log_base(spark, sf))


@query("loadtest_summary_tall", W(O.LOG, SUMMARY, TALL, body="SELECT * FROM tall"))
def q_loadtest_summary_tall(spark, sf):
    return summary_to_tall(L.summarize_log(X.request_log_base(spark, sf)), ["run_id"])


@query("compare_runs", W(O.LOG, SUMMARY, TALL, body="""
SELECT a.position, a.metric, a.value AS value_a, b.value AS value_b,
  CASE WHEN b.value = 0 THEN NULL ELSE round(a.value / b.value, 6) END AS ratio
FROM tall a JOIN tall b ON a.metric = b.metric WHERE a.run_id = 'A' AND b.run_id = 'B'"""))
def q_compare_runs(spark, sf):
    return L.compare_runs(L.summarize_log(X.request_log_base(spark, sf)), "A", "B")


@query("throughput_per_second", W(O.LOG, body="""
SELECT run_id, CAST(floor(elapsed) AS BIGINT) AS time_bucket, count(*) AS requests_per_sec FROM log GROUP BY ALL"""))
def q_throughput_per_second(spark, sf):
    return L.throughput(X.request_log_base(spark, sf))


@query("hist_latency", W(O.LOG, """
hd AS (SELECT run_id, latency * 1000.0e0 AS x FROM log WHERE latency IS NOT NULL),
hs0 AS (SELECT run_id, min(x) AS mn, max(x) AS mx, count(*) AS total FROM hd GROUP BY run_id),
hs AS (SELECT run_id, total, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM hs0),
hb AS (SELECT hd.run_id, CAST(least(floor((x - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin FROM hd JOIN hs ON hd.run_id = hs.run_id),
hc AS (SELECT run_id, bin, count(*) AS count FROM hb GROUP BY run_id, bin),
spine AS (SELECT hs.*, CAST(b AS INTEGER) AS bin FROM hs, range(0, 50) r(b))""", body="""
SELECT s.run_id, s.bin, round(s.lo + (s.hi - s.lo) / 50 * s.bin, 6) AS bin_lo, round(s.lo + (s.hi - s.lo) / 50 * (s.bin + 1), 6) AS bin_hi,
  CAST(coalesce(c.count, 0) AS BIGINT) AS count FROM spine s LEFT JOIN hc c ON c.run_id = s.run_id AND c.bin = s.bin"""))
def q_hist_latency(spark, sf):
    return L.latency_histogram(X.request_log_base(spark, sf), 50)


@query("latency_rolling", W(O.LOG, SEQ, """
sw AS (SELECT *, greatest(5, n // 20) AS w FROM seq)""", body="""
SELECT a.run_id, a.event_id, a.request_num, round(a.latency * 1000.0e0, 6) AS latency_ms,
  CASE WHEN a.n >= 5 THEN round(CAST(a.cum - coalesce(b.cum, 0) AS DOUBLE) / least(a.request_num, a.w) * 1000.0e0, 6) END
    AS rolling_avg_ms
FROM sw a LEFT JOIN sw b ON a.run_id = b.run_id AND b.request_num = a.request_num - a.w"""))
def q_latency_rolling(spark, sf):
    return L.rolling_latency(X.request_log_base(spark, sf))


@query("progress_snapshots", W(O.LOG, SEQ, body="""
SELECT run_id, request_num, round(request_num * 100.0e0 / n, 2) AS pct_complete, round(elapsed, 6) AS elapsed,
  round(CAST(cum AS DOUBLE) / request_num * 1000.0e0, 6) AS mean_latency_ms
FROM seq WHERE request_num % greatest(1, n // 20) = 0 OR request_num = n"""))
def q_progress_snapshots(spark, sf):
    return L.progress(X.request_log_base(spark, sf), parts=20, include_last=True)


@query("progress_snapshots_cli", W(O.LOG, SEQ, body="""
SELECT run_id, request_num, round(request_num * 100.0e0 / n, 2) AS pct_complete, round(elapsed, 6) AS elapsed,
  round(CAST(cum AS DOUBLE) / request_num * 1000.0e0, 6) AS mean_latency_ms
FROM seq WHERE request_num % greatest(1, n // 10) = 0"""))
def q_progress_snapshots_cli(spark, sf):
    return L.progress(X.request_log_base(spark, sf), parts=10, include_last=False)


@query("request_sequence_ranges", W(O.LOG, body="SELECT * FROM log"))
def q_request_sequence_ranges(spark, sf):
    """Same result as request_sequence with other range partitions: positions do not depend on the layout."""
    return L.with_sequence(X.request_log_base(spark, sf), partitions=13)


@query("request_sequence_window", W(O.LOG, body="SELECT * FROM log"))
def q_request_sequence_window(spark, sf):
    """Same result with few range partitions."""
    return L.with_sequence(X.request_log_base(spark, sf), partitions=3)


@query("latency_rolling_ranges")
def q_latency_rolling_ranges(spark, sf):
    """Same result as latency_rolling (an earlier name of the default method)."""
    return L.rolling_latency(X.request_log_base(spark, sf), method="ranges")


@query("format_duration", W(*CLEAN_CTES, body="""
SELECT trip_duration_seconds, CAST(floor(trip_duration_seconds / 60) AS BIGINT) || ' min ' ||
  CAST(floor(trip_duration_seconds % 60) AS BIGINT) || ' sec' AS duration_text FROM cleaned"""))
def q_format_duration(spark, sf):
    return cleaned(spark, sf).select("trip_duration_seconds",
                                     C.format_duration("trip_duration_seconds").alias("duration_text"))


from tripcraft.plans.queries import ORACLE  # noqa: E402

ORACLE["latency_rolling_ranges"] = ORACLE["latency_rolling"]
