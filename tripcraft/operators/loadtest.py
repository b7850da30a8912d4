"""Request-log operators: completion order, summaries, throughput, rolling latency, progress.

A request log has columns (run_id, event_id, ts, latency [s], status, success); `with_sequence`
adds request_num (completion order within the run, ties broken by event_id) and elapsed seconds.

Scale: summaries, throughput and histograms need no order and read the log as it is. Order-dependent
results need a position per row. `method="ranges"` range-partitions the log on (run_id, ts,
event_id), numbers rows inside each partition, and adds per-partition offsets, totals and the run's
start from a small (partitions x runs) table, so one run holding most rows is still spread over
all tasks. `method="window"` numbers each run in one window partition (bounded load tests only).
Rolling means use exact decimal prefix sums and a lag among the requests of a run that are a window apart, never a
frame that must see a whole run in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripcraft.operators.explore import histogram, join_small
from tripcraft.session import stored

ORDER = ["ts", "event_id"]
_LOW33 = (1 << 33) - 1
# Exact prefix sums of latency seconds.
_DEC = "decimal(38,18)"


def micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def with_elapsed(log: DataFrame, run: str = "run_id") -> DataFrame:
    """Seconds since the run's first request (a log that has `elapsed` stays as it is)."""
    if "elapsed" in log.columns:
        return log
    starts = log.groupBy(run).agg(F.min(micros(F.col("ts"))).alias("_t0"))
    return join_small(log, starts, [run]).withColumn(
        "elapsed", (micros(F.col("ts")) - F.col("_t0")) / F.lit(1e6)).drop("_t0")


def _numbered_window(log: DataFrame, run: str) -> DataFrame:
    w = Window.partitionBy(run).orderBy(*ORDER)
    whole = Window.partitionBy(run)
    return log.withColumns({
        "request_num": F.row_number().over(w).cast("bigint"),
        "elapsed": (micros(F.col("ts")) - F.min(micros(F.col("ts"))).over(whole)) / F.lit(1e6),
        "_n": F.count(F.lit(1)).over(whole),
        "_cum": F.sum(F.col("latency").cast(_DEC)).over(w.rowsBetween(Window.unboundedPreceding, 0)),
    })


def _numbered_ranges(log: DataFrame, run: str, partitions: int | None) -> DataFrame:
    n_parts = partitions or int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written, so that every later pass sees the same (sampled) range bounds.
    keyed, _ = stored(log.repartitionByRange(n_parts, run, *ORDER).sortWithinPartitions(run, *ORDER)
                      .withColumn("_mid", F.monotonically_increasing_id()), "ranges")
    keyed = keyed.withColumns({"_pid": F.shiftright(F.col("_mid"), 33),
                               "_loc": F.col("_mid").bitwiseAND(F.lit(_LOW33))})
    parts = keyed.groupBy(run, "_pid").agg(
        F.count(F.lit(1)).alias("_k"), F.min("_loc").alias("_first"), F.min(micros(F.col("ts"))).alias("_start"),
        F.sum(F.col("latency").cast(_DEC)).alias("_lat"))
    whole = Window.partitionBy(run)
    before = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = parts.select(run, "_pid", "_first", F.sum("_k").over(whole).alias("_n"), F.min("_start").over(whole).alias("_t0"),
                        F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_off"),
                        F.coalesce(F.sum("_lat").over(before), F.lit(0).cast(_DEC)).alias("_lat_off"))
    j = join_small(keyed, offs, [run, "_pid"])
    local = Window.partitionBy("_pid", run).orderBy("_loc").rowsBetween(Window.unboundedPreceding, 0)
    return j.withColumns({
        "request_num": (F.col("_off") + F.col("_loc") - F.col("_first") + 1).cast("bigint"),
        "elapsed": (micros(F.col("ts")) - F.col("_t0")) / F.lit(1e6),
        "_cum": F.col("_lat_off") + F.sum(F.col("latency").cast(_DEC)).over(local),
    }).drop("_mid", "_pid", "_loc", "_first", "_off", "_lat_off", "_t0")


def _sequenced(log: DataFrame, run: str = "run_id", method: str = "ranges", partitions: int | None = None) -> DataFrame:
    """Log + request_num + elapsed + `_n` (requests of the run) + `_cum` (exact running latency sum in request order)."""
    if method == "window":
        return _numbered_window(log, run)
    if method == "ranges":
        return _numbered_ranges(log, run, partitions)
    raise ValueError(f"method must be 'window' or 'ranges', not {method!r}")


def with_sequence(log: DataFrame, run: str = "run_id", method: str = "ranges", partitions: int | None = None) -> DataFrame:
    """Request log with completion number and elapsed seconds (8 columns)."""
    return _sequenced(log, run, method, partitions).drop("_cum", "_n")


def summarize_log(log: DataFrame, run: str = "run_id") -> DataFrame:
    """Load-test summary per run in one aggregate: counts, error %, wall time, throughput,
    latency mean / median / p95 / p99 / min / max in ms (linear-interpolated percentiles), rounded 2.

    Wall time is the time from the run's first to its last entry (log time, not a stopwatch)."""
    from tripcraft.operators.quality import exact_quantiles
    lat = F.col("latency")
    wall = F.max("elapsed") if "elapsed" in log.columns else \
        (F.max(micros(F.col("ts"))) - F.min(micros(F.col("ts")))) / F.lit(1e6)
    basic = log.groupBy(run).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("success")).alias("ok"),
        wall.alias("wall"), F.avg(lat).alias("mean"), F.min(lat).alias("mn"), F.max(lat).alias("mx"))
    pct = exact_quantiles(log, "latency", [0.5, 0.95, 0.99], [run], ["p50", "p95", "p99"])
    g = basic.join(pct, run, "left")
    ms = lambda c: F.round(F.col(c) * 1000.0, 2)
    return g.select(
        run,
        F.col("n").cast("bigint").alias("total_requests"),
        F.col("ok").cast("bigint").alias("successful"),
        (F.col("n") - F.col("ok")).cast("bigint").alias("failed"),
        F.round((F.col("n") - F.col("ok")) * 100.0 / F.col("n"), 2).alias("error_rate_pct"),
        F.round("wall", 2).alias("total_time_s"),
        F.round(F.try_divide(F.col("n").cast("double"), F.col("wall")), 2).alias("throughput_rps"),
        ms("mean").alias("mean_latency_ms"), ms("p50").alias("median_latency_ms"),
        ms("p95").alias("p95_latency_ms"), ms("p99").alias("p99_latency_ms"),
        ms("mn").alias("min_latency_ms"), ms("mx").alias("max_latency_ms"))


def throughput(log: DataFrame, run: str = "run_id") -> DataFrame:
    """Requests per whole second of elapsed time; seconds without requests are absent."""
    return (with_elapsed(log, run).groupBy(run, F.floor("elapsed").cast("bigint").alias("time_bucket"))
            .agg(F.count(F.lit(1)).alias("requests_per_sec")).orderBy(run, "time_bucket"))


def latency_histogram(log: DataFrame, bins: int = 50, run: str = "run_id") -> DataFrame:
    return histogram(log.withColumn("latency_ms", F.col("latency") * 1000.0), "latency_ms", bins, by=run)


def rolling_latency(log: DataFrame, run: str = "run_id", method: str = "ranges", min_requests: int = 5) -> DataFrame:
    """Rolling mean latency (ms) over the last w = max(5, n // 20) requests of each run, computed
    only for runs with at least 5 requests (min_periods 1: the first rows average what exists).

    mean_i = (S_i - S_{i-w}) / min(i, w) with S the exact running sum. Requests i and i - w are neighbours among the
    requests with the same number modulo w, some 20 of a run, so S_{i-w} is a lag over (run, number mod w): one exchange
    in even, small groups, no join, and no task needs a whole run."""
    seq = _sequenced(log, run, method)
    seq = seq.withColumn("_w", F.greatest(F.lit(5), (F.col("_n") / 20).cast("bigint")))
    same = Window.partitionBy(run, "_place").orderBy("request_num")
    seq = seq.withColumn("_place", F.col("request_num") % F.col("_w"))
    window_sum = F.col("_cum") - F.coalesce(F.lag("_cum").over(same), F.lit(0).cast(_DEC))
    mean = window_sum.cast("double") / F.least(F.col("request_num"), F.col("_w")).cast("double")
    return seq.select(run, "event_id", "request_num", F.round(F.col("latency") * 1000.0, 6).alias("latency_ms"),
                      F.when(F.col("_n") >= min_requests, F.round(mean * 1000.0, 6)).alias("rolling_avg_ms"))


def progress(log: DataFrame, parts: int = 20, include_last: bool = True, run: str = "run_id",
             method: str = "ranges") -> DataFrame:
    """Progress snapshots every max(1, n // parts) completed requests (plus the last one when
    `include_last`, as the UI does; the CLI uses parts=10 without it): completed count, percent,
    elapsed seconds and the running mean latency in ms at that point."""
    seq = _sequenced(log, run, method)
    seq = seq.withColumn("_step", F.greatest(F.lit(1), (F.col("_n") / parts).cast("bigint")))
    keep = F.col("request_num") % F.col("_step") == 0
    if include_last:
        keep = keep | (F.col("request_num") == F.col("_n"))
    return seq.filter(keep).select(
        run, "request_num", F.round(F.col("request_num") * 100.0 / F.col("_n"), 2).alias("pct_complete"),
        F.round("elapsed", 6).alias("elapsed"),
        F.round(F.col("_cum").cast("double") / F.col("request_num") * 1000.0, 6).alias("mean_latency_ms"))


def compare_runs(summaries: DataFrame, a: str, b: str, run: str = "run_id") -> DataFrame:
    """Metric-by-metric comparison of two run summaries: values and ratio a / b."""
    from tripcraft.sources.io import summary_to_tall
    tall = summary_to_tall(summaries, [run])
    ta = tall.filter(F.col(run) == a).select("position", "metric", F.col("value").alias("value_a"))
    tb = tall.filter(F.col(run) == b).select("metric", F.col("value").alias("value_b"))
    return ta.join(tb, "metric").select(
        "position", "metric", "value_a", "value_b",
        F.round(F.try_divide(F.col("value_a"), F.col("value_b")), 6).alias("ratio")).orderBy("position")
