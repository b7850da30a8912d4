"""Streaming jobs against their batch twins."""

import uuid

from pyspark.sql import functions as F

from tripcraft.plans import pipeline as P
from tripcraft.session import checkpoint_dir
from tripcraft.sources import fixtures as X
from tripcraft.streaming import stream as ST


def _stream(spark, sf, name):
    return ST.read_stream(spark, f"{sf}/{name}*.parquet", X.table(spark, sf, name).schema)


def _base(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/test-streams/{uuid.uuid4().hex[:8]}"


def test_stream_clean_equals_batch(spark, sf001):
    raw = X.trips_from_star(spark, sf001)
    b = P.learn_bounds(raw, "exact")
    batch = P.clean_trips(raw, b)
    base = _base(spark)
    got = ST.run_to_table(ST.stream_clean(X.trips_from_lineitem(_stream(spark, sf001, "lineitem")), b),
                          f"{base}/out", f"{base}/checkpoint")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_stream_metrics_equal_batch(spark, sf001):
    base = _base(spark)
    log = ST.with_stream_log(_stream(spark, sf001, "events"))
    got = ST.run_to_latest(ST.stream_metrics(log, window="1 hour", delay="10 minutes"),
                           ["run_id", "window_start", "window_end"], f"{base}/out", f"{base}/checkpoint")
    twin = (ST.with_stream_log(X.table(spark, sf001, "events")).groupBy("run_id", F.date_trunc("hour", "ts").alias("window_start"))
            .agg(F.count(F.lit(1)).alias("requests")))
    a = got.select("run_id", "window_start", "requests")
    assert a.count() > 0 and a.exceptAll(twin).count() == 0 and twin.exceptAll(a).count() == 0


def test_latest_windows_over_several_batches_and_a_restart(spark, tmp_path):
    import datetime as dt
    schema = "run_id string, event_id long, ts timestamp_ntz, latency double, success boolean"
    t0, src, base = dt.datetime(2024, 1, 1, 10), tmp_path / "log", _base(spark)

    def add(k, seconds):
        spark.createDataFrame([("A", 10 * k + i, t0 + dt.timedelta(seconds=x), 0.1, True) for i, x in enumerate(seconds)],
                              schema).coalesce(1).write.parquet(str(src / f"b{k}"))

    def run():
        stream = ST.read_stream(spark, f"{src}/b*/*.parquet", spark.createDataFrame([], schema).schema, max_files=1)
        out = ST.run_to_latest(ST.stream_metrics(stream, window="10 seconds", delay="1 minute"),
                               ["run_id", "window_start", "window_end"], f"{base}/out", f"{base}/checkpoint")
        return {r.window_start.second: r.requests for r in out.collect()}

    add(0, [1, 2, 11])
    add(1, [3, 12, 21])
    assert run() == {0: 3, 10: 2, 20: 1}
    add(2, [4, 29])
    assert run() == {0: 4, 10: 2, 20: 2}


def test_stream_score_two_sinks(spark, sf001):
    from tripcraft.operators import score as SC
    from tripcraft.plans.q_ml import linear_variants, train_test
    train, _ = train_test(spark, sf001)
    models, params = linear_variants(train)
    base = _base(spark)
    q = ST.stream_score(X.requests_from_lineitem(_stream(spark, sf001, "lineitem")), models, params,
                        f"{base}/scored", f"{base}/rejected", f"{base}/checkpoint")
    q.awaitTermination()
    scored = spark.read.parquet(f"{base}/scored")
    rejected = spark.read.parquet(f"{base}/rejected")
    valid, rej = SC.validate_requests(X.requests_from_star(spark, sf001))
    assert scored.count() == valid.count() and rejected.count() == rej.count()


def test_score_restart_neither_repeats_nor_loses(spark, sf001, tmp_path):
    from tripcraft.plans.q_ml import linear_variants, train_test
    models, params = linear_variants(train_test(spark, sf001)[0])
    requests, base, src = X.requests_from_star(spark, sf001), _base(spark), tmp_path / "requests"
    for k in range(2):
        requests.limit(40).coalesce(1).write.parquet(str(src / f"b{k}"))
        stream = ST.read_stream(spark, f"{src}/b*/*.parquet", requests.schema, max_files=1)
        ST.stream_score(stream, models, params, f"{base}/scored", f"{base}/rejected", f"{base}/checkpoint").awaitTermination()
        done = spark.read.parquet(f"{base}/scored").count() + spark.read.parquet(f"{base}/rejected").count()
        assert done == 40 * (k + 1)


def test_late_rows_beyond_watermark_are_dropped(spark, tmp_path):
    """A row older than the watermark is dropped once the late-event threshold has caught up
    (Spark applies the previous batch's watermark to late input, so an on-time batch comes first)."""
    import datetime as dt
    import time
    schema = "run_id string, event_id long, ts timestamp_ntz, latency double, success boolean"
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    batches = [
        [("A", i, t0 + dt.timedelta(seconds=i), 0.1, True) for i in range(6)]
        + [("A", 99, t0 + dt.timedelta(seconds=60), 0.1, True)],                    # watermark -> 10:00:50
        [("A", 100, t0 + dt.timedelta(seconds=61), 0.1, True)],                     # on time
        [("A", 101, t0 + dt.timedelta(seconds=2, milliseconds=500), 5.0, False)],   # late: window 10:00:02 closed
    ]
    src = tmp_path / "log"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src / f"b{i}"))
        time.sleep(1.1)  # distinct modification times fix the order in which files are picked up
    stream = ST.read_stream(spark, f"{src}/b*/*.parquet", spark.createDataFrame([], schema).schema, max_files=1)
    base = _base(spark)
    got = ST.run_to_table(ST.stream_metrics(stream, window="1 second", delay="10 seconds"), f"{base}/out", f"{base}/checkpoint")
    rows = [r for r in got.collect() if r.window_start.second == 2]
    assert len(rows) == 1 and rows[0].requests == 1 and rows[0].max_latency_ms == 100.0
    assert {r.window_start.second for r in got.collect()} == {0, 1, 2, 3, 4, 5}


def _live_rows(seed, n=600):
    """(run, id, seconds, latency, ok) in arrival order: up to 8 seconds out of order, one run with most requests."""
    import numpy as np
    rng = np.random.default_rng(seed)
    at = np.sort(rng.uniform(0, 120, n)).round(3)
    rows = [("A" if rng.random() < 0.7 else "B", i, float(at[i]), round(float(rng.uniform(0.01, 2)), 4), bool(rng.random() < 0.9))
            for i in range(n)]
    return [rows[i] for i in np.argsort(at + rng.uniform(0, 8, n), kind="stable")]


def _live_twin(rows, window):
    out = {}
    for run in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == run), key=lambda r: (r[2], r[1]))
        for k, r in enumerate(mine):
            last = [x[3] for x in mine[max(0, k + 1 - window):k + 1]]
            out[run, r[1]] = (k + 1, round(r[2] - mine[0][2], 6), round(sum(last) / len(last) * 1000, 4),
                              round(sum(x[3] for x in mine[:k + 1]) / (k + 1) * 1000, 4), sum(not x[4] for x in mine[:k + 1]))
    return out


def _live(spark, src, base, **kw):
    from tripcraft.streaming import live as LV
    schema = spark.createDataFrame([], "run_id string, event_id long, ts timestamp_ntz, latency double, success boolean").schema
    out, late = LV.run_live(LV.live_requests(ST.read_stream(spark, f"{src}/b*/*.parquet", schema, max_files=1), **kw),
                            f"{base}/out", f"{base}/checkpoint")
    return {(r.run_id, r.event_id): (r.request_num, round(r.elapsed, 6), round(r.rolling_avg_ms, 4), round(r.mean_latency_ms, 4),
                                     r.failed) for r in out.collect()}, late


def _add_live(spark, src, k, rows):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 10)
    spark.createDataFrame([(a, i, None if s is None else t0 + dt.timedelta(seconds=s), x, ok) for a, i, s, x, ok in rows],
                          "run_id string, event_id long, ts timestamp_ntz, latency double, success boolean") \
        .coalesce(1).write.parquet(str(src / f"b{k}"))


def test_live_requests_equal_their_twin_out_of_order_and_over_a_restart(spark, tmp_path):
    rows, src, base = _live_rows(1), tmp_path / "log", _base(spark)
    parts = [rows[i:i + 150] for i in range(0, 600, 150)]
    for k in (0, 1):
        _add_live(spark, src, k, parts[k])
    got, late = _live(spark, src, base, window=20)
    assert got == _live_twin(parts[0] + parts[1], 20) and late == 0  # open requests are part of the view
    for k in (2, 3):
        _add_live(spark, src, k, parts[k])
    got, late = _live(spark, src, base, window=20)  # a new query on the same checkpoint
    assert got == _live_twin(rows, 20) and late == 0


def test_live_requests_late_nulls_and_idle_runs(spark, tmp_path):
    src, base = tmp_path / "log", _base(spark)
    _add_live(spark, src, 0, [("A", 1, 0.0, 0.1, True), ("A", 2, 40.0, 0.3, False), ("A", 3, None, 0.3, True),
                              ("A", 4, 41.0, None, True), ("A", 5, 42.0, float("nan"), True), ("A", 6, 40.0, 0.2, None)])
    _add_live(spark, src, 1, [("B", 7, 41.0, 0.5, True)])
    _add_live(spark, src, 2, [("A", 8, 1.0, 9.0, True)])  # late: the watermark is at 30 seconds
    got, late = _live(spark, src, base)
    assert late == 1 and got == {("A", 1): (1, 0.0, 100.0, 100.0, 0), ("A", 2): (2, 40.0, 200.0, 200.0, 1),
                                 ("A", 6): (3, 40.0, 200.0, 200.0, 2), ("B", 7): (1, 0.0, 500.0, 500.0, 0)}
    src, base = tmp_path / "idle", _base(spark)
    _add_live(spark, src, 0, [("A", 1, 0.0, 0.1, True)])
    for k, at in ((1, 100.0), (2, 200.0), (3, 300.0)):
        _add_live(spark, src, k, [("B", k + 1, at, 0.1, True)])
    _add_live(spark, src, 4, [("A", 9, 301.0, 0.2, True)])
    assert _live(spark, src, base)[0]["A", 9][0] == 2
    assert _live(spark, src, _base(spark), idle_ms=60_000)[0]["A", 9][:2] == (1, 0.0)
