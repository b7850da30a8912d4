"""Live request numbers, rolling latency and progress over a request stream (inventory I1 with E1, E3).

`transformWithState` keeps one state per run: counters, a ring of the last `window` latencies, and the requests the
watermark has not passed yet, in buckets of event time. Requests arrive out of order. Each micro-batch emits every
request from its earliest new one on, numbered by (ts, event_id) as if nothing more came before it, with a revision
that grows per run. So the newest revision of a request is the live view, and it is final once the watermark has
passed the request. A timer at the oldest bucket's end folds what has passed into counters and ring, so state is `window` numbers plus
the requests of the last `delay`. With `idle`, a timer ends a run that was silent for so long in event time, and its
state goes.

A request at or below the watermark is late: Spark drops it before the state sees it; `run_live` returns the count.
Requests with a null time or a null, NaN or infinite latency are left out; a null event_id sorts first; repeated
requests count each time. A task holds one bucket of one run at a time. Numbering one run is sequential, so its
requests pass through one task per micro-batch: limit the batch (`maxFilesPerTrigger`, `maxBytesPerTrigger`).
A finished log is numbered by `operators.loadtest` instead, which spreads one run over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tripcraft.session import ship_package

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ROW = np.dtype([("ts", "<i8"), ("id", "<i8"), ("lat", "<i8"), ("failed", "?")])
_DONE = "n long, total string, failed long, start long, last long, revision long, ring binary"
_OUT = ("run_id string, event_id long, request_num long, elapsed double, latency_ms double, rolling_avg_ms double, "
        "mean_latency_ms double, failed long, revision long")
_SENT = 10_000  # rows sent at a time
_SHOWN = ("request_num", "elapsed", "latency_ms", "rolling_avg_ms", "mean_latency_ms", "failed")


class Counters:
    """What a run's earlier requests leave behind: exact sums and the last `window` latencies (nanoseconds)."""

    def __init__(self, window: int, state: tuple | None = None):
        self.window = window
        n, total, self.failed, self.start, self.last, self.revision, ring = state or (0, "0", 0, None, 0, 0, b"")
        self.n, self.total, self.ring = n, int(total), np.frombuffer(ring, "<i8")

    def state(self) -> tuple:
        return self.n, str(self.total), self.failed, self.start, self.last, self.revision, self.ring.tobytes()

    def number(self, rows: np.ndarray) -> dict[str, np.ndarray]:
        """Columns of the next requests (in order), which then count as earlier ones."""
        if self.start is None:
            self.start = int(rows["ts"][0])
        num = self.n + np.arange(1, len(rows) + 1)
        both = np.concatenate([self.ring, rows["lat"]])
        cum = np.concatenate([[0], np.cumsum(both)])
        at = len(self.ring) + np.arange(1, len(rows) + 1)
        own = np.cumsum(rows["lat"])
        out = {"event_id": rows["id"], "request_num": num, "elapsed": (rows["ts"] - self.start) / 1e6,
               "latency_ms": rows["lat"] / 1e9 * 1e3,
               "rolling_avg_ms": (cum[at] - cum[np.maximum(at - self.window, 0)]) / 1e9 / np.minimum(num, self.window) * 1e3,
               "mean_latency_ms": (float(self.total) + own) / 1e9 / num * 1e3, "failed": self.failed + np.cumsum(rows["failed"])}
        self.n, self.total, self.failed = int(num[-1]), self.total + int(own[-1]), int(out["failed"][-1])
        self.last, self.ring = int(rows["ts"][-1]), both[-self.window:]
        return out


class LiveRun(StatefulProcessor):
    """State of one run (see the module)."""

    def __init__(self, window: int, bucket_ms: int, idle_ms: int | None):
        self.window, self.bucket_ms, self.idle_ms = window, bucket_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done = handle.getValueState("done", _DONE)
        self.pending = handle.getMapState("pending", "bucket long", "rows binary")

    def _counters(self) -> Counters:
        return Counters(self.window, tuple(self.done.get()) if self.done.exists() else None)

    def _bucket(self, bucket: int) -> np.ndarray:
        return np.frombuffer(self.pending.getValue((bucket,))[0], _ROW)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            new = np.empty(len(part), _ROW)
            new["ts"], new["id"], new["lat"] = part["micros"], part["id"], part["nanos"]
            new["failed"] = part["bad"].astype(bool)
            of = new["ts"] // (self.bucket_ms * 1000)
            for bucket in np.unique(of).tolist():
                mine = new[of == bucket]
                if self.pending.containsKey((bucket,)):
                    mine = np.concatenate([self._bucket(bucket), mine])
                self.pending.updateValue((bucket,), (np.sort(mine, order=["ts", "id"]).tobytes(),))
                first = bucket if first is None else min(first, bucket)
        if first is None:
            return
        done = self._counters()
        done.revision += 1
        self.done.update(done.state())
        ahead = self._counters()  # goes over the pending requests, and is not kept
        waiting, parts = sorted(k[0] for k in self.pending.keys()), []
        self.handle.registerTimer((waiting[0] + 1) * self.bucket_ms)
        for bucket in waiting:
            out = ahead.number(self._bucket(bucket))
            if bucket >= first:
                parts.append(pd.DataFrame({"run_id": key[0], **out, "revision": done.revision}))
            if sum(map(len, parts)) >= _SENT or (parts and bucket == waiting[-1]):
                yield pd.concat(parts, ignore_index=True)
                parts = []

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        waiting = sorted(k[0] for k in self.pending.keys())
        passed = [b for b in waiting if (b + 1) * self.bucket_ms <= now]
        if passed:
            done = self._counters()
            for bucket in passed:
                done.number(self._bucket(bucket))
                self.pending.removeKey((bucket,))
            self.done.update(done.state())
            if len(passed) < len(waiting):
                self.handle.registerTimer((waiting[len(passed)] + 1) * self.bucket_ms)
            if self.idle_ms is not None:
                self.handle.registerTimer(done.last // 1000 + self.idle_ms)
        elif self.idle_ms is not None and not waiting and self.done.exists():
            if self._counters().last // 1000 + self.idle_ms <= now:
                self.done.clear()
        return iter([])

    def close(self) -> None:
        pass


def live_requests(log: DataFrame, window: int = 100, delay: str = "10 seconds", bucket_ms: int = 1000,
                  idle_ms: int | None = None) -> DataFrame:
    """Streaming frame of revisions per request: number, elapsed seconds, latency, mean of the last `window`
    latencies and of all so far (ms), failed so far. Start it with `run_live`."""
    ship_package(log.sparkSession)
    nanos = F.round(F.col("latency") * 1e9)
    rows = log.select(
        F.col("run_id").cast("string").alias("run_id"), F.col("ts").cast("timestamp").alias("t"),
        F.coalesce(F.col("event_id").cast("long"), F.lit(-(1 << 63))).alias("id"), nanos.cast("long").alias("nanos"),
        (~F.coalesce("success", F.lit(False))).alias("bad")).where(F.col("t").isNotNull() & (F.abs(nanos) < 9e18))
    rows = rows.withWatermark("t", delay).withColumn("micros", F.unix_micros("t"))
    return rows.groupBy("run_id").transformWithStateInPandas(
        LiveRun(window, bucket_ms, idle_ms), outputStructType=_OUT, outputMode="Update", timeMode="EventTime")


def run_live(live: DataFrame, path: str, checkpoint: str) -> tuple[DataFrame, int]:
    """Drive `live_requests` over all available input; (the newest revision of each request, late requests dropped
    by this call). A micro-batch overwrites its own folder, so a repeated one does not count twice, and a later call
    with the same folders goes on with the state."""
    spark = live.sparkSession
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.numRecentProgressUpdates": "100000"}
    before = {k: spark.conf.get(k, None) for k in wanted}

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        query = live.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint) \
            .trigger(availableNow=True).start()
        query.awaitTermination()
        late = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    rows = spark.read.schema(f"{_OUT}, batch_id long").option("basePath", path).parquet(path)
    # a request that came twice has two numbers in a revision, and both stay
    newest = rows.groupBy("run_id", "event_id").agg(F.max("revision").alias("revision"), F.collect_list(
        F.struct("revision", *_SHOWN)).alias("all"))
    kept = newest.select("run_id", "event_id", F.explode(F.expr("filter(all, x -> x.revision = revision)")).alias("x"))
    return kept.select("run_id", F.expr("nullif(event_id, -9223372036854775808)").alias("event_id"),
                       *(F.col(f"x.{c}").alias(c) for c in _SHOWN)), late
