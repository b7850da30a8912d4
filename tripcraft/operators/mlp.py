"""Neural regressor (inventory J9-J11, J14): data-parallel training on Spark with numpy inside tasks.

Spark ML has no multilayer-perceptron regressor, so training is local SGD with model averaging:
each epoch is one Spark job. The current weights and Adam moments are broadcast; every partition streams its Arrow
batches through mini-batch Adam steps in numpy (`mapInPandas`), emitting what it has then times
its row count, cut into slices; tasks add the slices of a position, in the order of the partitions, so the
driver only ever receives three vectors of model size (about 35k numbers each), never data. Partitions grow in
number with the rows. Rows pass through the layers ``CHUNK`` at a time, whose activations stay in a core's cache. Validation loss is a distributed aggregate of squared errors. Inference is an Arrow-batched
pandas UDF.

`fit_global` takes global batches instead: a step is one job that sums the gradient over all rows of its batch, and
the driver makes one Adam step, so weights equal those of one process up to the rounding of sums, whatever the
number of tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft.session import ship_package

HIDDEN = (32, 64, 128, 128, 64, 32)
CHUNK = 512  # rows that pass through the layers at once
SLICES = 8  # parts of a vector that tasks add up


def layer_shapes(n_in: int, hidden: Sequence[int] = HIDDEN) -> list[tuple[int, int]]:
    dims = [n_in, *hidden, 1]
    return [(dims[i], dims[i + 1]) for i in range(len(dims) - 1)]


def init_weights(n_in: int, hidden: Sequence[int] = HIDDEN, seed: int = 42) -> np.ndarray:
    """Glorot-uniform kernels, zero biases, flattened (kernel_0, bias_0, kernel_1, ...)."""
    rng = np.random.default_rng(seed)
    parts = []
    for fi, fo in layer_shapes(n_in, hidden):
        lim = np.sqrt(6.0 / (fi + fo))
        parts += [rng.uniform(-lim, lim, size=fi * fo), np.zeros(fo)]
    return np.concatenate(parts)


def unflatten(flat: np.ndarray, n_in: int, hidden: Sequence[int] = HIDDEN) -> list[tuple[np.ndarray, np.ndarray]]:
    out, i = [], 0
    for fi, fo in layer_shapes(n_in, hidden):
        w = flat[i:i + fi * fo].reshape(fi, fo)
        i += fi * fo
        b = flat[i:i + fo]
        i += fo
        out.append((w, b))
    return out


def forward(layers: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), dtype=np.result_type(x, layers[0][0]))
    for at in range(0, len(x), CHUNK):
        out[at:at + CHUNK] = activations(layers, x[at:at + CHUNK])[-1][:, 0]
    return out


def activations(layers: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> list[np.ndarray]:
    """The input of every layer, then the output."""
    out = [x]
    for k, (w, b) in enumerate(layers):
        h = out[-1] @ w
        h += b
        out.append(np.maximum(h, 0.0, out=h) if k < len(layers) - 1 else h)
    return out


def _grad(layers, x, y):
    """Mean-squared-error loss and gradients by backpropagation."""
    acts = activations(layers, x)
    err = acts[-1][:, 0] - y
    loss = float(np.mean(err ** 2))
    delta = (2.0 / len(y)) * err[:, None]
    grads = []
    for k in range(len(layers) - 1, -1, -1):
        w, _ = layers[k]
        a_prev = acts[k]
        grads.append((a_prev.T @ delta, delta.sum(axis=0)))
        if k > 0:
            delta = delta @ w.T
            delta *= acts[k] > 0
    grads.reverse()
    return loss, np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in grads])


@dataclass
class MLPModel:
    weights: np.ndarray
    n_in: int
    hidden: tuple[int, ...] = HIDDEN
    history: list[dict] = field(default_factory=list)

    def layers(self):
        return unflatten(self.weights, self.n_in, self.hidden)

    def to_frame(self, spark, compressed: bool = False) -> DataFrame:
        """Weights as a table for Parquet storage: (layer, kind, rows, cols, values), or compressed with int8
        kernels, (layer, kind, rows, cols, codes, scale, values): a kernel is codes * scale, a bias its values."""
        from tripcraft.operators.score import quantize
        rows, i = [], 0
        for k, (fi, fo) in enumerate(layer_shapes(self.n_in, self.hidden)):
            kernel, bias = self.weights[i:i + fi * fo], self.weights[i + fi * fo:i + fi * fo + fo]
            i += fi * fo + fo
            if compressed:
                scale = quantize(kernel.tolist(), 8)[1]
                codes = np.rint(kernel / scale).astype(int) if scale else np.zeros(len(kernel), dtype=int)
                rows += [(k, "kernel", fi, fo, codes.tolist(), float(scale), None),
                         (k, "bias", 1, fo, None, None, bias.astype(np.float32).tolist())]
            else:
                rows += [(k, "kernel", fi, fo, kernel.tolist()), (k, "bias", 1, fo, bias.tolist())]
        extra = "codes array<tinyint>, scale double, values array<float>" if compressed else "values array<double>"
        return spark.createDataFrame(rows, f"layer int, kind string, rows int, cols int, {extra}").coalesce(1)

    @classmethod
    def from_frame(cls, df: DataFrame) -> MLPModel:
        rows = sorted(df.collect(), key=lambda r: (r["layer"], r["kind"] != "kernel"))
        n_in = rows[0]["rows"]
        hidden = tuple(r["cols"] for r in rows if r["kind"] == "bias")[:-1]
        parts = [np.asarray(r["codes"], dtype=np.float64) * r["scale"] if r.asDict().get("codes") is not None
                 else np.asarray(r["values"], dtype=np.float64) for r in rows]
        return cls(np.concatenate(parts), n_in, hidden)

    def save(self, spark, path: str, compressed: bool = False) -> None:
        self.to_frame(spark, compressed).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> MLPModel:
        return cls.from_frame(spark.read.parquet(path))


B1, B2, EPS = 0.9, 0.999, 1e-7  # Adam


def adam(state: np.ndarray, grad: np.ndarray, lr: float) -> np.ndarray:
    """One step of (weights, first moments, second moments, number of steps), flattened."""
    p = len(grad)
    w, m, v, t = state[:p], state[p:2 * p], state[2 * p:3 * p], state[-1] + 1
    m, v = B1 * m + (1 - B1) * grad, B2 * v + (1 - B2) * grad * grad
    return np.concatenate([w - lr * (m / (1 - B1 ** t)) / (np.sqrt(v / (1 - B2 ** t)) + EPS), m, v, [t]])


def _fresh(weights: np.ndarray) -> np.ndarray:
    return np.concatenate([weights, np.zeros(2 * len(weights) + 1)])


_PARTS = "slice int, task int, n long, loss_sum double, w binary"
_SCHEMA = pa.schema([("slice", pa.int32()), ("task", pa.int32()), ("n", pa.int64()), ("loss_sum", pa.float64()), ("w", pa.binary())])


def _sliced(n: int, loss_sum: float, w: np.ndarray) -> pa.RecordBatch:
    """A task's rows, loss sum and vector, a row per slice of the vector."""
    from pyspark import TaskContext
    parts = [x.tobytes() for x in np.array_split(w, SLICES)]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
        (range(SLICES), [TaskContext.get().partitionId()] * SLICES, [n] * SLICES, [loss_sum] * SLICES, parts), _SCHEMA.types,
        strict=True)], schema=_SCHEMA)


def _summed(parts: DataFrame) -> tuple[np.ndarray, float, int]:
    """Position-wise sums of what tasks give by `_sliced`, added in the order of the tasks: vector, loss and rows."""
    def add(batches):
        found: dict[int, list] = {}
        for b in batches:
            for r in b.to_pylist():
                w = np.frombuffer(r["w"])
                if r["slice"] in found:
                    total = found[r["slice"]]
                    total[0], total[1], total[2] = total[0] + r["n"], total[1] + r["loss_sum"], total[2] + w
                else:
                    found[r["slice"]] = [r["n"], r["loss_sum"], w.copy()]
        for k, (n, loss_sum, w) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((k, 0, n, loss_sum, w.tobytes()), _SCHEMA.types, strict=True)],
                                             schema=_SCHEMA)

    rows = parts.repartition(SLICES, "slice").sortWithinPartitions("task").mapInArrow(add, _PARTS).collect()
    if not rows:
        return np.zeros(0), 0.0, 0
    rows.sort(key=lambda r: r["slice"])
    return np.concatenate([np.frombuffer(r["w"]) for r in rows]), float(rows[0]["loss_sum"]), int(rows[0]["n"])


def _matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])


def _train_partitions(df: DataFrame, state: np.ndarray, n_in: int, hidden, features, label, batch, lr, seed,
                      epoch) -> tuple[np.ndarray, float]:
    """One epoch: local Adam on every partition from the same start, then a row-weighted average of weights, moments
    and step numbers."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(state)

    def run(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        rng = np.random.default_rng([seed, epoch, pid])
        now, n_rows, loss_sum = shared.value.copy(), 0, 0.0
        size = len(now) // 3
        for b in batches:
            if b.num_rows == 0:
                continue
            x, y = _matrix(b, features), b.column(label).to_numpy(zero_copy_only=False)
            order = rng.permutation(len(y))
            for s in range(0, len(y), batch):
                idx = order[s:s + batch]
                loss, g = _grad(unflatten(now[:size], n_in, hidden), x[idx], y[idx])
                now = adam(now, g, lr)
                loss_sum += loss * len(idx)
            n_rows += len(y)
        if n_rows:
            yield _sliced(n_rows, loss_sum, now * n_rows)

    total, loss, n = _summed(df.mapInArrow(run, _PARTS))
    shared.unpersist()
    return (total / n, loss / n) if n else (state, float("nan"))


def global_gradient(df: DataFrame, weights: np.ndarray, n_in: int, hidden, features, label) -> tuple[np.ndarray, float, int]:
    """Gradient of the mean squared error over all rows of `df`, its loss and the rows; a task gives one vector."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(weights)

    def run(batches):
        total, n_rows, loss_sum = np.zeros(len(shared.value)), 0, 0.0
        layers = unflatten(shared.value, n_in, hidden)
        for b in batches:
            x, y = _matrix(b, features), b.column(label).to_numpy(zero_copy_only=False)
            for at in range(0, len(y), CHUNK):
                part = y[at:at + CHUNK]
                loss, g = _grad(layers, x[at:at + CHUNK], part)
                total, loss_sum, n_rows = total + g * len(part), loss_sum + loss * len(part), n_rows + len(part)
        if n_rows:
            yield _sliced(n_rows, loss_sum, total)

    total, loss, n = _summed(df.select(*features, label).mapInArrow(run, _PARTS))
    shared.unpersist()
    return (total / n, loss / n, n) if n else (np.zeros(len(weights)), float("nan"), 0)


def mse_frame(df: DataFrame, model: MLPModel, features: Sequence[str], label: str) -> float:
    pred = predict(df, model, features, "_p")
    row = pred.agg(F.avg(F.pow(F.col("_p") - F.col(label), 2)).alias("mse")).first()
    return float(row["mse"]) if row["mse"] is not None else float("nan")


def _exists(spark, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _load_state(spark, folder: str, epochs: int):
    """The last epoch whose state row (written last) is complete, or None."""
    import json
    for epoch in range(epochs, 0, -1):
        at = f"{folder}/epoch-{epoch}"
        if _exists(spark, f"{at}/state/_SUCCESS"):
            row = spark.read.parquet(f"{at}/state").first()
            first, second = (MLPModel.load(spark, f"{at}/{k}").weights for k in ("first", "second"))
            current = MLPModel.load(spark, f"{at}/current")
            adam_state = np.concatenate([current.weights, first, second, [row["steps"]]])
            return (row["epoch"], row["best_loss"], row["wait"], json.loads(row["history"]), adam_state, current,
                    MLPModel.load(spark, f"{at}/best"))
    return None


def _save_state(spark, folder: str, epoch: int, best_loss: float, wait: int, history: list,
                current: MLPModel, best: MLPModel, adam_state: np.ndarray) -> None:
    """A folder per epoch; its state row comes last, so a half-written epoch does not count."""
    import json
    at = f"{folder}/epoch-{epoch}"
    current.save(spark, f"{at}/current")
    best.save(spark, f"{at}/best")
    size = len(current.weights)
    for k, name in ((1, "first"), (2, "second")):
        MLPModel(adam_state[k * size:(k + 1) * size], current.n_in, current.hidden).save(spark, f"{at}/{name}")
    spark.createDataFrame([(epoch, float(best_loss), wait, json.dumps(history), float(adam_state[-1]))],
                          "epoch int, best_loss double, wait int, history string, steps double") \
        .coalesce(1).write.mode("overwrite").parquet(f"{at}/state")


def _fingerprint(data: DataFrame, settings: object) -> str:
    """Identifies training rows (as a multiset) and settings."""
    import hashlib
    row = data.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*data.columns).cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr((tuple(row), data.columns, settings)).encode()).hexdigest()[:24]


REPLICA_ROWS = 1 << 20  # rows of a local model at most


def _prepared(train: DataFrame, features: Sequence[str], label: str, validation: float, seed: int) -> tuple[DataFrame, Column]:
    """Training columns as doubles, and the hash-chosen validation rows."""
    data = train.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias(label))
    return data, F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in data.columns]), F.lit(100)) < int(round(validation * 100))


def _fit(spark, run_epoch, val_loss, start_bias: float | None, n_in: int, hidden: tuple, epochs: int, patience: int, seed: int,
         folder: str | None) -> MLPModel:
    """Epochs with early stopping: `run_epoch(state, epoch) -> (state, loss)`, `val_loss(model, loss)`; the state
    after every epoch goes to `folder`, from where a restarted call goes on."""
    saved = _load_state(spark, folder, epochs) if folder else None
    if saved is not None:
        start, best_loss, wait, history, state, model, best_model = saved
        model.history = history
        best = best_model.weights
    else:
        w0 = init_weights(n_in, hidden, seed)
        # Start the output bias at the label mean (one aggregate), so few local steps are not spent
        # just shifting the output to the label's scale.
        w0[-1] = float(start_bias) if start_bias is not None else 0.0
        model, state = MLPModel(w0, n_in, hidden), _fresh(w0)
        start, best, best_loss, wait = 0, model.weights, float("inf"), 0
    for epoch in range(start, epochs):
        if wait >= patience:
            break
        state, train_loss = run_epoch(state, epoch)
        model = MLPModel(state[:len(state) // 3], n_in, hidden, model.history)
        loss = val_loss(model, train_loss)
        model.history.append({"epoch": epoch + 1, "loss": train_loss, "val_loss": loss})
        if loss < best_loss:
            best, best_loss, wait = model.weights, loss, 0
        else:
            wait += 1
        if folder:
            _save_state(spark, folder, epoch + 1, best_loss, wait, model.history, model, MLPModel(best, n_in, hidden), state)
    return MLPModel(best, n_in, hidden, model.history)


def fit_mlp(train: DataFrame, features: Sequence[str], label: str, hidden: Sequence[int] = HIDDEN, epochs: int = 5,
            batch: int = 512, validation: float = 0.2, patience: int = 5, lr: float = 1e-3, seed: int = 42,
            resume_dir: str | None = None, replicas: int | None = None) -> MLPModel:
    """Train on `label` (already transformed, e.g. log1p seconds) from standardised `features`.

    A hash-chosen `validation` share of rows is held out; after each epoch its MSE is measured and
    the best weights are kept (early stop after `patience` epochs without improvement). Rows are dealt to
    `replicas` local models (unless given: 8, or as many as hold REPLICA_ROWS rows each) by hash and sorted, so the
    result depends on that number, not on how the input is partitioned. Moments and step numbers are averaged with
    the weights and live on in the next epoch. With `resume_dir` (a shared folder), the state after every epoch is
    written there under a fingerprint of the rows and settings: a restarted call continues from the last finished
    epoch, and other data or settings train anew."""
    from pyspark import StorageLevel
    spark = train.sparkSession
    data, is_val = _prepared(train, features, label, validation, seed)
    if replicas is None:
        replicas = max(8, -(-data.count() // REPLICA_ROWS))
    fit_df = data.filter(~is_val).repartition(replicas, *data.columns).sortWithinPartitions(*data.columns) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    val_df = data.filter(is_val).persist(StorageLevel.MEMORY_AND_DISK)
    n_in, hidden = len(features), tuple(hidden)
    folder = resume_dir and f"{resume_dir}/" + _fingerprint(
        data, (tuple(features), label, hidden, batch, validation, patience, lr, seed, replicas, "moments"))
    try:
        return _fit(spark, lambda state, epoch: _train_partitions(fit_df, state, n_in, hidden, features, label, batch, lr, seed, epoch),
                    lambda model, loss: mse_frame(val_df, model, features, label) if validation > 0 else loss,
                    fit_df.agg(F.avg(label)).first()[0], n_in, hidden, epochs, patience, seed, folder)
    finally:
        fit_df.unpersist()
        val_df.unpersist()


def fit_global(train: DataFrame, features: Sequence[str], label: str, hidden: Sequence[int] = HIDDEN, epochs: int = 5,
               steps: int = 16, validation: float = 0.2, patience: int = 5, lr: float = 1e-3, seed: int = 42,
               resume_dir: str | None = None) -> MLPModel:
    """As `fit_mlp`, with global batches: rows are dealt to `steps` batches by hash, written once to the shared folder
    with a folder per batch, and a step reads its folder only. Every epoch takes the batches in another seeded order.
    A batch is rows / steps, spread over as many tasks as it needs; the driver holds weights and moments."""
    import uuid

    from tripcraft.session import checkpoint_dir
    spark = train.sparkSession
    data, is_val = _prepared(train, features, label, validation, seed)
    step = F.pmod(F.xxhash64(F.lit(seed + 1), *[F.col(c) for c in data.columns]), F.lit(steps)).cast("int")
    at = f"{checkpoint_dir(spark).rstrip('/')}/batches/{uuid.uuid4().hex[:12]}"
    data.withColumn("_step", F.when(is_val, F.lit(-1)).otherwise(step)).write.partitionBy("_step").parquet(at)
    rows = spark.read.schema(", ".join(f"`{c}` double" for c in data.columns) + ", _step int").parquet(at)
    n_in, hidden = len(features), tuple(hidden)
    folder = resume_dir and f"{resume_dir}/" + _fingerprint(
        data, (tuple(features), label, hidden, steps, validation, patience, lr, seed, "global"))

    def run_epoch(state: np.ndarray, epoch: int) -> tuple[np.ndarray, float]:
        loss_sum, seen = 0.0, 0
        for k in np.random.default_rng([seed, epoch]).permutation(steps).tolist():
            g, loss, n = global_gradient(rows.where(F.col("_step") == k), state[:len(state) // 3], n_in, hidden, features, label)
            if n:
                state, loss_sum, seen = adam(state, g, lr), loss_sum + loss * n, seen + n
        return state, loss_sum / seen if seen else float("nan")

    return _fit(spark, run_epoch, lambda model, loss: mse_frame(rows.where("_step = -1"), model, features, label)
                if validation > 0 else loss, rows.where("_step >= 0").agg(F.avg(label)).first()[0],
                n_in, hidden, epochs, patience, seed, folder)


def quantize_model(model: MLPModel, bits: int = 8) -> MLPModel:
    """Per-tensor symmetric int8 kernels (dequantised), float biases: the compressed variant."""
    from tripcraft.operators.score import quantize
    parts, i = [], 0
    for fi, fo in layer_shapes(model.n_in, model.hidden):
        k = model.weights[i:i + fi * fo]
        i += fi * fo
        parts.append(np.asarray(quantize(k.tolist(), bits)[0]))
        parts.append(model.weights[i:i + fo])
        i += fo
    return MLPModel(np.concatenate(parts), model.n_in, model.hidden, list(model.history))


def _udf(models: Mapping[str, MLPModel], float32: Mapping[str, bool] | None = None):
    """Arrow-batched UDF: (variant, *features) -> prediction, each batch split by variant."""
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    ship_package(spark)
    shared = spark.sparkContext.broadcast(
        {k: (m.layers(), (float32 or {}).get(k, False)) for k, m in models.items()})

    @F.pandas_udf(T.DoubleType())
    def score(variant: pd.Series, *xs: pd.Series) -> pd.Series:
        x = np.column_stack([s.to_numpy(dtype=np.float64) for s in xs])
        out = np.full(len(x), np.nan)
        for name, (layers, f32) in shared.value.items():
            mask = (variant == name).to_numpy()
            if mask.any():
                if f32:
                    ls = [(w.astype(np.float32), b.astype(np.float32)) for w, b in layers]
                    out[mask] = forward(ls, x[mask].astype(np.float32)).astype(np.float64)
                else:
                    out[mask] = forward(layers, x[mask])
        return pd.Series(out)

    return score


def predict(df: DataFrame, model: MLPModel, features: Sequence[str], output: str = "prediction") -> DataFrame:
    fn = _udf({"m": model})
    return df.withColumn(output, fn(F.lit("m"), *[F.col(c).cast("double") for c in features]))


def predictor(models: Mapping[str, MLPModel], float32: Mapping[str, bool] | None = None):
    """Model dispatcher for `score_requests`: (variant column, standardised feature columns) -> log prediction."""
    fn = _udf(models, float32)

    def apply(variant: Column, xs: list[Column]) -> Column:
        return fn(variant, *xs)
    return apply


def compare_variants(df: DataFrame, models: Mapping[str, MLPModel], features: Sequence[str], label: str,
                     reference: str = "full", float32: Mapping[str, bool] | None = None) -> DataFrame:
    """Per variant: rows, MAE in seconds (predictions are log1p seconds, inverted with expm1 and
    clamped at 0) and mean absolute drift from the reference variant, in one aggregate."""
    fn = predictor(models, float32)
    xs = [F.col(c) for c in features]
    secs = {k: F.greatest(F.lit(0.0), F.expm1(fn(F.lit(k), xs))) for k in models}
    scored = df.select(F.col(label).cast("double").alias("_y"), *[v.alias(f"_p_{k}") for k, v in secs.items()])
    aggs = [F.count(F.lit(1)).alias("n")]
    for k in models:
        aggs += [F.avg(F.abs(F.col("_y") - F.col(f"_p_{k}"))).alias(f"mae_{k}"),
                 F.avg(F.abs(F.col(f"_p_{k}") - F.col(f"_p_{reference}"))).alias(f"drift_{k}")]
    wide = scored.agg(*aggs)
    rows = [F.struct(F.lit(k).alias("variant"), F.col("n").alias("n"), F.round(f"mae_{k}", 6).alias("mae_seconds"),
                     F.round(f"drift_{k}", 6).alias("mean_abs_drift")) for k in models]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
