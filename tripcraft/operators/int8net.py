"""Integer inference of the network (inventory J14).

Kernels are int8 codes with a scale per layer. `calibrate` takes, over all rows given, the largest absolute input of
every layer (a Spark aggregate, one row per task), which fixes the scales of the activations. A layer then is int8 x
int8 products summed in 32 bits, an integer bias, a rectifier and a rescale to the next layer's int8 by an integer
multiplier and a shift, rounding half up. Floats occur in the scale of the input and of the one output only.

Products run as double-precision matrix products of whole numbers, which are exact below 2**53 and fast; the result
is that of integer loops, bit for bit. A layer wider than 2**17 inputs could leave 32 bits and is refused. Inputs
beyond the calibrated range saturate; null and NaN inputs give null; an empty calibration table has scale 1.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.operators.mlp import CHUNK, MLPModel, activations
from tripcraft.session import ship_package

TOP = 127
SHIFT = 31  # bits of a multiplier's fraction
WIDEST = 1 << 17


@dataclass(frozen=True)
class IntegerLayer:
    """acc = q @ codes + bias; the next layer's input is acc * multiplier / 2**shift, the last layer's output acc * scale."""

    codes: np.ndarray  # int8 (inputs, outputs)
    bias: np.ndarray  # int32
    scale: float  # of the accumulator
    multiplier: int
    shift: int


@dataclass(frozen=True)
class IntegerModel:
    layers: tuple[IntegerLayer, ...]
    input_scales: tuple[float, ...]  # of every layer's input


def _relu_inputs(model: MLPModel, x: np.ndarray) -> list[np.ndarray]:
    """The input of every layer, then the output."""
    return activations(model.layers(), x)


def _chunks(x: np.ndarray) -> Iterator[np.ndarray]:
    return (x[at:at + CHUNK] for at in range(0, len(x), CHUNK))


def _inputs(part: pd.DataFrame, features: Sequence[str]) -> np.ndarray:
    x = part[list(features)].to_numpy(dtype=np.float64)
    return x[np.isfinite(x).all(axis=1)]


def calibrate(df: DataFrame, model: MLPModel, features: Sequence[str]) -> list[float]:
    """Largest absolute input of every layer over all rows."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        top = None
        for part in batches:
            for x in _chunks(_inputs(part, features)):
                now = np.array([np.abs(h).max() for h in _relu_inputs(shared.value, x)[:-1]])
                top = now if top is None else np.maximum(top, now)
        if top is not None:
            yield pd.DataFrame({"layer": range(len(top)), "top": top})

    tops = df.select(*(F.col(c).cast("double") for c in features)).mapInPandas(run, "layer int, top double")
    found = {r["layer"]: r["top"] for r in tops.groupBy("layer").agg(F.max("top").alias("top")).collect()}
    return [found.get(k, 0.0) for k in range(len(model.layers()))]


def _multiplier(real: float) -> tuple[int, int]:
    """(m, s) with real = m / 2**s, m of 31 bits."""
    fraction, exponent = np.frexp(real)
    return round(float(fraction) * (1 << SHIFT)), SHIFT - int(exponent)


def quantise(model: MLPModel, tops: Sequence[float]) -> IntegerModel:
    """Integer form of `model` for activations up to `tops`."""
    scales = [t / TOP if t > 0 else 1.0 for t in tops]
    layers = []
    for k, (w, b) in enumerate(model.layers()):
        if len(w) > WIDEST:
            raise ValueError(f"layer {k} has {len(w)} inputs; sums of {WIDEST} products fit 32 bits")
        peak = float(np.abs(w).max())
        own = peak / TOP if peak > 0 else 1.0
        scale = own * scales[k]
        most = (1 << 31) - 1 - len(w) * TOP * TOP if len(w) * TOP * TOP < 1 << 31 else 0
        multiplier, shift = _multiplier(scale / scales[k + 1]) if k + 1 < len(scales) else (0, 0)
        layers.append(IntegerLayer(np.rint(w / own).astype(np.int8), np.clip(np.rint(b / scale), -most, most).astype(np.int32),
                                   scale, multiplier, shift))
    return IntegerModel(tuple(layers), tuple(scales))


def rescale(acc: np.ndarray, multiplier: int, shift: int) -> np.ndarray:
    """acc * multiplier / 2**shift, rounded half up, cut to 0..TOP (the rectifier is part of the cut)."""
    acc = np.maximum(acc, 0)
    if shift > 62:
        return np.zeros_like(acc)
    if shift < 1:
        return np.where(acc > 0, TOP, 0)  # the factor is 2**30 or more
    return np.minimum((acc * multiplier + (1 << (shift - 1))) >> shift, TOP)


def run_integer(model: IntegerModel, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Predictions, and the integer input of every layer."""
    q = np.clip(np.rint(x / model.input_scales[0]), -TOP, TOP).astype(np.int64)
    seen = []
    for k, layer in enumerate(model.layers):
        seen.append(q)
        acc = (q.astype(np.float64) @ layer.codes.astype(np.float64)).astype(np.int64) + layer.bias
        if k == len(model.layers) - 1:
            return acc[:, 0] * layer.scale, seen
        q = rescale(acc, layer.multiplier, layer.shift)
    raise ValueError("a model has at least one layer")


def predict_integer(df: DataFrame, model: IntegerModel, features: Sequence[str], output: str = "prediction") -> DataFrame:
    """`df` with the integer model's prediction."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(*xs: pd.Series) -> pd.Series:
        x = np.column_stack([s.to_numpy(dtype=np.float64) for s in xs])
        ok = np.isfinite(x).all(axis=1)
        out = np.full(len(x), np.nan)
        if ok.any():
            out[ok] = np.concatenate([run_integer(shared.value, c)[0] for c in _chunks(x[ok])])
        return pd.Series(out).where(ok, None)

    return df.withColumn(output, score(*(F.col(c).cast("double") for c in features)))


def layer_drift(df: DataFrame, model: MLPModel, integer: IntegerModel, features: Sequence[str]) -> DataFrame:
    """Per layer input, and for the output (the last number): values, scale of a code step, mean and largest
    difference between integer and float network. One aggregate; a task gives one row per layer."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((model, integer))

    def run(batches):
        floats, ints = shared.value
        n = len(floats.layers()) + 1
        sums, tops, counts = np.zeros(n), np.zeros(n), np.zeros(n, dtype=np.int64)
        for part in batches:
            for x in _chunks(_inputs(part, features)):
                pred, seen = run_integer(ints, x)
                real = [q * s for q, s in zip(seen, ints.input_scales, strict=True)] + [pred[:, None]]
                for k, (a, b) in enumerate(zip(_relu_inputs(floats, x), real, strict=True)):
                    gap = np.abs(a - b)
                    sums[k], tops[k], counts[k] = sums[k] + gap.sum(), max(tops[k], gap.max()), counts[k] + gap.size
        if counts[0]:
            yield pd.DataFrame({"layer": range(n), "n": counts, "total": sums, "top": tops})

    steps = [*integer.input_scales, integer.layers[-1].scale]
    parts = df.select(*(F.col(c).cast("double") for c in features)).mapInPandas(run, "layer int, n long, total double, top double")
    return parts.groupBy("layer").agg(F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("mean_drift"),
                                      F.max("top").alias("max_drift")).select(
        "layer", "n", F.element_at(F.array(*map(F.lit, steps)), F.col("layer") + 1).alias("step"), "mean_drift", "max_drift")
