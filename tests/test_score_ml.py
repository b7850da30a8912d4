"""Validation, scoring, scaler, metrics, linear fit and the neural regressor."""

import json
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.operators import ml as M
from tripcraft.operators import mlp as NN
from tripcraft.operators import score as SC
from tripcraft.sources import fixtures as X


def test_validation_counts_and_reasons(spark, sf01):
    valid, rejected = SC.validate_requests(X.requests_from_star(spark, sf01))
    assert valid.count() == 15_477 and rejected.count() == 60_000 - 15_477
    r = spark.createDataFrame([(None, 0.0, 1, 0, 1, 1, 0, None)], S.REQUEST_SCHEMA)
    _, rej = SC.validate_requests(r)
    assert sorted(rej.first().reasons) == ["passenger_count_missing", "trip_distance_out_of_range"]


def test_scoring_variants_default_and_errors(spark):
    reqs = spark.createDataFrame([(1, 2.0, 1, 8, 2, 5, 0, None), (1, 2.0, 1, 8, 2, 5, 0, "full"),
                                  (1, 2.0, 1, 8, 2, 5, 0, "other")], S.REQUEST_SCHEMA)
    params = [(f, 0.0, 1.0) for f in S.REDUCED_FEATURES]
    models = {"full": SC.linear_model([0.0, 1.0, 0, 0, 0, 0, 0], 5.0),
              "compressed": SC.linear_model([0.0, 1.0, 0, 0, 0, 0, 0], -50.0)}
    out = {r.model_used: r for r in SC.score_requests(reqs, models, params).collect()}
    assert out["compressed"].trip_duration_seconds == 0.0       # clamped at 0
    secs = float(np.expm1(7.0))
    assert out["full"].trip_duration_seconds == round(secs, 2)
    assert out["full"].trip_duration_minutes == round(secs / 60, 2)
    assert out["other"].trip_duration_seconds is None and out["other"].error.startswith("model not available")


def test_quantize_bounds_error():
    w = list(np.random.default_rng(1).normal(0, 1, 500))
    q, scale = SC.quantize(w)
    assert max(abs(a - b) for a, b in zip(w, q)) <= scale / 2 + 1e-12
    assert len(set(np.round(np.array(q) / scale).astype(int))) <= 255


def test_scaler_uses_population_std(spark):
    df = spark.createDataFrame([(float(i), 3.0) for i in range(20)], "a double, b double")
    p = {f: (m, s) for f, m, s in M.Scaler.fit(df, ["a", "b"]).params()}
    assert abs(p["a"][1] - np.std(np.arange(20))) < 1e-12 and p["b"][1] == 1.0


def test_linear_regression_recovers_coefficients(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 2))
    y = 3.0 + 2.0 * x[:, 0] - 1.5 * x[:, 1]
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "u double, v double, t double")
    m = M.fit_linear(df, ["u", "v"], label="t")
    assert np.allclose(m.coefficients.toArray(), [2.0, -1.5], atol=1e-8) and abs(m.intercept - 3.0) < 1e-8
    met = M.regression_metrics(M.predict(m, df, ["u", "v"]), "t", "prediction").first()
    assert met.mae < 1e-6 and met.r2 > 0.999999


def test_split_is_deterministic_and_disjoint(spark, sf001):
    from tripcraft.plans.queries import cleaned
    c = cleaned(spark, sf001)
    tr, te = M.split(c)
    tr2, te2 = M.split(c.repartition(3))
    assert tr.count() + te.count() == c.count()
    assert te.exceptAll(te2).count() == 0


@pytest.mark.parametrize("parts", [1, 4])
def test_mlp_beats_mean_and_quantised_drift(spark, parts):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 3))
    y = np.log1p(300 + 200 * x[:, 0] ** 2 + 50 * x[:, 1])
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double")
    df = df.repartition(parts)
    model = NN.fit_mlp(df, ["a", "b", "c"], "y", epochs=5, batch=128, validation=0.2)
    pred = NN.predict(df, model, ["a", "b", "c"], "p")
    mse = pred.agg(F.avg(F.pow(F.col("p") - F.col("y"), 2))).first()[0]
    assert mse < np.var(y) * 0.5
    small = NN.quantize_model(model)
    drift = NN.predict(pred, small, ["a", "b", "c"], "q").agg(F.avg(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert drift < 0.05
    assert len(model.history) >= 1


def test_mlp_weights_roundtrip(spark, tmp_path):
    m = NN.MLPModel(NN.init_weights(7), 7)
    m.save(spark, str(tmp_path / "w"))
    back = NN.MLPModel.load(spark, str(tmp_path / "w"))
    assert back.hidden == NN.HIDDEN and np.array_equal(back.weights, m.weights)


def test_mlp_resumes_from_saved_epochs(spark, tmp_path):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(800, 2))
    y = 1.0 + x[:, 0]
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    d = str(tmp_path / "resume")
    first = NN.fit_mlp(df, ["a", "b"], "y", hidden=(8,), epochs=2, batch=64, resume_dir=d)
    again = NN.fit_mlp(df, ["a", "b"], "y", hidden=(8,), epochs=4, batch=64, resume_dir=d)
    assert [h["epoch"] for h in first.history] == [1, 2]
    assert [h["epoch"] for h in again.history] == [1, 2, 3, 4]
    assert again.history[:2] == first.history
    straight = NN.fit_mlp(df, ["a", "b"], "y", hidden=(8,), epochs=4, batch=64)
    assert np.allclose(straight.weights, again.weights)


def test_training_ignores_the_partitioning_and_other_data_trains_anew(spark, tmp_path):
    rng = np.random.default_rng(11)
    rows = [(float(a), float(b), float(1 + a)) for a, b in rng.normal(size=(600, 2))]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    fit = lambda d, **k: NN.fit_mlp(d, ["a", "b"], "y", hidden=(8,), epochs=2, batch=64, replicas=4, **k).weights
    one, two, eight = (fit(df.repartition(n)) for n in (1, 2, 8))
    assert np.allclose(one, two) and np.allclose(one, eight)
    folder = str(tmp_path / "state")
    assert np.allclose(fit(df, resume_dir=folder), one)
    other = df.withColumn("y", F.col("y") * 2)
    assert np.allclose(fit(other, resume_dir=folder), fit(other)) and not np.allclose(fit(other), one)


def test_compressed_artefact_is_small_and_equals_the_quantised_model(spark, tmp_path):
    import os
    m = NN.MLPModel(NN.init_weights(7), 7)
    m.save(spark, str(tmp_path / "full"))
    m.save(spark, str(tmp_path / "small"), compressed=True)
    size = lambda d: sum(f.stat().st_size for f in os.scandir(tmp_path / d) if f.name.endswith(".parquet"))
    assert size("small") < size("full") / 4
    back = NN.MLPModel.load(spark, str(tmp_path / "small"))
    assert np.allclose(back.weights, NN.quantize_model(m).weights, rtol=1e-6, atol=1e-7)


def test_request_bodies(spark):
    """Coercion and reasons of single bodies; good and bad rows go to two tables."""
    full = {"passenger_count": 2, "trip_distance": 3.5, "payment_type": 1, "pickup_hour": 8, "pickup_dayofweek": 3,
            "pickup_month": 5, "is_weekend": 0}
    def body(**change):
        return json.dumps({k: v for k, v in {**full, **change}.items() if v != "absent"})
    cases = {
        body(): "", body(model_type="full", extra=[1]): "", body(passenger_count="3", trip_distance=" 4.25 ", is_weekend=True): "",
        body(pickup_hour=8.0, pickup_month=1e1): "",
        body(pickup_hour=8.5): "pickup_hour_not_whole", body(pickup_hour="absent"): "pickup_hour_missing",
        body(pickup_hour=None, payment_type="x", trip_distance=[]): "trip_distance_not_a_number,payment_type_not_a_number,pickup_hour_not_a_number",
        body(passenger_count=10, trip_distance=0): "passenger_count_out_of_range,trip_distance_out_of_range",
        body(passenger_count=10 ** 30): "passenger_count_not_whole", body(trip_distance="1d"): "trip_distance_not_a_number",
        "{": "invalid_json", "": "invalid_json", None: "invalid_json", "[]": "not_an_object", "3": "not_an_object", "null": "not_an_object"}
    parsed = SC.parse_requests(spark.createDataFrame([(b,) for b in cases], "body string"))
    rows = {r.body: r for r in parsed.collect()}
    assert {b: ",".join(r.reasons) for b, r in rows.items()} == cases
    r = rows[body(passenger_count="3", trip_distance=" 4.25 ", is_weekend=True)]
    assert (r.passenger_count, r.trip_distance, r.is_weekend, r.model_type) == (3, 4.25, 1, None)
    folder = tempfile.mkdtemp()
    SC.quarantine(parsed, f"{folder}/valid", f"{folder}/bad")
    assert spark.read.parquet(f"{folder}/valid").count() == 4 and spark.read.parquet(f"{folder}/bad").count() == len(cases) - 4


def test_global_batches_equal_one_process_for_any_number_of_tasks(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 2))
    y = x[:, 0] - 2 * x[:, 1] + rng.normal(scale=0.1, size=900)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y, strict=True)], "a double, b double, y double")
    one = NN.init_weights(2, (8,), 42)
    loss, want = NN._grad(NN.unflatten(one, 2, (8,)), x, y)
    for tasks in (1, 3, 7):
        got, got_loss, n = NN.global_gradient(df.repartition(tasks), one, 2, (8,), ["a", "b"], "y")
        assert n == 900 and abs(got_loss - loss) < 1e-9 and np.abs(got - want).max() < 1e-9
    # whole training: the same batches, in the same order, by plain numpy
    data, _ = NN._prepared(df, ["a", "b"], "y", 0, 42)
    step = [r[0] for r in data.select(F.pmod(F.xxhash64(F.lit(43), "a", "b", "y"), F.lit(4))).collect()]
    rows = np.array([tuple(r) for r in data.collect()])
    one[-1] = rows[:, 2].mean()
    state = NN._fresh(one)
    for epoch in range(3):
        for k in np.random.default_rng([42, epoch]).permutation(4).tolist():
            part = rows[np.array(step) == k]
            state = NN.adam(state, NN._grad(NN.unflatten(state[:len(one)], 2, (8,)), part[:, :2], part[:, 2])[1], 0.01)
    fit = lambda tasks: NN.fit_global(df.repartition(tasks), ["a", "b"], "y", (8,), epochs=3, steps=4, validation=0, lr=0.01)
    for tasks in (1, 5):
        model = fit(tasks)
        assert len(model.history) == 3 and model.history[2]["loss"] < model.history[0]["loss"]
        assert np.abs(model.weights - state[:len(one)]).max() < 1e-9


def test_global_training_of_an_empty_table_and_resuming(spark, tmp_path):
    empty = spark.createDataFrame([], "a double, y double")
    assert np.isfinite(NN.fit_global(empty, ["a"], "y", (4,), epochs=1, steps=2, validation=0).weights).all()
    df = spark.createDataFrame([(i / 50, i / 25 + 1.0) for i in range(200)], "a double, y double")
    go = lambda epochs, d=None: NN.fit_global(df, ["a"], "y", (4,), epochs=epochs, steps=2, resume_dir=d)
    go(1, str(tmp_path))
    assert np.abs(go(3, str(tmp_path)).weights - go(3).weights).max() < 1e-9  # moments went on, too


def _integer_loops(model, row):
    """Plain Python integers, one multiplication at a time."""
    from tripcraft.operators import int8net as I8
    q = [max(-127, min(127, round(v / model.input_scales[0]))) for v in row]
    for k, layer in enumerate(model.layers):
        acc = [sum(q[i] * int(layer.codes[i, j]) for i in range(len(q))) + int(layer.bias[j]) for j in range(layer.codes.shape[1])]
        assert all(-(1 << 31) <= a < 1 << 31 for a in acc)
        if k == len(model.layers) - 1:
            return acc[0] * layer.scale
        half = (1 << layer.shift) >> 1
        q = [min(I8.TOP, (max(a, 0) * layer.multiplier + half) >> layer.shift) for a in acc]


def test_integer_network_equals_integer_loops_and_stays_near_the_float_one(spark):
    from tripcraft.operators import int8net as I8
    rng = np.random.default_rng(11)
    model = NN.MLPModel(NN.init_weights(3, (16, 8)), 3, (16, 8))
    model.weights[:] += rng.normal(scale=0.05, size=len(model.weights))
    x = rng.normal(size=(400, 3))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0), (float("nan"), 1.0, 1.0)],
                               "a double, b double, c double").repartition(5)
    tops = I8.calibrate(df, model, ["a", "b", "c"])
    assert np.allclose(tops, [np.abs(h).max() for h in I8._relu_inputs(model, x)[:-1]])
    integer = I8.quantise(model, tops)
    out = I8.predict_integer(df, integer, ["a", "b", "c"], "p").collect()
    assert len(out) == 402 and sum(r.p is None for r in out) == 2
    for r in out[:150]:
        assert r.p is None or r.p == _integer_loops(integer, (r.a, r.b, r.c))
    far = I8.run_integer(integer, x[:20] * 50)[0]  # beyond the calibrated range: saturated, as the loops are
    assert far.tolist() == [_integer_loops(integer, r) for r in x[:20] * 50]
    drift = {r.layer: r for r in I8.layer_drift(df, model, integer, ["a", "b", "c"]).collect()}
    pred = NN.forward(model.layers(), x)
    assert drift[0].n == 1200 and drift[0].max_drift <= drift[0].step / 2 + 1e-12
    assert abs(drift[3].mean_drift - np.abs(pred - I8.run_integer(integer, x)[0]).mean()) < 1e-12
    assert drift[3].mean_drift < 0.03 * np.abs(pred).mean()
    empty = df.limit(0)
    assert I8.calibrate(empty, model, ["a", "b", "c"]) == [0.0] * 3 and I8.layer_drift(empty, model, integer, ["a", "b", "c"]).count() == 0


def test_parsing_makes_kind_and_text_of_a_field_once(spark):
    """Seven fields and the body: a schema each; seven texts, seven fields and the model type looked up."""
    plan = SC.parse_requests(spark.createDataFrame([("{}",)], "body string").repartition(2))._jdf.queryExecution().optimizedPlan().toString()
    # names as Spark writes them; both forms of a static call are counted
    assert max(plan.count("schema_of_variant("), plan.lower().count("schemaofvariant(")) <= 8
    assert plan.count("try_variant_get(") <= 15


def test_rows_pass_the_layers_in_chunks(monkeypatch):
    rng = np.random.default_rng(3)
    model = NN.MLPModel(NN.init_weights(3, (16, 8)), 3, (16, 8))
    x, seen, plain = rng.normal(size=(2 * NN.CHUNK + 5, 3)), [], NN.activations
    want = plain(model.layers(), x)[-1][:, 0]
    monkeypatch.setattr(NN, "activations", lambda layers, part: seen.append(len(part)) or plain(layers, part))
    assert np.allclose(NN.forward(model.layers(), x), want, rtol=1e-12) and seen == [NN.CHUNK, NN.CHUNK, 5]
    assert NN.forward(model.layers(), x[:0]).shape == (0,)


def test_sums_of_tasks_are_added_by_slices(spark):
    """A task's vector is SLICES rows of a shuffle, not one per position."""
    def run(batches):
        for b in batches:
            for k in b.column("id").to_pylist():
                yield NN._sliced(k, k / 2, np.arange(100.0) * k)

    parts = spark.range(6).repartition(3).mapInArrow(run, NN._PARTS)
    assert parts.count() == 6 * NN.SLICES
    total, loss, n = NN._summed(parts)
    assert np.array_equal(total, np.arange(100.0) * 15) and (loss, n) == (7.5, 15)
    assert NN._summed(parts.limit(0))[2] == 0
