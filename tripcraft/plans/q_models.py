"""Registered random / iterative queries (rows-only checks) and the zone-enrichment twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.operators import features as FE
from tripcraft.operators import forest
from tripcraft.operators import ml as M
from tripcraft.operators import int8net as I8
from tripcraft.operators import mlp as NN
from tripcraft.operators import score as SC
from tripcraft.operators.explore import with_scalars
from tripcraft.operators.zones import enrich_zones
from tripcraft.plans.q_ml import RED, split_key, train_test
from tripcraft.plans.queries import CLEAN_CTES, W, cleaned, query
from tripcraft.session import checkpoint_dir
from tripcraft.sources import fixtures as X
from tripcraft.sources import io as IO

# Registered sizes: those of the library and of the training job. Trees of the forest grow until their leaves are pure.
FOREST_TREES, FOREST_DEPTH = 100, None
BOOST_ROUNDS = 200
# Integer sampling key that DuckDB repeats.
SAMPLE_KEY_SQL = ("((CAST(PULocationID AS BIGINT)*7919 + CAST(DOLocationID AS BIGINT)*104729"
                  " + CAST(trip_duration_seconds AS BIGINT)*1299709 + CAST(pickup_hour AS BIGINT)*15485863) % 1000000)")


def sample_key():
    return (F.col("PULocationID") * 7919 + F.col("DOLocationID") * 104729
            + F.col("trip_duration_seconds").cast("bigint") * 1299709 + F.col("pickup_hour").cast("bigint") * 15485863)


def metrics_row(pred, name):
    return M.regression_metrics(pred, S.TARGET, "prediction").select(F.lit(name).alias("model"), "*")


@query("bounded_sample", W(*CLEAN_CTES, body=f"""
SELECT {', '.join(S.CLEAN_COLUMNS)} FROM cleaned, (SELECT count(*) AS total FROM cleaned)
WHERE total <= {S.SAMPLE_ROWS} OR {SAMPLE_KEY_SQL} < CAST(floor(least(1.0e0, {S.SAMPLE_ROWS}.0e0 / total) * 1000000) AS BIGINT)"""))
def q_bounded_sample(spark, sf):
    return IO.bounded_sample(cleaned(spark, sf), key=sample_key())


@query("eval_sample", W(*CLEAN_CTES, body=f"""
SELECT {', '.join(RED + [S.TARGET])} FROM cleaned WHERE {SAMPLE_KEY_SQL} < 50000
  AND {' AND '.join(f'{c} IS NOT NULL' for c in RED + [S.TARGET])}"""))
def q_eval_sample(spark, sf):
    """5 % of all rows, reduced population."""
    return FE.training_frame(IO.eval_sample(cleaned(spark, sf), 0.05, key=sample_key()), "reduced")


@query("bootstrap_resample")
def q_bootstrap_resample(spark, sf):
    train, _ = train_test(spark, sf, "full")
    return M.bootstrap(train, S.FOREST_ROWS, seed=42)


@query("linear_regression")
def q_linear_regression(spark, sf):
    """OLS on the 13 features: coefficients, metrics on the test rows, and R2 on all rows."""
    train, test = train_test(spark, sf, "full")
    model = M.fit_linear(train, "full")
    coef = M.linear_coefficients(model, "full", spark)
    m = M.regression_metrics(M.predict(model, test, "full"), S.TARGET, "prediction")
    every = M.regression_metrics(M.predict(model, train.unionByName(test), "full"), S.TARGET, "prediction")
    return with_scalars(with_scalars(coef, m.select("mae", "mse", "rmse", "r2")), every.select(F.col("r2").alias("r2_all")))


# Normal equations of the least-squares fit: residuals sum to zero, alone and against each feature.
_RESIDUALS = [("(intercept)", "1")] + [(c, f"CAST({c} AS DOUBLE)") for c in RED]


@query("ols_residuals", " UNION ALL ".join(f"SELECT '{c}' AS feature, 0.0 AS residual_product" for c, _ in _RESIDUALS))
def q_ols_residuals(spark, sf):
    """Mean product of the residuals of the 7-feature OLS with each feature, on the scale of their spreads."""
    train, _ = train_test(spark, sf, "reduced")
    pred = M.predict(M.fit_linear(train, "reduced"), train, "reduced").withColumn("e", F.col(S.TARGET) - F.col("prediction"))
    sums = [(F.avg(F.col("e") * F.expr(x)) / F.greatest(F.lit(1.0), F.avg(F.abs(F.col("e")))
                                                       * F.avg(F.abs(F.expr(x))))).alias(c) for c, x in _RESIDUALS]
    wide = pred.agg(*sums)
    rows = F.array(*(F.struct(F.lit(c).alias("feature"), (F.round(F.col(f"`{c}`"), 4) + 0.0).alias("residual_product"))
                     for c, _ in _RESIDUALS))
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def _learners(spark):
    def linear(train, test, features):
        return M.predict(M.fit_linear(train, features), test, features)

    def boosted(train, test, features):
        return M.predict(M.fit_boosted(train, features, rounds=PRUNING_ROUNDS, depth=6, rate=0.1), test, features)

    def network(train, test, features):
        names = M.feature_list(features)
        scaler = M.Scaler.fit(train, names)
        model = NN.fit_mlp(M.log_target(scaler.transform(train)), names, "label_log", epochs=5)
        return NN.predict(scaler.transform(test), model, names, "p_log").withColumn(
            "prediction", F.greatest(F.lit(0.0), F.expm1("p_log")))

    return {"linear": linear, "boosted": boosted, "network": network}


# Rounds of the boosted trees in the comparison of feature lists (both lists alike).
PRUNING_ROUNDS = 200


@query("pruning_comparison")
def q_pruning_comparison(spark, sf):
    """Linear model, boosted trees and network on the full (13) and reduced (7) feature lists."""
    train, test = M.split(cleaned(spark, sf), key=split_key())
    return M.pruning_comparison(train, test, _learners(spark))


_FITTED: dict[tuple, str] = {}


def fitted_forest(spark, sf):
    """The forest, fitted once per application and input, and loaded from the shared folder."""
    import uuid
    key = X.input_stamp(spark, sf, "lineitem")
    if key not in _FITTED:
        train, _ = train_test(spark, sf, "full")
        path = f"{checkpoint_dir(spark).rstrip('/')}/models/forest-{uuid.uuid4().hex[:12]}"
        M.fit_forest(M.bootstrap(train, S.FOREST_ROWS, seed=42), "full", trees=FOREST_TREES, depth=FOREST_DEPTH).save(path)
        _FITTED[key] = path
    return forest.Forest.load(spark, _FITTED[key])


@query("random_forest")
def q_random_forest(spark, sf):
    _, test = train_test(spark, sf, "full")
    return metrics_row(M.predict(fitted_forest(spark, sf), test, "full"), "random_forest")


@query("feature_importance")
def q_feature_importance(spark, sf):
    return fitted_forest(spark, sf).importances()


@query("boosted_trees")
def q_boosted_trees(spark, sf):
    train, test = train_test(spark, sf, "reduced")
    model = M.fit_boosted(train, "reduced", rounds=BOOST_ROUNDS, depth=6, rate=0.1)
    return metrics_row(M.predict(model, test, "reduced"), "boosted_trees")


_TRAINED: dict[tuple, str] = {}


def train_mlp(spark, sf, epochs=5):
    """Fit scaler + network on the training split once per application; both are saved as Parquet
    tables in the shared folder and loaded back (as the serving side loads its saved model)."""
    import uuid
    train, test = train_test(spark, sf, "reduced")
    key = (*X.input_stamp(spark, sf, "lineitem"), epochs)
    path = _TRAINED.get(key)
    if path is None:
        path = f"{checkpoint_dir(spark).rstrip('/')}/models/mlp-{uuid.uuid4().hex[:12]}"
        scaler = M.Scaler.fit(train, RED)
        prep = lambda d: M.log_target(scaler.transform(d))
        model = NN.fit_mlp(prep(train), RED, "label_log", epochs=epochs, batch=512, validation=0.2, patience=5)
        scaler.save(f"{path}/scaler")
        model.save(spark, f"{path}/weights")
        _TRAINED[key] = path
    scaler = M.Scaler.load(spark, f"{path}/scaler")
    model = NN.MLPModel.load(spark, f"{path}/weights")
    return model, scaler, M.log_target(scaler.transform(test))


def seconds_metrics(pred, name, col="prediction"):
    df = pred.withColumn("prediction", F.greatest(F.lit(0.0), F.expm1(F.col(col))))
    return metrics_row(df, name)


@query("mlp_regression")
def q_mlp_regression(spark, sf):
    model, _, test = train_mlp(spark, sf)
    return seconds_metrics(NN.predict(test, model, RED, "p_log"), "mlp", "p_log")


@query("compare_variants")
def q_compare_variants(spark, sf):
    """Full vs int8-quantised network on 5% of all rows: MAE in seconds and mean drift from full."""
    model, scaler, _ = train_mlp(spark, sf)
    rows = FE.training_frame(IO.eval_sample(cleaned(spark, sf), 0.05, key=sample_key()), "reduced")
    sample = M.log_target(scaler.transform(rows))
    return NN.compare_variants(sample, {"full": model, "compressed": NN.quantize_model(model)}, RED, S.TARGET,
                               float32={"compressed": True})


@query("mlp_global")
def q_mlp_global(spark, sf):
    """The network trained with global batches: 12 epochs of 8 Adam steps, a step being a gradient over an eighth of all rows."""
    train, test = train_test(spark, sf, "reduced")
    scaler = M.Scaler.fit(train, RED)
    prep = lambda d: M.log_target(scaler.transform(d))
    model = NN.fit_global(prep(train), RED, "label_log", epochs=12, steps=8, lr=5e-3)
    return seconds_metrics(NN.predict(prep(test), model, RED, "p_log"), "mlp_global", "p_log")


@query("integer_drift")
def q_integer_drift(spark, sf):
    """The integer network, calibrated on all training rows: drift from the float one per layer, over all test rows."""
    model, integer, test = integer_model(spark, sf)
    return I8.layer_drift(test, model, integer, RED)


@query("integer_inference")
def q_integer_inference(spark, sf):
    """Test metrics of the integer network in seconds."""
    _, integer, test = integer_model(spark, sf)
    return seconds_metrics(I8.predict_integer(test, integer, RED, "p_log"), "mlp_integer", "p_log")


def integer_model(spark, sf):
    model, scaler, test = train_mlp(spark, sf)
    train, _ = train_test(spark, sf, "reduced")
    return model, I8.quantise(model, I8.calibrate(scaler.transform(train), model, RED)), test


@query("score_requests_mlp")
def q_score_requests_mlp(spark, sf):
    model, scaler, _ = train_mlp(spark, sf)
    nets = {"full": model, "compressed": NN.quantize_model(model)}
    valid, _ = SC.validate_requests(X.requests_from_star(spark, sf))
    return SC.score_requests(valid, None, scaler.params(), dispatch=NN.predictor(nets, {"compressed": True}),
                             variants=tuple(nets))


@query("random_split")
def q_random_split(spark, sf):
    """randomSplit([0.9, 0.1], 42) alternative: split sizes per side (approximate)."""
    train, test = M.split(cleaned(spark, sf), method="random", seed=42)
    return train.select(F.lit("train").alias("split")).unionByName(test.select(F.lit("test").alias("split"))) \
        .groupBy("split").count()


# ---------------------------------------------------------------- zone enrichment (extension)

ZONES_SQL = """
zones AS (SELECT CAST(n_nationkey + 1 AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone,
                 CASE WHEN n_regionkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
          FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def zones_from_star(spark, sf):
    """A small zone dimension built from nation/region (ids 1..25), standing in for the zone CSV."""
    n, r = X.table(spark, sf, "nation"), X.table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        (F.col("n_nationkey") + 1).cast("int").alias("LocationID"), F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("n_regionkey") % 2 == 0, "Boro Zone").otherwise("Yellow Zone").alias("service_zone"))


@query("enrich_zones", W(*CLEAN_CTES, ZONES_SQL, body="""
SELECT c.PULocationID, c.DOLocationID, c.trip_duration_seconds,
  pu.Borough AS pu_borough, pu.Zone AS pu_zone, pu.service_zone AS pu_service_zone,
  dz.Borough AS do_borough, dz.Zone AS do_zone, dz.service_zone AS do_service_zone
FROM cleaned c LEFT JOIN zones pu ON c.PULocationID = pu.LocationID LEFT JOIN zones dz ON c.DOLocationID = dz.LocationID"""))
def q_enrich_zones(spark, sf):
    df = cleaned(spark, sf).select("PULocationID", "DOLocationID", "trip_duration_seconds")
    return enrich_zones(df, zones_from_star(spark, sf))
