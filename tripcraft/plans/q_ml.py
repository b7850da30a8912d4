"""Registered modelling and scoring queries (J1-J15, D20, B28) and DuckDB twins where exact."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.operators import features as FE
from tripcraft.operators import ml as M
from tripcraft.operators.explore import with_scalars
from tripcraft.operators import score as SC
from tripcraft.plans import oracle_sql as O
from tripcraft.plans.queries import CLEAN_CTES, W, cleaned, query
from tripcraft.sources import fixtures as X

# Driver-repeatable split key: integer arithmetic DuckDB can evaluate identically.
SPLIT_SQL = "((PULocationID*31 + DOLocationID*17 + pickup_hour) % 10)"


def split_key():
    return F.pmod(F.col("PULocationID") * 31 + F.col("DOLocationID") * 17 + F.col("pickup_hour"), F.lit(10))


def train_test(spark, sf, population="reduced"):
    train, test = M.split(cleaned(spark, sf), key=split_key())
    return FE.training_frame(train, population), FE.training_frame(test, population)


RED = S.REDUCED_FEATURES
RED_KEEP = RED + [S.TARGET]
NN = " AND ".join(f"{c} IS NOT NULL" for c in RED_KEEP)
SPLIT_CTES = CLEAN_CTES + (f"""
trn AS (SELECT {', '.join(RED_KEEP)} FROM cleaned WHERE {SPLIT_SQL} <> 0 AND {NN}),
tst AS (SELECT {', '.join(RED_KEEP)} FROM cleaned WHERE {SPLIT_SQL} = 0 AND {NN}),
sc AS (SELECT """ + ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS m_{c}, CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1.0e0 "
    f"ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS s_{c}" for c in RED) + " FROM trn)",)


def zsql(c, src="t"):
    return f"(CAST({src}.{c} AS DOUBLE) - sc.m_{c}) / sc.s_{c}"


@query("train_test_split", W(*CLEAN_CTES, body=f"""
SELECT {', '.join(S.CLEAN_COLUMNS)}, CASE WHEN {SPLIT_SQL} = 0 THEN 'test' ELSE 'train' END AS split FROM cleaned"""))
def q_train_test_split(spark, sf):
    df = cleaned(spark, sf)
    return df.withColumn("split", F.when(split_key() == 0, "test").otherwise("train"))


@query("standardize", W(*SPLIT_CTES, body="SELECT " + ", ".join(f"round({zsql(c)}, 6) AS {c}" for c in RED)
                        + f", t.{S.TARGET} FROM tst t, sc"))
def q_standardize(spark, sf):
    train, test = train_test(spark, sf)
    scaler = M.Scaler.fit(train, RED)
    out = scaler.transform(test)
    return out.select(*[F.round(c, 6).alias(c) for c in RED], S.TARGET)


@query("scaler_params", W(*SPLIT_CTES, body=" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS feature, round(m_{c}, 6) AS mean, round(s_{c}, 6) AS scale FROM sc"
    for i, c in enumerate(RED))))
def q_scaler_params(spark, sf):
    train, _ = train_test(spark, sf)
    t = M.Scaler.fit(train, RED).table
    return t.select("position", "feature", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("scale"))


@query("log_target", W(*CLEAN_CTES, body=f"""
SELECT {S.TARGET}, round(ln(1 + {S.TARGET}), 9) AS label_log, round(exp(ln(1 + {S.TARGET})) - 1, 6) AS restored
FROM cleaned WHERE {NN}"""))
def q_log_target(spark, sf):
    df = M.log_target(FE.training_frame(cleaned(spark, sf), "reduced"))
    return df.select(S.TARGET, F.round("label_log", 9).alias("label_log"),
                     F.round(F.expm1("label_log"), 6).alias("restored"))


OLS_CTES = SPLIT_CTES + ("""
fit AS (SELECT regr_slope(trip_duration_seconds, trip_distance) AS slope,
               regr_intercept(trip_duration_seconds, trip_distance) AS intercept FROM trn),
alls AS (SELECT * FROM trn UNION ALL SELECT * FROM tst)""",)


def ols_fit(train):
    return train.agg(F.regr_slope(F.col(S.TARGET).cast("double"), "trip_distance").alias("slope"),
                     F.regr_intercept(F.col(S.TARGET).cast("double"), "trip_distance").alias("intercept"))


@query("ols_single", W(*OLS_CTES, body="""
SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept,
  round(1 - avg(pow(trip_duration_seconds - (intercept + slope * trip_distance), 2)) / var_pop(trip_duration_seconds), 6) AS r2_all
FROM alls, fit GROUP BY slope, intercept"""))
def q_ols_single(spark, sf):
    """Least squares duration ~ distance fitted on train; R^2 on all rows (train + test)."""
    train, test = train_test(spark, sf)
    fit = ols_fit(train)
    pred = with_scalars(train.unionByName(test), fit).withColumn(
        "p", F.col("intercept") + F.col("slope") * F.col("trip_distance"))
    m = M.regression_metrics(pred, S.TARGET, "p")
    return with_scalars(m, fit).select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"),
                                                F.col("r2").alias("r2_all"))


@query("regression_metrics", W(*OLS_CTES, """
ev AS (SELECT trip_duration_seconds AS y, intercept + slope * trip_distance AS p FROM tst, fit)""", body="""
SELECT count(*) AS n, round(avg(abs(y - p)), 6) AS mae, round(avg(pow(y - p, 2)), 6) AS mse,
  round(sqrt(avg(pow(y - p, 2))), 6) AS rmse, round(1 - avg(pow(y - p, 2)) / var_pop(y), 6) AS r2 FROM ev"""))
def q_regression_metrics(spark, sf):
    train, test = train_test(spark, sf)
    pred = with_scalars(test, ols_fit(train)).withColumn(
        "p", F.col("intercept") + F.col("slope") * F.col("trip_distance"))
    return M.regression_metrics(pred, S.TARGET, "p")


# ---------------------------------------------------------------- B28 validation, J12/J13 scoring

def _reasons_sql():
    parts = []
    for c, (lo, hi) in S.REQUEST_RANGES.items():
        ok = f"({c} > {lo} AND {c} <= {hi})" if c == "trip_distance" else f"({c} BETWEEN {lo} AND {hi})"
        parts.append(f"CASE WHEN {c} IS NULL THEN '{c}_missing' WHEN NOT {ok} THEN '{c}_out_of_range' END")
    return "concat_ws(',', " + ", ".join(parts) + ")"


REQ_COLS = ", ".join(RED + ["model_type"])


@query("validate_requests", W(O.REQUESTS, f"""
rv AS (SELECT *, {_reasons_sql()} AS reasons FROM requests)""", body=f"""
SELECT {REQ_COLS}, reasons = '' AS valid, reasons FROM rv"""))
def q_validate_requests(spark, sf):
    req = X.requests_from_star(spark, sf).withColumn("_r", SC.rule_failures())
    return req.select(*RED, "model_type", (F.size("_r") == 0).alias("valid"), F.array_join("_r", ",").alias("reasons"))


def _parsed_sql():
    """DuckDB twin of `parse_requests` over the bodies: type, text and number of every field, then the reasons."""
    kinds = ", ".join(f"json_type(j, '$.{c}') AS k_{c}, trim(json_extract_string(j, '$.{c}')) AS t_{c}" for c in RED)
    numbers = ", ".join(f"""CASE WHEN k_{c} = 'BOOLEAN' THEN CASE WHEN t_{c} = 'true' THEN 1.0e0 ELSE 0.0e0 END
      WHEN k_{c} IN ('UBIGINT', 'BIGINT', 'DOUBLE') OR (k_{c} = 'VARCHAR' AND regexp_full_match(t_{c}, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?'))
      THEN TRY_CAST(t_{c} AS DOUBLE) END AS n_{c}""" for c in RED)
    typed, reasons = [], []
    for c, (lo, hi) in S.REQUEST_RANGES.items():
        x = f"n_{c}" if c == "trip_distance" else f"CASE WHEN n_{c} = floor(n_{c}) THEN TRY_CAST(n_{c} AS BIGINT) END"
        ok = f"({x}) > {lo} AND ({x}) <= {hi}" if c == "trip_distance" else f"({x}) BETWEEN {lo} AND {hi}"
        typed.append(f"{x} AS {c}")
        reasons.append(f"CASE WHEN k_{c} IS NULL THEN '{c}_missing' WHEN n_{c} IS NULL THEN '{c}_not_a_number' "
                       f"WHEN ({x}) IS NULL THEN '{c}_not_whole' WHEN NOT ({ok}) THEN '{c}_out_of_range' END")
    return f"""
WITH li AS (SELECT l_orderkey, l_linenumber, l_orderkey*31 + l_partkey*17 + l_suppkey*7 + l_linenumber AS h, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
bodies AS (SELECT l_orderkey, l_linenumber, {X.BODY_SQL} AS body FROM li),
parsed AS (SELECT *, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j FROM bodies),
kinds AS (SELECT *, json_type(j) AS kind, {kinds} FROM parsed),
numbers AS (SELECT *, {numbers} FROM kinds)
SELECT l_orderkey, l_linenumber, {', '.join(typed)},
  CASE WHEN j IS NULL THEN 'invalid_json' WHEN kind <> 'OBJECT' THEN 'not_an_object' ELSE concat_ws(',', {', '.join(reasons)}) END AS reasons
FROM numbers"""


@query("parse_requests", _parsed_sql())
def q_parse_requests(spark, sf):
    """Request bodies (JSON text) to typed features and reasons."""
    parsed = SC.parse_requests(X.bodies_from_star(spark, sf))
    return parsed.select("l_orderkey", "l_linenumber", *RED, F.array_join("reasons", ",").alias("reasons"))


def linear_variants(train):
    """Two variants of one log-duration model: 'full' = OLS of log1p(seconds) on standardised
    distance fitted on train; 'compressed' = the same weights quantised to int8 per tensor."""
    scaler = M.Scaler.fit(train, RED)
    params = scaler.params()
    z = scaler.transform(train.select(*RED_KEEP), suffix="_z")
    row = z.agg(F.regr_slope(F.log1p(F.col(S.TARGET).cast("double")), "trip_distance_z").alias("b"),
                F.regr_intercept(F.log1p(F.col(S.TARGET).cast("double")), "trip_distance_z").alias("a")).first()
    a, b = float(row["a"]), float(row["b"])
    (qa, qb), _ = SC.quantize([a, b])
    idx = RED.index("trip_distance")

    def weights(w):
        return [w if i == idx else 0.0 for i in range(len(RED))]

    models = {"full": SC.linear_model(weights(b), a), "compressed": SC.linear_model(weights(qb), qa)}
    return models, params


SCORE_SQL = W(*SPLIT_CTES, O.REQUESTS, f"""
lf AS (SELECT regr_slope(ln(1 + CAST(trip_duration_seconds AS DOUBLE)), {zsql('trip_distance')}) AS b,
              regr_intercept(ln(1 + CAST(trip_duration_seconds AS DOUBLE)), {zsql('trip_distance')}) AS a FROM trn t, sc),
lq AS (SELECT a, b, greatest(abs(a), abs(b)) / 127 AS qs FROM lf),
lv AS (SELECT 'full' AS variant, a, b FROM lq
       UNION ALL SELECT 'compressed', round_even(a / qs, 0) * qs, round_even(b / qs, 0) * qs FROM lq),
rv AS (SELECT *, {_reasons_sql()} AS reasons FROM requests),
ok AS (SELECT * EXCLUDE (reasons), coalesce(model_type, 'compressed') AS model_used FROM rv WHERE reasons = ''),
pr AS (SELECT ok.*, greatest(0.0e0, exp(lv.a + lv.b * {zsql('trip_distance', 'ok')}) - 1) AS secs, lv.variant IS NOT NULL AS known
       FROM ok CROSS JOIN sc LEFT JOIN lv ON lv.variant = ok.model_used)""", body=f"""
SELECT {REQ_COLS}, model_used,
  CASE WHEN known THEN {O.round2('secs')} END AS trip_duration_seconds,
  CASE WHEN known THEN {O.round2('secs / 60.0e0')} END AS trip_duration_minutes,
  CASE WHEN NOT known THEN 'model not available: ' || model_used END AS error
FROM pr""")


@query("score_requests", SCORE_SQL)
def q_score_requests(spark, sf):
    train, _ = train_test(spark, sf)
    models, params = linear_variants(train)
    valid, _ = SC.validate_requests(X.requests_from_star(spark, sf))
    return SC.score_requests(valid, models, params)
