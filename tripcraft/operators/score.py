"""Request validation and batch scoring (inventory B28, J12, J13).

A request batch is validated row by row with native expressions; failures become rejected rows
with reasons instead of failing the job. Valid rows are routed to the model variant they ask for
(default: compressed), standardised with the training scaler, scored, and turned into seconds
(expm1 of the log prediction, clamped at 0) and minutes (from the unrounded seconds).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft import schema as S


def rule_failures() -> Column:
    """Array of failed rule names per request ('<field>_missing' for nulls)."""
    checks = []
    for c, (lo, hi) in S.REQUEST_RANGES.items():
        x = F.col(c)
        ok = (x > lo) & (x <= hi) if c == "trip_distance" else x.between(lo, hi)
        checks.append(F.when(x.isNull(), F.lit(f"{c}_missing")).when(~ok, F.lit(f"{c}_out_of_range")))
    return F.array_compact(F.array(*checks))


def rules_ok() -> Column:
    """All seven range rules hold (never null: a missing field fails its rule). A conjunction of
    plain comparisons, so it reaches a Parquet scan as pushed filters."""
    cond = F.lit(True)
    for c, (lo, hi) in S.REQUEST_RANGES.items():
        x = F.col(c)
        ok = (x > lo) & (x <= hi) if c == "trip_distance" else x.between(lo, hi)
        cond = cond & x.isNotNull() & ok
    return cond


def validate_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): valid rows pass all seven range rules; rejected rows carry `reasons`."""
    valid = df.filter(rules_ok())
    rejected = df.filter(~rules_ok()).withColumn("reasons", rule_failures())
    return valid, rejected


# Text of a number, and of a whole number, that a body may carry in quotes.
_NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def parse_requests(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Request bodies (JSON text) to typed requests: adds the seven features, `model_type` and `reasons`.

    A body that is null or no JSON gives 'invalid_json', one that is no object 'not_an_object'. Fields are coerced one by
    one: numbers, numbers in quotes and booleans (1 or 0) are taken; a whole-number field takes them only without a
    fraction. Otherwise the field is null and its reason '<field>_missing' (absent), '<field>_not_a_number' (null, other
    text, list, object, beyond 64 bits) or '<field>_not_whole'. Coerced values are then held against the accepted
    ranges ('<field>_out_of_range'). All reasons of a body are listed, in field order; none means the request is valid."""
    # step by step: a field is looked up, and its kind and text are made, once per row
    fields = list(S.REQUEST_RANGES)
    out = bodies.withColumn("_v", F.try_parse_json(F.col(body)))
    out = out.withColumns({f"_f_{c}": F.try_variant_get("_v", f"$.{c}", "variant") for c in fields})
    out = out.withColumns({f"_k_{c}": F.schema_of_variant(f"_f_{c}") for c in fields}
                          | {f"_t_{c}": F.trim(F.try_variant_get(f"_f_{c}", "$", "string")) for c in fields}
                          | {"model_type": F.try_variant_get("_v", "$.model_type", "string")})
    numbers = {}
    for c in fields:
        kind, text = F.col(f"_k_{c}"), F.col(f"_t_{c}")
        scalar = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$") | ((kind == "STRING") & text.rlike(_NUMBER))
        numbers[f"_n_{c}"] = F.when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0)).when(scalar, text.try_cast("double"))
    out = out.withColumns(numbers)
    typed, reasons = {}, []
    for c, (lo, hi) in S.REQUEST_RANGES.items():
        number = F.col(f"_n_{c}")
        if isinstance(S.REQUEST_SCHEMA[c].dataType, T.LongType):
            typed[c] = F.when(number == F.floor(number), number).try_cast("bigint")
        else:
            typed[c] = number
        x = F.col(c)
        ok = (x > lo) & (x <= hi) if c == "trip_distance" else x.between(lo, hi)
        reasons.append(F.when(F.col(f"_f_{c}").isNull(), F.lit(f"{c}_missing"))
                       .when(number.isNull(), F.lit(f"{c}_not_a_number"))
                       .when(x.isNull(), F.lit(f"{c}_not_whole"))
                       .when(~ok, F.lit(f"{c}_out_of_range")))
    out = out.withColumns(typed)
    # only an object has fields; the whole body's schema is asked for where it has none of them
    is_object = F.coalesce(*(F.col(f"_k_{c}") for c in fields)).isNotNull() | F.schema_of_variant("_v").startswith("OBJECT")
    out = out.withColumn("reasons", F.when(F.col("_v").isNull(), F.array(F.lit("invalid_json")))
                         .when(~is_object, F.array(F.lit("not_an_object"))).otherwise(F.array_compact(F.array(*reasons))))
    return out.select(*bodies.columns, *(c for c in (*fields, "model_type", "reasons") if c not in bodies.columns))


def quarantine(parsed: DataFrame, valid_path: str, rejected_path: str, body: str = "body") -> None:
    """Write valid requests (typed, without their text) and rejected bodies (text and reasons) to two tables."""
    parsed.filter(F.size("reasons") == 0).drop("reasons", body).write.mode("append").parquet(valid_path)
    parsed.filter(F.size("reasons") > 0).select(body, F.array_join("reasons", ",").alias("reasons")).write.mode("append").parquet(rejected_path)


# A model maps standardised feature columns (in request feature order) to a log-seconds prediction.
ModelFn = Callable[[list[Column]], Column]


def linear_model(weights: list[float], intercept: float) -> ModelFn:
    def fn(xs: list[Column]) -> Column:
        acc = F.lit(float(intercept))
        for w, x in zip(weights, xs):
            acc = acc + F.lit(float(w)) * x
        return acc
    return fn


def score_requests(df: DataFrame, models: Mapping[str, ModelFn] | None, scaler_params: list[tuple[str, float, float]],
                   default: str = S.DEFAULT_VARIANT, variant_col: str = "model_type",
                   dispatch: Callable[[Column, list[Column]], Column] | None = None,
                   variants: tuple[str, ...] = ()) -> DataFrame:
    """Score validated requests. Output adds model_used, trip_duration_seconds, trip_duration_minutes
    and error (null when scored). A variant that is unknown or not loaded yields an error row.

    Models are either native column functions per variant (`models`), or one batched `dispatch`
    (e.g. a pandas UDF running several networks) serving the names in `variants`."""
    params = {f: (m, s) for f, m, s in scaler_params}
    xs = [(F.col(f).cast("double") - F.lit(params[f][0])) / F.lit(params[f][1]) for f in S.REDUCED_FEATURES]
    variant = F.coalesce(F.col(variant_col), F.lit(default))
    names = tuple(models or ()) + tuple(variants)
    known = variant.isin(*names) if names else F.lit(False)
    if dispatch is not None:
        log_pred = dispatch(variant, xs)
    else:
        log_pred = F.lit(None).cast("double")
        for name, fn in (models or {}).items():
            log_pred = F.when(variant == name, fn(xs)).otherwise(log_pred)
    secs = F.greatest(F.lit(0.0), F.expm1(log_pred))
    out = df.withColumns({"model_used": variant, "_secs": secs})
    return out.select(
        *df.columns, "model_used",
        F.when(known, F.round("_secs", 2)).alias("trip_duration_seconds"),
        F.when(known, F.round(F.col("_secs") / 60.0, 2)).alias("trip_duration_minutes"),
        F.when(~known, F.concat(F.lit("model not available: "), variant)).alias("error"))


def quantize(values: list[float], bits: int = 8) -> tuple[list[float], float]:
    """Per-tensor symmetric quantisation: q = rint(w / scale), scale = max|w| / (2^(bits-1) - 1);
    returns the dequantised values q * scale and the scale."""
    import numpy as np
    w = np.asarray(values, dtype=np.float64)
    qmax = 2 ** (bits - 1) - 1
    m = float(np.max(np.abs(w))) if w.size else 0.0
    scale = m / qmax if m > 0 else 1.0
    q = np.clip(np.rint(w / scale), -qmax, qmax)
    return (q * scale).tolist(), scale
