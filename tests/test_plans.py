"""Plan regression tests: the physical plans keep the shape the scale design relies on."""

import pytest

import __spark_entry__ as E
from tripcraft.operators import explore as X
from tripcraft.plans import pipeline as P
from tripcraft.sources import io as IO
from tripcraft.sources.fixtures import trips_from_star

SF = "/root/testdata/sf0.001"
CROSS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw_path(spark, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("plans") / "raw")
    trips_from_star(spark, SF).write.parquet(p)
    return p


def test_cleaning_is_one_stage_with_pushdown(spark, raw_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    raw = IO.read_trips(spark, raw_path)
    plan = plan_of(P.clean_trips(raw, P.Bounds(80.0, 3.6, 11.4)))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(total_amount,0.0)" in plan and "LessThanOrEqual(trip_distance,250.0)" in plan
    assert "Exchange" not in plan and "tip_amount" not in plan.split("ReadSchema")[1]


def test_nan_as_null_is_opt_in(spark, tmp_path):
    p = str(tmp_path / "nan")
    spark.createDataFrame([(float("nan"),), (1.0,)], "total_amount double").write.parquet(p)
    from pyspark.sql import functions as F
    df = spark.read.parquet(p)
    assert df.filter(F.col("total_amount") >= 0).count() == 2          # Spark: NaN is the largest value
    assert df.select(F.nanvl("total_amount", F.lit(None).cast("double")).alias("t")).filter("t >= 0").count() == 1


@pytest.mark.parametrize("key", ["hist_duration", "kde_duration", "hexbin_distance_duration", "correlation",
                                 "box_by_overcharge", "quantile_bounds", "ols_single", "regression_metrics"])
def test_no_cross_products(spark, key):
    df = E.queries()[key](spark, SF)
    df.collect()
    plan = plan_of(df)
    assert not any(c in plan for c in CROSS), key


def test_correlation_adds_one_row_of_moments_per_task(spark):
    df = E.queries()["correlation"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "stack(" not in plan and plan.count("MapInArrow") == 1 and "Join" not in plan


def test_rolling_mean_is_a_lag_not_a_join(spark):
    from tripcraft.operators import loadtest as L
    from tripcraft.sources import fixtures as X
    plan = L.rolling_latency(X.request_log_base(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "_place" in plan


def test_linear_scoring_stays_in_jvm_and_network_scoring_is_batched(spark):
    lin = E.queries()["score_requests"](spark, SF)
    assert not any(p in plan_of(lin) for p in ("ArrowEvalPython", "BatchEvalPython"))
    net = E.queries()["score_requests_mlp"](spark, SF)
    p = plan_of(net)
    assert "ArrowEvalPython" in p and "BatchEvalPython" not in p


def test_one_row_statistics_are_reused_subqueries(spark):
    df = E.queries()["hexbin_distance_duration"](spark, SF)
    df.collect()
    plan = plan_of(df)
    assert "ReusedSubquery" in plan


def test_scalar_attach_enforces_one_row(spark):
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError
    two = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    with pytest.raises((PySparkException, Py4JJavaError)):
        X.with_scalars(spark.range(3), two).collect()


@pytest.mark.parametrize("key", ["hist_density_by_flag", "box_by_overcharge", "hist_latency", "request_sequence"])
def test_statistics_joins_move_no_data_by_key(spark, key):
    """With the threshold of automatic broadcasts forced low, statistics are still what is broadcast: no data
    side is broadcast, and none is shuffled on the group key."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        df = E.queries()[key](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [line for line in plan.splitlines() if "Join" in line and "LeftOuter" not in line]
    assert joins and all("BroadcastHashJoin" in line and "BuildRight" in line for line in joins), plan


def test_large_statistics_are_salted(spark, monkeypatch):
    monkeypatch.setattr(X, "BROADCAST_BYTES", 0)
    big = spark.createDataFrame([(k % 2 if k % 7 else None, k) for k in range(200)], "g long, x long").repartition(5)
    small = big.groupBy("g").agg({"x": "max"}).withColumnRenamed("max(x)", "top")
    out = X.join_small(big, small, ["g"])
    assert "SortMergeJoin" in plan_of(out) and out.columns == ["g", "x", "top"]
    want = {r.g: r.top for r in small.collect()}
    rows = out.collect()
    assert len(rows) == 200 and all(r.top == want[r.g] for r in rows)
