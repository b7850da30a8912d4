"""The spark-submit jobs end to end on sf0.001 (raw Parquet in, tables and models out)."""

import pytest

from tripcraft import schema as S
from tripcraft.jobs import clean, explore, score, train
from tripcraft.plans import pipeline as P
from tripcraft.sources import fixtures as X
from tripcraft.sources import io as IO


@pytest.fixture(scope="module")
def paths(spark, sf001, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    raw = str(base / "raw")
    X.trips_from_star(spark, sf001).write.parquet(raw)
    reqs = str(base / "requests")
    X.requests_from_star(spark, sf001).write.parquet(reqs)
    return {"base": base, "raw": raw, "requests": reqs, "cleaned": str(base / "cleaned")}


def test_clean_job_observations(spark, paths):
    raw = IO.read_trips(spark, paths["raw"])
    report = clean.run(spark, raw, paths["cleaned"], "exact")
    audit = {r.stage: r.rows for r in P.stage_audit(raw, P.learn_bounds(raw, "exact")).collect()}
    assert report["stages"] == audit
    out = IO.read_cleaned(spark, paths["cleaned"])
    assert out.columns == S.CLEAN_COLUMNS and out.count() == audit["duration"] == report["describe"]["rows"]
    assert spark.read.parquet(paths["cleaned"] + "_bounds").count() == 1


def test_clean_job_argument_precedence(monkeypatch):
    monkeypatch.setenv("TAXI_RAW_PATH", "/from/env")
    assert clean.parse_args([]).input == "/from/env"
    assert clean.parse_args(["--input", "/from/flag"]).input == "/from/flag"
    monkeypatch.delenv("TAXI_RAW_PATH")
    assert clean.parse_args([]).input == clean.DEFAULT_RAW_PATH


def test_explore_job_tables(spark, paths):
    tables = explore.chart_tables(IO.read_trips(spark, paths["raw"]), IO.read_cleaned(spark, paths["cleaned"]))
    assert len(tables) >= 25
    for name, df in tables.items():
        assert df.count() > 0, name


def test_train_and_score_jobs(spark, paths):
    models = str(paths["base"] / "models")
    m = train.run(spark, IO.read_cleaned(spark, paths["cleaned"]), models, trees=5, depth=5, rounds=3, epochs=2)
    assert {r.model for r in m.collect()} == {"linear_full", "linear_reduced", "forest", "boosted", "mlp_full",
                                              "mlp_compressed"}
    out = str(paths["base"] / "scored")
    assert score.main(["--models", models, "--requests", paths["requests"], "--output", out]) == 0
    scored, rejected = spark.read.parquet(out + "/scored"), spark.read.parquet(out + "/rejected")
    assert scored.count() + rejected.count() == spark.read.parquet(paths["requests"]).count()
    assert scored.filter("model_type = 'other'").filter("error IS NULL").count() == 0
