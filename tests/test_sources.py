"""Sources and sinks: summary CSV with a byte-order mark, zone CSV, samples, synthetic requests."""

from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.operators import ml as M
from tripcraft.operators import mlp as NN
from tripcraft.operators.zones import enrich_zones
from tripcraft.sources import fixtures as X
from tripcraft.sources import io as IO

SUMMARY_CSV = "﻿,Value\nTotal Requests,1000\nSuccessful,742\nFailed,258\nError Rate (%),25.8\n"
ZONES_CSV = ('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
             '2,"Queens","Jamaica Bay","Boro Zone"\n4,"Manhattan","Alphabet City","Yellow Zone"\n'
             '264,"Unknown","N/A","N/A"\n265,"N/A","Outside of NYC","N/A"\n')


def test_summary_csv_with_bom(spark, tmp_path):
    p = tmp_path / "summary.csv"
    p.write_text(SUMMARY_CSV, encoding="utf-8")
    df = IO.read_summary_csv(spark, str(p))
    rows = {r.metric: r.value for r in df.collect()}
    assert rows == {"Total Requests": 1000.0, "Successful": 742.0, "Failed": 258.0, "Error Rate (%)": 25.8}


def test_zone_csv_keeps_na_text_and_enriches(spark, tmp_path):
    p = tmp_path / "zones.csv"
    p.write_text(ZONES_CSV)
    zones = IO.read_zones(spark, str(p))
    assert zones.filter(F.col("Zone") == "N/A").count() == 1 and zones.filter(F.col("Borough") == "N/A").count() == 1
    trips = spark.createDataFrame([(264, 1), (2, 999)], "PULocationID long, DOLocationID long")
    out = {r.PULocationID: r for r in enrich_zones(trips, zones).collect()}
    assert out[264].pu_zone == "N/A" and out[264].do_zone == "Newark Airport"
    assert out[2].pu_borough == "Queens" and out[2].do_zone is None


def test_synthetic_requests_ranges(spark):
    df = IO.synthetic_requests(spark, 5000, seed=1)
    r = df.agg(*[F.min(c).alias(f"mn_{c}") for c in S.REDUCED_FEATURES], *[F.max(c).alias(f"mx_{c}") for c in S.REDUCED_FEATURES]).first()
    assert (r.mn_pickup_dayofweek, r.mx_pickup_dayofweek) == (1, 7) and (r.mn_payment_type, r.mx_payment_type) == (1, 4)
    assert r.mn_trip_distance >= 0.1 and r.mx_trip_distance <= 11.0 and r.mx_passenger_count == 6
    assert df.filter((F.col("is_weekend") == 1) != F.col("pickup_dayofweek").isin(1, 7)).count() == 0


def test_bounded_sample_fraction(spark):
    df = spark.range(10_000)
    assert IO.bounded_sample(df, n=20_000).count() == 10_000
    assert 1_500 < IO.bounded_sample(df, n=2_000, seed=3).count() < 2_500


def test_bootstrap_with_replacement(spark):
    df = spark.range(1000)
    b = M.bootstrap(df, 5000, seed=2)
    assert 4_500 < b.count() < 5_500 and b.select("id").distinct().count() < 1000


def test_early_stopping_restores_best(spark):
    import numpy as np
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1500, 2))
    y = x[:, 0] * 0.5 + rng.normal(0, 0.1, 1500)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    model = NN.fit_mlp(df, ["a", "b"], "y", hidden=(8, 8), epochs=6, batch=64, validation=0.3, patience=2, lr=0.05)
    best = min(h["val_loss"] for h in model.history)
    is_val = F.pmod(F.xxhash64(F.lit(42), F.col("a"), F.col("b"), F.col("y")), F.lit(100)) < 30
    assert abs(NN.mse_frame(df.filter(is_val), model, ["a", "b"], "y") - best) < 1e-9
    assert len(model.history) <= 6


def test_summary_csv_roundtrip(spark, tmp_path):
    from tripcraft.operators import loadtest as L
    log = spark.createDataFrame([("A", 1, 0.1, True, 0.0), ("A", 2, 0.3, False, 1.5)],
                                "run_id string, event_id long, latency double, success boolean, elapsed double")
    tall = IO.summary_to_tall(L.summarize_log(log), ["run_id"]).select("metric", "value")
    out = str(tmp_path / "csv")
    IO.write_summary_csv(tall, out)
    back = {r.metric: r.value for r in IO.read_summary_csv(spark, out).collect()}
    assert back["Total Requests"] == 2.0 and back["Failed"] == 1.0 and back["Error Rate (%)"] == 50.0
    assert back["Median Latency (ms)"] == 200.0 and back["Total Time (s)"] == 1.5


def test_mixed_physical_types(spark, tmp_path):
    """Files that store a column as 32-bit, 64-bit or double, in another case or not at all, are read in full."""
    whole = X.trips_from_star(spark, "/root/testdata/sf0.001").filter("PULocationID <= 40")
    ints = [c.name for c in S.RAW_TRIP_SCHEMA if c.dataType.simpleString() == "bigint"]
    variants = [lambda d: d, lambda d: d.withColumns({c: d[c].cast("int") for c in ints}),
                lambda d: d.withColumns({c: d[c].cast("double") for c in ints}),
                lambda d: d.withColumnRenamed("Airport_fee", "airport_fee")]
    parts = [whole.filter(f"PULocationID % 4 = {k}") for k in range(4)]
    for k, (part, change) in enumerate(zip(parts, variants, strict=True)):
        change(part).coalesce(1).write.parquet(str(tmp_path / "raw" / f"month={k}"))
    got, report = IO.read_trips_mixed(spark, str(tmp_path / "raw"))
    assert got.schema.simpleString() == S.RAW_TRIP_SCHEMA.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    rows = {(r.column, r.found) for r in report.collect()}
    assert rows == {(c, t) for c in ints for t in ("int", "double")}
    parts[0].drop("cbd_congestion_fee").coalesce(1).write.parquet(str(tmp_path / "raw" / "month=9"))
    again, report = IO.read_trips_mixed(spark, str(tmp_path / "raw"))
    assert again.count() == whole.count() + parts[0].count()
    assert ("cbd_congestion_fee", None) in {(r.column, r.found) for r in report.collect()}
