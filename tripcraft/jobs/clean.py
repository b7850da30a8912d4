"""Cleaning job: raw trip Parquet -> cleaned trip Parquet (+ bounds table and stage audit).

    spark-submit -m tripcraft.jobs.clean --input RAW --output CLEANED [--quantiles approx|exact]

Paths: flag, else environment variable, else default. Scans: (1) q75 of the raw total,
(2) distance quartiles after the money filters, (3) the write itself, which also fills two
Observations: row counts after each stage (on the raw side) and count/mean/stddev/min/max of
the summary columns (on the cleaned side). No further actions re-read the data.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.session import ship_package
from tripcraft.functions import columns as C
from tripcraft.operators import quality as Q
from tripcraft.plans import pipeline as P
from tripcraft.sources import io as IO

DEFAULT_RAW_PATH = "./YellowTripData"
DEFAULT_OUTPUT_PATH = "./Data/Data_Cleaned"


def parse_args(argv=None):
    ap = argparse.ArgumentParser(description="Clean raw trip Parquet data.")
    ap.add_argument("--input", default=os.getenv("TAXI_RAW_PATH", DEFAULT_RAW_PATH),
                    help="Raw Parquet path (or env TAXI_RAW_PATH).")
    ap.add_argument("--output", default=os.getenv("TAXI_CLEANED_PATH", DEFAULT_OUTPUT_PATH),
                    help="Cleaned Parquet path (or env TAXI_CLEANED_PATH).")
    ap.add_argument("--quantiles", choices=["approx", "exact"], default="approx")
    ap.add_argument("--partition-by", default="", help="Optional comma-separated partition columns, e.g. pickup_month.")
    return ap.parse_args(argv)


def run(spark: SparkSession, raw, output: str, quantiles: str = "approx", partition_by=()) -> dict:
    bounds = P.learn_bounds(raw, quantiles)
    stage_obs = Observation("stages")
    money, dist = Q.money_ok(), (F.col("trip_distance") > 0) & (F.col("trip_distance") <= F.lit(bounds.distance_upper))
    dur = C.duration_seconds().between(bounds.duration_min, bounds.duration_max)
    observed = raw.observe(
        stage_obs, F.count(F.lit(1)).alias("raw"), F.count_if(money).alias("money"),
        F.count_if(money & C.overcharge(bounds.q75_total)).alias("overcharge_flagged"),
        F.count_if(money & dist).alias("distance"), F.count_if(money & dist & dur).alias("duration"))
    cleaned = P.clean_trips(observed, bounds)
    desc_obs = Observation("describe")
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in S.DESCRIBE_COLUMNS:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}_mean"), F.stddev_samp(x).alias(f"{c}_stddev"),
                 F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max")]
    IO.write_cleaned(cleaned.observe(desc_obs, *aggs), output, partition_by)
    bounds.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{output.rstrip('/')}_bounds")
    return {"bounds": bounds.as_dict(), "stages": stage_obs.get, "describe": desc_obs.get}


def main(argv=None) -> int:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("tripcraft-clean").getOrCreate()
    ship_package(spark)
    raw = IO.read_trips(spark, args.input)
    parts = [p for p in args.partition_by.split(",") if p]
    report = run(spark, raw, args.output, args.quantiles, parts)
    print(json.dumps(report, default=str, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
