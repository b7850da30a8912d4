"""Exploration job: every chart table of the raw and cleaned data, exact over all rows.

    spark-submit -m tripcraft.jobs.explore --raw RAW --cleaned CLEANED --output DIR

Each table is written as Parquet under DIR/<name>. The cleaned table is scanned per table with
only the columns that table needs (column pruning), instead of being sampled to one machine.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.session import ship_package
from tripcraft.functions import columns as C
from tripcraft.operators import explore as E
from tripcraft.operators import features as FE
from tripcraft.operators.quality import negative_counts
from tripcraft.plans import pipeline as P
from tripcraft.sources import io as IO


def chart_tables(raw, cleaned) -> dict:
    rf = P.raw_features(raw)
    cm = cleaned.withColumn("trip_duration_min", C.minutes("trip_duration_seconds"))
    d = F.col("trip_duration_min")
    rate = FE.zoom(FE.known_codes(rf, "RatecodeID", S.RATECODE_LABELS), {"speed_mph_proxy": (0, 120)})
    return {
        # raw data
        "raw_flag_combinations": E.flag_combinations(rf, ["has_negative_fee", "no_meter"], True, names=["neg_fee", "no_meter"]),
        "raw_negative_counts": negative_counts(raw),
        "raw_temporal_profile": E.temporal_profile(rf),
        "raw_shares": E.threshold_shares(rf, {"duration_negative": ("trip_duration_min", d < 0, None),
                                              "duration_over_3h": ("trip_duration_min", d > 180, d > 0),
                                              "speed_over_60": ("speed_mph_proxy", F.col("speed_mph_proxy") > 60, None)}),
        "raw_hist_duration": E.histogram(rf, "trip_duration_min", 200),
        "raw_hist_duration_zoom": E.histogram(FE.zoom(rf, {"trip_duration_min": (-30, 200)}), "trip_duration_min", 150),
        "raw_hist_duration_positive": E.histogram(rf.filter(d > 0), "trip_duration_min", 200),
        "raw_hist_duration_by_flag": E.histogram(FE.zoom(rf, {"trip_duration_min": (-30, 200)}), "trip_duration_min", 100,
                                                 by="has_negative_fee", density=True),
        "raw_hexbin": E.hexbin(rf, "trip_distance", "trip_duration_min", 60),
        "raw_hexbin_zoom": E.hexbin(FE.zoom(rf, {"trip_distance": (0, 40), "trip_duration_min": (0, 120)}),
                                    "trip_distance", "trip_duration_min", 60),
        "raw_correlation": E.correlation(FE.keep_present(rf, S.RAW_CORR_COLUMNS), [c for c in S.RAW_CORR_COLUMNS if c in rf.columns]),
        "raw_hist_speed": E.histogram(rf, "speed_mph_proxy", 300),
        "raw_hist_speed_zoom": E.histogram(FE.zoom(rf, {"speed_mph_proxy": (0, 120)}), "speed_mph_proxy", 120),
        "raw_kde_speed_zoom": E.kde(FE.zoom(rf, {"speed_mph_proxy": (0, 120)}), "speed_mph_proxy", bins=120),
        "raw_medians": E.medians(rf, {"speed_0_120": ("speed_mph_proxy", F.col("speed_mph_proxy").between(0, 120))}),
        "raw_speed_box_by_rate": E.box_stats(rate.withColumn("rate_label", C.label("RatecodeID", S.RATECODE_LABELS)),
                                             "speed_mph_proxy", "rate_label"),
        "raw_present_rate_labels": E.present_labels(FE.zoom(rf, {"speed_mph_proxy": (0, 120)}), "RatecodeID", S.RATECODE_LABELS),
        # cleaned data
        "hist_duration": E.histogram(cm, "trip_duration_min", 80),
        "kde_duration": E.kde(cm, "trip_duration_min"),
        "medians": E.medians(cm, {"duration_min": ("trip_duration_min", None),
                                  "speed_capped_60": ("speed_mph_proxy", F.col("speed_mph_proxy") <= 60)}),
        "hexbin": E.hexbin(cm, "trip_distance", "trip_duration_min", 60),
        "trend_line": E.trend_line(FE.drop_nulls(cm, ["trip_distance", "trip_duration_min"]), "trip_distance", "trip_duration_min"),
        "flag_combinations": E.flag_combinations(cm, ["flag_no_meter", "flag_overcharge"], sep="\n",
                                                 names=["no_meter", "overcharge"]),
        "box_by_overcharge": E.box_stats(cm, "trip_duration_min", "flag_overcharge"),
        "correlation": E.correlation(FE.keep_present(cm, S.CLEAN_CORR_COLUMNS), [c for c in S.CLEAN_CORR_COLUMNS if c in cm.columns]),
        "temporal_profile": E.temporal_profile(cm),
        "hist_speed": E.histogram(cm, "speed_mph_proxy", 100),
        "hist_speed_capped": E.histogram(cm.filter(F.col("speed_mph_proxy") <= 60), "speed_mph_proxy", 80),
        "kde_speed": E.kde(cm, "speed_mph_proxy", bins=100),
        "kde_speed_capped": E.kde(cm.filter(F.col("speed_mph_proxy") <= 60), "speed_mph_proxy", bins=80),
        "speed_shares": E.threshold_shares(cm, {"speed_over_60": ("speed_mph_proxy", F.col("speed_mph_proxy") > 60, None)}),
    }


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description="Write exploration tables.")
    ap.add_argument("--raw", required=True)
    ap.add_argument("--cleaned", required=True)
    ap.add_argument("--output", required=True)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("tripcraft-explore").getOrCreate()
    ship_package(spark)
    tables = chart_tables(IO.read_trips(spark, args.raw), IO.read_cleaned(spark, args.cleaned))
    for name, df in tables.items():
        df.repartition(1).write.mode("overwrite").parquet(f"{args.output.rstrip('/')}/{name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
