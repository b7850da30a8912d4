"""Training job: fit the regressors on the cleaned table, write metrics and model artefacts.

    spark-submit -m tripcraft.jobs.train --cleaned CLEANED --output DIR [--models linear,forest,boosted,mlp]

Artefacts: DIR/scaler (feature, mean, scale), DIR/mlp_full and DIR/mlp_compressed (weight tables),
DIR/linear_* (Spark ML models), DIR/forest and DIR/boosted (node tables), DIR/metrics (one row per model).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.session import ship_package
from tripcraft.operators import features as FE
from tripcraft.operators import ml as M
from tripcraft.operators import mlp as NN
from tripcraft.sources import io as IO


def run(spark, cleaned, output: str, models=("linear", "forest", "boosted", "mlp"), trees=100, depth=None,
        forest_rows=S.FOREST_ROWS, rounds=200, epochs=5, seed=42):
    train_c, test_c = M.split(cleaned, seed=seed)
    metrics = []

    def record(name, pred, col="prediction"):
        metrics.append(M.regression_metrics(pred, S.TARGET, col).select(F.lit(name).alias("model"), "*"))

    full_tr, full_te = FE.training_frame(train_c, "full"), FE.training_frame(test_c, "full")
    red_tr, red_te = FE.training_frame(train_c, "reduced"), FE.training_frame(test_c, "reduced")
    if "linear" in models:
        for feats, tr, te in (("full", full_tr, full_te), ("reduced", red_tr, red_te)):
            m = M.fit_linear(tr, feats)
            m.write().overwrite().save(f"{output}/linear_{feats}")
            record(f"linear_{feats}", M.predict(m, te, feats))
    if "forest" in models:
        m = M.fit_forest(M.bootstrap(full_tr, forest_rows, seed), "full", trees=trees, depth=depth, seed=seed)
        m.save(f"{output}/forest")
        m.importances().write.mode("overwrite").parquet(f"{output}/forest_importances")
        record("forest", M.predict(m, full_te, "full"))
    if "boosted" in models:
        m = M.fit_boosted(red_tr, "reduced", rounds=rounds)
        m.nodes(spark).write.mode("overwrite").parquet(f"{output}/boosted")
        record("boosted", M.predict(m, red_te, "reduced"))
    if "mlp" in models:
        scaler = M.Scaler.fit(red_tr, S.REDUCED_FEATURES)
        scaler.save(f"{output}/scaler")
        prep = lambda d: M.log_target(scaler.transform(d))
        # Per-epoch state in the output folder: a re-submitted job resumes instead of restarting.
        net = NN.fit_mlp(prep(red_tr), S.REDUCED_FEATURES, "label_log", epochs=epochs, seed=seed,
                         resume_dir=f"{output}/mlp_state")
        small = NN.quantize_model(net)
        net.save(spark, f"{output}/mlp_full")
        net.save(spark, f"{output}/mlp_compressed", compressed=True)
        te = prep(red_te)
        for name, m in (("mlp_full", net), ("mlp_compressed", small)):
            p = NN.predict(te, m, S.REDUCED_FEATURES, "p_log").withColumn(
                "prediction", F.greatest(F.lit(0.0), F.expm1("p_log")))
            record(name, p)
    out = metrics[0]
    for m in metrics[1:]:
        out = out.unionByName(m)
    out.coalesce(1).write.mode("overwrite").parquet(f"{output}/metrics")
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description="Train trip-duration regressors.")
    ap.add_argument("--cleaned", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--models", default="linear,forest,boosted,mlp")
    ap.add_argument("--trees", type=int, default=100)
    ap.add_argument("--depth", type=int, default=None, help="tree depth of the forest (default: until leaves are pure)")
    ap.add_argument("--forest-rows", type=int, default=S.FOREST_ROWS, help="rows the forest is fitted on (resampled)")
    ap.add_argument("--rounds", type=int, default=200)
    ap.add_argument("--epochs", type=int, default=5)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("tripcraft-train").getOrCreate()
    ship_package(spark)
    run(spark, IO.read_cleaned(spark, args.cleaned), args.output.rstrip("/"), tuple(args.models.split(",")),
        trees=args.trees, depth=args.depth, forest_rows=args.forest_rows, rounds=args.rounds, epochs=args.epochs).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
