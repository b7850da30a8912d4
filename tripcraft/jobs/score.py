"""Scoring job: validate and score a batch (or a stream) of prediction requests.

    spark-submit -m tripcraft.jobs.score --models DIR --requests PATH --output OUT [--stream]

Models come from the training job (scaler + full and compressed networks). Accepted requests
are written to OUT/scored, rejected ones (with reasons) to OUT/rejected. With --stream, new
Parquet files under PATH are scored as they land (Structured Streaming, foreachBatch sinks).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.session import ship_package
from tripcraft.operators import ml as M
from tripcraft.operators import mlp as NN
from tripcraft.operators import score as SC
from tripcraft.streaming import stream as ST


def load(spark, models_dir: str):
    scaler = M.Scaler.load(spark, f"{models_dir}/scaler")
    nets = {"full": NN.MLPModel.load(spark, f"{models_dir}/mlp_full"),
            "compressed": NN.MLPModel.load(spark, f"{models_dir}/mlp_compressed")}
    return scaler.params(), nets


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description="Score trip-duration requests.")
    ap.add_argument("--models", required=True)
    ap.add_argument("--requests", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--checkpoint", help="stream progress; the same folder in every run (default OUT/_checkpoint)")
    ap.add_argument("--default", default=S.DEFAULT_VARIANT)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("tripcraft-score").getOrCreate()
    ship_package(spark)
    params, nets = load(spark, args.models)
    kw = dict(dispatch=NN.predictor(nets, {"compressed": True}), variants=tuple(nets), default=args.default)
    out = args.output.rstrip("/")
    if args.stream:
        reqs = ST.read_stream(spark, args.requests, S.REQUEST_SCHEMA)
        ST.stream_score(reqs, None, params, f"{out}/scored", f"{out}/rejected",
                        args.checkpoint or f"{out}/_checkpoint", trigger={"processingTime": "10 seconds"}, **kw).awaitTermination()
        return 0
    reqs = spark.read.schema(S.REQUEST_SCHEMA).parquet(args.requests)
    valid, rejected = SC.validate_requests(reqs)
    SC.score_requests(valid, None, params, **kw).write.mode("overwrite").parquet(f"{out}/scored")
    rejected.withColumn("reasons", F.array_join("reasons", ",")).write.mode("overwrite").parquet(f"{out}/rejected")
    return 0


if __name__ == "__main__":
    sys.exit(main())
