"""Modelling operators (inventory J1-J8, J10, J15, D20): Spark ML, DataFrame aggregates, `forest` and `boosting`."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.operators import boosting, forest


def feature_list(features: str | Sequence[str]) -> list[str]:
    if isinstance(features, str):
        return {"full": S.FULL_FEATURES, "reduced": S.REDUCED_FEATURES}[features]
    return list(features)


def assemble(df: DataFrame, features: str | Sequence[str] = "full", output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=feature_list(features), outputCol=output).transform(df)


def split_key(cols: Sequence[str], seed: int = 42) -> Column:
    """Default split key: a seeded 64-bit hash of the row's values (repeatable under repartitioning)."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(10))


def split(df: DataFrame, key: Column | None = None, test_tenths: int = 1, seed: int = 42,
          method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """Train/test split. hash: rows with key in [0, test_tenths) are test (stable, exact).
    random: `randomSplit` with seed (sizes approximate)."""
    if method == "random":
        frac = test_tenths / 10
        train, test = df.randomSplit([1 - frac, frac], seed)
        return train, test
    k = split_key(df.columns, seed) if key is None else key
    is_test = k < test_tenths
    return df.filter(~is_test), df.filter(is_test)


def bootstrap(df: DataFrame, n: int, seed: int = 42, total: int | None = None) -> DataFrame:
    """Resample about n rows with replacement (Poisson per row, so the size is approximate)."""
    total = df.count() if total is None else total
    return df.sample(withReplacement=True, fraction=n / max(total, 1), seed=seed)


@dataclass
class Scaler:
    """Standardisation state fitted on a training frame: mean and population std per feature
    (a zero std becomes 1). Stored as a tidy table; `transform` is plain column arithmetic."""

    table: DataFrame

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> Scaler:
        aggs = []
        for c in cols:
            aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}__mean"), F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std")]
        wide = df.agg(*aggs)
        rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"),
                         F.when(F.col(f"{c}__std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__std")).alias("scale"))
                for i, c in enumerate(cols)]
        return cls(wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))

    def params(self) -> list[tuple[str, float, float]]:
        """(feature, mean, scale) in feature order; one row per feature, so a bounded collect."""
        return [(r["feature"], r["mean"], r["scale"]) for r in self.table.orderBy("position").collect()]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        conv = {f"{f}{suffix}": (F.col(f).cast("double") - F.lit(m)) / F.lit(s) for f, m, s in self.params()}
        return df.withColumns(conv)

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> Scaler:
        return cls(spark.read.parquet(path))


def log_target(df: DataFrame, col: str = S.TARGET, out: str = "label_log") -> DataFrame:
    return df.withColumn(out, F.log1p(F.col(col).cast("double")))


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE and R^2 = 1 - SSE/SST in one aggregate (per group when `by`)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    g = df.groupBy(*by) if by else df.groupBy()
    m = g.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(y - p)).alias("mae"), F.avg(F.pow(y - p, 2)).alias("mse"),
              F.var_pop(y).alias("var_y"))
    return m.select(*by, F.col("n").cast("bigint").alias("n"), F.round("mae", 6).alias("mae"), F.round("mse", 6).alias("mse"),
                    F.round(F.sqrt("mse"), 6).alias("rmse"),
                    F.round(1 - F.try_divide(F.col("mse"), F.col("var_y")), 6).alias("r2"))


def fit_linear(train: DataFrame, features: str | Sequence[str] = "full", label: str = S.TARGET):
    """Ordinary least squares via the normal equations (distributed Gram matrix), no penalty."""
    lr = LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=0.0, elasticNetParam=0.0,
                          standardization=False)
    return lr.fit(assemble(train, features))


def fit_forest(sample: DataFrame, features: str | Sequence[str] = "full", label: str = S.TARGET, trees: int = 100,
               depth: int | None = None, seed: int = 42) -> forest.Forest:
    """A forest on a sample of bounded size (see `bootstrap`); depth None is unbounded."""
    return forest.fit(sample, feature_list(features), label, trees, depth, seed)


def fit_boosted(train: DataFrame, features: str | Sequence[str] = "reduced", label: str = S.TARGET, rounds: int = 200,
                depth: int = 6, rate: float = 0.1) -> boosting.Boosted:
    return boosting.fit(train, feature_list(features), label, rounds, depth, rate)


def predict(model, df: DataFrame, features: str | Sequence[str], output: str = "prediction") -> DataFrame:
    if isinstance(model, (forest.Forest, boosting.Boosted)):
        return model.predict(df, output)
    out = model.transform(assemble(df, features)).drop("features")
    return out.withColumnRenamed("prediction", output) if output != "prediction" else out


def linear_coefficients(model, features: str | Sequence[str], spark) -> DataFrame:
    names = feature_list(features) + ["(intercept)"]
    vals = [float(v) for v in model.coefficients.toArray()] + [float(model.intercept)]
    return spark.createDataFrame(list(zip(names, vals)), "feature string, coefficient double")


def pruning_comparison(train: DataFrame, test: DataFrame, learners: Mapping[str, Callable], label: str = S.TARGET) -> DataFrame:
    """Each learner on the full (13) and the reduced (7) feature list, every list on its own population (rows
    without nulls in its columns): one metrics row each. A learner maps (train, test, features) to predictions. Learners do
    not wait for each other: each submits its jobs from a thread of the driver, so one that is in a single task or between
    two short jobs leaves its cores to the others."""
    def row(name: str, kind: str) -> DataFrame:
        keep = [*feature_list(name), label]
        a, b = train.select(*keep).dropna("any"), test.select(*keep).dropna("any")
        return regression_metrics(learners[kind](a, b, name), label, "prediction").select(F.lit(f"{kind}_{name}").alias("model"), "*")

    pairs = [(name, kind) for name in ("full", "reduced") for kind in learners]
    with ThreadPoolExecutor(len(pairs)) as pool:
        rows = list(pool.map(inheritable_thread_target(train.sparkSession)(row), *zip(*pairs, strict=True)))
    return reduce(DataFrame.unionByName, rows)
