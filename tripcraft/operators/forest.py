"""Regression forest of unbounded depth (inventory J7, F3): one task per tree, the forest as a table of nodes.

The forest is fitted on a resample of bounded size (``ml.bootstrap``), so the sample, at most ``rows`` rows
of a few numbers, is broadcast, and Spark runs one task per tree. A tree draws its own bootstrap of the
sample, counts equal rows once with a weight, and grows level by level until its leaves are pure: for every
column the rows are sorted by (node, value rank), running sums give the squared-error gain of every cut between two
neighbouring values of a node, and the best cut of each node is kept. A level costs one sort per column however many
nodes it has.

The result is a table of nodes (tree, node, feature, threshold, left, right, value, weight, gain) in the shared folder:
a lost task refits its tree only, importances are one aggregate of it, and a saved forest is a Parquet table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft import schema as S
from tripcraft.session import stored

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double, weight double, gain double"
_ARROW = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("threshold", pa.float64()), ("left", pa.int32()),
                    ("right", pa.int32()), ("value", pa.float64()), ("weight", pa.float64()), ("gain", pa.float64())])
LEAF = -1


def best_cuts(ranks: np.ndarray, node: np.ndarray, nodes: int, y: np.ndarray, w: np.ndarray, least: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node the best (feature, rank below the cut, rank above it, gain); feature LEAF if no cut gains.

    ``ranks`` is columns x rows. The gain of a cut is the decrease of the summed squared error; of equal gains the
    first column and the lowest cut win."""
    total_w, total_s = np.bincount(node, w, nodes), np.bincount(node, w * y, nodes)
    feature, low, high = np.full(nodes, LEAF), np.zeros(nodes, dtype=np.int64), np.zeros(nodes, dtype=np.int64)
    gain = least.copy()
    ends = np.cumsum(np.bincount(node, minlength=nodes))
    base_w = np.concatenate([[0.0], np.cumsum(total_w)[:-1]])
    base_s = np.concatenate([[0.0], np.cumsum(total_s)[:-1]])
    whole = total_s ** 2 / total_w
    for f, rank in enumerate(ranks):
        width = int(rank.max()) + 1
        keys = node * width + rank
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        at = np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1])  # last row of a value, more rows follow
        n = node[order[at]]
        at, n = at[at + 1 < ends[n]], n[at + 1 < ends[n]]  # cuts inside a node
        if not len(at):
            continue
        left_w = np.cumsum(w[order])[at] - base_w[n]
        left_s = np.cumsum((w * y)[order])[at] - base_s[n]
        g = left_s ** 2 / left_w + (total_s[n] - left_s) ** 2 / (total_w[n] - left_w) - whole[n]
        first = np.flatnonzero(np.concatenate([[True], n[1:] != n[:-1]]))
        top = np.maximum.reduceat(g, first)
        who = n[first]
        better = top > gain[who]
        hit = np.flatnonzero(g == np.repeat(top, np.diff(np.append(first, len(g)))))
        pick = hit[np.concatenate([[True], n[hit[1:]] != n[hit[:-1]]])]  # lowest cut of each node
        who, pick, top = who[better], pick[better], top[better]
        feature[who], gain[who] = f, top
        low[who], high[who] = rank[order[at[pick]]], rank[order[at[pick] + 1]]
    return feature, low, high, gain


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int | None = None) -> dict[str, np.ndarray]:
    """A regression tree over rows ``x`` (rows x columns), labels ``y`` and weights ``w``; arrays per node, root first.

    A cut lies halfway between two neighbouring values of its node; rows at or below it go left. A node is a leaf when
    its labels are equal, no column differs, or at ``depth``."""
    values, ranks = zip(*(np.unique(c, return_inverse=True) for c in x.T), strict=True)
    ranks = np.array([r.reshape(-1) for r in ranks], dtype=np.int64)
    out: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "value", "weight", "gain")}
    rows, node, nodes, total = np.arange(len(y)), np.zeros(len(y), dtype=np.int64), 1, 1
    level = 0
    while nodes:
        yr, wr = y[rows], w[rows]
        weight = np.bincount(node, wr, nodes)
        mean = np.bincount(node, wr * yr, nodes) / weight
        high_y, low_y = np.full(nodes, -np.inf), np.full(nodes, np.inf)
        np.maximum.at(high_y, node, yr)
        np.minimum.at(low_y, node, yr)
        mixed = high_y > low_y
        open_rows = mixed[node]
        feature, threshold, gain = np.full(nodes, LEAF), np.full(nodes, np.nan), np.zeros(nodes)
        if open_rows.any() and (depth is None or level < depth):
            number = np.cumsum(mixed) - 1  # open nodes without gaps
            # rounding of the sums is no gain
            least = 1e-12 * np.bincount(node, wr * yr ** 2, nodes)[mixed]
            f, low, high, g = best_cuts(ranks[:, rows[open_rows]], number[node[open_rows]], int(mixed.sum()),
                                        yr[open_rows], wr[open_rows], least)
            where = np.flatnonzero(mixed)
            cut = f != LEAF
            feature[where[cut]], gain[where[cut]] = f[cut], g[cut]
            for c in np.unique(f[cut]):
                of = where[f == c]
                threshold[of] = (values[c][low[f == c]] + values[c][high[f == c]]) / 2
        split = feature != LEAF
        child = np.where(split, total + 2 * (np.cumsum(split) - 1), LEAF)
        for name, column in (("feature", feature), ("threshold", threshold), ("left", child), ("value", mean), ("weight", weight), ("gain", gain)):
            out[name].append(column)
        going = split[node]
        rows, node = rows[going], node[going]
        right = x[rows, feature[node]] > threshold[node]
        node = 2 * (np.cumsum(split) - 1)[node] + right
        nodes = 2 * int(split.sum())
        total += nodes
        level += 1
    return {k: np.concatenate(v) for k, v in out.items()}


def descend(tree: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Values of the leaves that the rows of ``x`` end in."""
    node = np.zeros(len(x), dtype=np.int64)
    live = np.flatnonzero(tree["feature"][node] != LEAF)
    while len(live):
        at = node[live]
        feature = tree["feature"][at]
        node[live] = tree["left"][at] + (x[live, feature] > tree["threshold"][at])
        live = live[tree["feature"][node[live]] != LEAF]
    return tree["value"][node]


@dataclass
class Forest:
    """Nodes of all trees as a table, and the columns their feature numbers mean."""

    nodes: DataFrame
    features: list[str]

    def save(self, path: str) -> None:
        names = F.array(*(F.lit(f) for f in self.features))
        self.nodes.withColumn("features", F.when((F.col("tree") == 0) & (F.col("node") == 0), names)).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        table = spark.read.parquet(path)
        names = table.where("features is not null").first()["features"]
        return cls(table.drop("features"), list(names))

    def importances(self) -> DataFrame:
        """Share of each feature in the decrease of the squared error, per tree, then averaged; descending."""
        gains = self.nodes.where(F.col("feature") != LEAF).groupBy("tree", "feature").agg(F.sum("gain").alias("g"))
        total = gains.groupBy("tree").agg(F.sum("g").alias("t"))
        trees = F.lit(self.nodes.where("node = 0").count())
        share = gains.join(total, "tree").groupBy("feature").agg((F.sum(F.col("g") / F.col("t")) / trees).alias("importance"))
        names = self.nodes.sparkSession.createDataFrame(list(enumerate(self.features)), "k int, name string")
        return names.join(share, names.k == share.feature, "left").select(
            F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance")).orderBy(F.desc("importance"), "feature")

    def packed(self) -> list[dict[str, np.ndarray]]:
        """The trees as arrays (at most trees x 2 x sample rows nodes of 20 bytes)."""
        table = self.nodes.select("tree", "node", "feature", "threshold", "left", "value").toArrow()
        columns = {c: table.column(c).to_numpy() for c in table.column_names}
        order = np.lexsort([columns["node"], columns["tree"]])
        cuts = np.flatnonzero(np.diff(columns["tree"][order])) + 1
        kinds = {"feature": np.int16, "threshold": np.float64, "left": np.int32, "value": np.float64}
        split = {c: np.split(columns[c][order].astype(t), cuts) for c, t in kinds.items()}
        return [{c: split[c][k] for c in kinds} for k in range(len(cuts) + 1)]

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Mean of the trees' leaf values. The trees are broadcast; rows go through numpy in Arrow batches."""
        trees = df.sparkSession.sparkContext.broadcast(self.packed())
        names = self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in names])
                total = np.zeros(len(x))
                for tree in trees.value:
                    total += descend(tree, x)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(total / len(trees.value))], names=[*b.schema.names, output])

        return df.mapInArrow(run, T.StructType([*df.schema, T.StructField(output, T.DoubleType())]))


def sample_arrays(sample: DataFrame, features: Sequence[str], label: str) -> tuple[np.ndarray, np.ndarray]:
    """The bounded sample as (rows x columns, labels), in an order that does not depend on its partitions."""
    table = sample.select(*(F.col(c).cast("double").alias(c) for c in [*features, label])).toArrow()
    whole = np.column_stack([table.column(c).to_numpy() for c in [*features, label]]).reshape(-1, len(features) + 1)
    whole = whole[np.lexsort(whole.T)]
    return np.ascontiguousarray(whole[:, :-1]), whole[:, -1].copy()


def bootstrapped(x: np.ndarray, y: np.ndarray, seed: int, tree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A tree's own resample (as many rows as the sample, with replacement), equal rows once with their weight.
    Rows stand in sorted order, so equal ones are neighbours."""
    count = np.bincount(np.random.default_rng([seed, tree]).integers(0, len(y), len(y)), minlength=len(y))
    drawn = np.flatnonzero(count)
    x, y, w = x[drawn], y[drawn], count[drawn].astype(np.float64)
    new = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1) | (y[1:] != y[:-1])]))
    return x[new], y[new], np.add.reduceat(w, new)


def fit(sample: DataFrame, features: Sequence[str], label: str = S.TARGET, trees: int = 100, depth: int | None = None, seed: int = 42) -> Forest:
    """A forest over a sample of bounded size (no nulls), one task per tree; ``depth`` None is unbounded."""
    spark = sample.sparkSession
    x, y = sample_arrays(sample, features, label)
    if not len(y):
        raise ValueError("no rows to fit a forest on")
    data = spark.sparkContext.broadcast((x, y))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number in b.column("id").to_pylist():
                tree = grow(*bootstrapped(*data.value, seed, number), depth)
                n = len(tree["feature"])
                left = tree["left"].astype(np.int32)
                columns = [np.full(n, number, dtype=np.int32), np.arange(n, dtype=np.int32), tree["feature"].astype(np.int32), tree["threshold"],
                           left, np.where(left == LEAF, LEAF, left + 1).astype(np.int32), tree["value"], tree["weight"], tree["gain"]]
                for at in range(0, n, 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[at:at + 50_000]) for c in columns], schema=_ARROW)

    nodes, _ = stored(spark.range(0, trees, 1, trees).mapInArrow(run, NODES), "forest")
    data.unpersist()
    return Forest(nodes, list(features))
