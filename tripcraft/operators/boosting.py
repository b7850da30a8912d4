"""Second-order gradient boosting of regression trees (inventory J8) for the squared error.

Columns are cut into at most ``bins`` bins, null and NaN being a bin of their own, and rows with equal bins become one
cell (bins, rows, label sum): with the squared error a cell's gradient is rows * prediction - label sum and its
hessian is rows, so cells lose nothing, and however many rows there are, cells are at most the combinations
of bins that occur. Cells are stored once, in blocks. Columns of few bins are packed: a number stands for the bins of
several columns (`Packs`), so that sums and steps take a pass per pack.

A tree grows by levels: gradient and hessian sums per (node, column, bin), then each node's best cut by the regularised
gain, tried with the missing values on either side. Of two children only the one of fewer rows is summed over cells; the
other's sums are their parent's without it. Up to ``ONE_TASK`` cells (counted, about 200 MB) all rounds run in one
task over the cells: no step of boosting can start before the last one ends, and a Spark job costs more than the
step. Beyond that a level is a job over the cached blocks, without a shuffle where it can be: tasks add the sums over
their blocks and give one vector each (nodes x columns x bins at most, whatever the data are), which the driver adds,
after a tree of adding tasks if they have more than ``DIRECT`` numbers. A round's blocks are cached with the predictions
of the trees so far, and written to the shared folder (a checkpoint) every ``keep`` rounds. A lost executor costs its tasks
and its cached blocks, which are read again from there with the few trees since.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft import schema as S
from tripcraft.session import checkpoint_dir, stored

CELLS = 1 << 16  # cells of a stored block
HELD = 1 << 17  # cells that are worked on at once, about: their sums and steps stay in a core's cache
PACK = 1 << 12  # most bins of several columns packed together, for trees of up to 6 levels; half as many for each level more
ONE_TASK = 1 << 22  # most cells that one task boosts: there a level takes what the jobs of a level cost on some 8 cores
KEEP = 10  # rounds between two writes of the predictions
MERGERS = 4  # shuffle partitions of the small jobs
DIRECT = 1 << 22  # sums of all tasks of a level that the driver adds itself (64 MB)
BLOCK = "codes binary, n binary, s binary"
_BLOCK = pa.schema([(c, pa.binary()) for c in ("codes", "n", "s")])


class Packs:
    """Which columns share a number, the largest first into the first pack with room. A pack's code has a digit per column
    (its bin); a column of more than ``most`` bins is a pack alone."""

    def __init__(self, sizes: Sequence[int], most: int):
        self.sizes, self.inside, self.bins = [int(x) for x in sizes], [], []
        self.of, self.stride = np.zeros(len(sizes), dtype=int), np.ones(len(sizes), dtype=int)
        for f in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            b = next((b for b, x in enumerate(self.bins) if x * self.sizes[f] <= most), len(self.bins))
            if b == len(self.bins):
                self.inside.append([])
                self.bins.append(1)
            self.of[f], self.stride[f] = b, self.bins[b]
            self.inside[b].append(f)
            self.bins[b] *= self.sizes[f]
        self.starts = np.concatenate([[0], np.cumsum(self.bins)])
        self.column_starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def digits(self, f: int) -> np.ndarray:
        """Column ``f``'s bin for each code of its pack."""
        return np.arange(self.bins[self.of[f]]) // self.stride[f] % self.sizes[f]

    def codes(self, columns: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Codes of the packs for the bins of the columns."""
        return [sum(columns[f].astype(np.int32) * np.int32(self.stride[f]) for f in some) for some in self.inside]

    def by_column(self, total: np.ndarray) -> np.ndarray:
        """Sums per bin of the columns (2 x nodes x all bins of all columns) from those per code (2 x (nodes x all codes))."""
        total = total.reshape(2, -1, int(self.starts[-1]))
        out = np.empty((2, total.shape[1], int(self.column_starts[-1])))
        for b, some in enumerate(self.inside):
            part = total[:, :, self.starts[b]:self.starts[b + 1]].reshape(2, total.shape[1], *(self.sizes[f] for f in reversed(some)))
            for k, f in enumerate(reversed(some)):
                others = tuple(2 + j for j in range(len(some)) if j != k)
                out[:, :, self.column_starts[f]:self.column_starts[f + 1]] = part.sum(axis=others)
        return out


@dataclass
class Tree:
    """Arrays per node, root first; children of node k of a level stand together. ``feature`` -1 is a leaf."""

    feature: np.ndarray  # column number
    cut: np.ndarray  # bins below this number go left
    threshold: np.ndarray  # values below go left
    missing_left: np.ndarray
    left: np.ndarray
    value: np.ndarray  # leaf weight times the rate
    gain: np.ndarray

    def leaves(self, codes: np.ndarray, node: np.ndarray | None = None, way: Way | None = None) -> np.ndarray:
        """Node of each cell (``codes`` is columns x cells, or packs x cells if ``way`` has packs; bin 0 is missing). Cells start
        at ``node``, if given: where they stood when the tree had fewer levels."""
        way = way or Way(self, Packs([int(codes.max(initial=0)) + 1] * len(codes), 0))
        if node is None:
            node, levels = np.zeros(codes.shape[1], dtype=np.int32), way.height[0]
        else:
            levels = way.height[np.bincount(node, minlength=len(way.height)) > 0].max(initial=0)
        # codes of cells lie in one array; a step looks up the next node by node and code
        flat, cells_, offset = codes.reshape(-1), np.arange(codes.shape[1]), way.pack * codes.shape[1]
        for _ in range(levels):
            node = way.goes.take(node * np.int32(way.bins) + flat.take(offset.take(node) + cells_))
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Values for rows of raw values (rows x columns, NaN is missing)."""
        node = np.zeros(len(x), dtype=np.int64)
        live = np.flatnonzero(self.feature[node] >= 0)
        while len(live):
            at = node[live]
            v = x[live, self.feature[at]]
            left = np.where(np.isnan(v), self.missing_left[at], v < self.threshold[at])
            node[live] = self.left[at] + ~left
            live = live[self.feature[node[live]] >= 0]
        return self.value[node]


class Way:
    """A tree's steps for codes of packs: the next node by node and code (leaves stay), the pack that a node looks at and the
    levels below it."""

    def __init__(self, tree: Tree, packs: Packs):
        nodes, self.bins = len(tree.feature), max(packs.bins)
        goes = np.repeat(np.arange(nodes, dtype=np.int32), self.bins).reshape(nodes, self.bins)
        self.height, self.pack = np.zeros(nodes, dtype=int), np.zeros(nodes, dtype=int)
        for k in np.flatnonzero(tree.feature >= 0)[::-1]:
            f, left = tree.feature[k], tree.left[k]
            right = np.arange(packs.sizes[f]) > tree.cut[k]
            right[0] = not tree.missing_left[k]
            digits = packs.digits(f)
            goes[k, :len(digits)] = left + right.take(digits)
            self.height[k], self.pack[k] = 1 + self.height[left:left + 2].max(), packs.of[f]
        self.goes = goes.reshape(-1)


def stub() -> Tree:
    one = np.zeros(1)
    return Tree(np.full(1, -1), np.zeros(1, int), one + np.nan, np.zeros(1, bool), np.full(1, -1), one.copy(), one.copy())


@dataclass
class Boosted:
    base: float
    trees: list[Tree]
    features: list[str]

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Base value plus the trees' values; rows go through numpy in Arrow batches (trees x 2^(depth+1) nodes broadcast)."""
        model = df.sparkSession.sparkContext.broadcast((self.base, self.trees))
        names = self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            base, trees = model.value
            for b in batches:
                x = np.column_stack([raw(b.column(c)) for c in names])
                total = np.full(len(x), base)
                for tree in trees:
                    total += tree.predict(x)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(total)], names=[*b.schema.names, output])

        return df.mapInArrow(run, T.StructType([*df.schema, T.StructField(output, T.DoubleType())]))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row per node: tree, node, feature (null in leaves), threshold, missing_left, left, right, value, gain."""
        rows = [(t, k, self.features[f] if f >= 0 else None, float(tree.threshold[k]) if f >= 0 else None, bool(tree.missing_left[k]),
                 int(tree.left[k]), int(tree.left[k]) + 1 if f >= 0 else -1, float(tree.value[k]), float(tree.gain[k]))
                for t, tree in enumerate(self.trees) for k, f in enumerate(tree.feature.tolist())]
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, missing_left boolean, left int, right int, "
                                           "value double, gain double")


def raw(column: pa.Array) -> np.ndarray:
    """Doubles of an Arrow column, null as NaN."""
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)


def cut_points(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Per column the ascending values at which bins begin: each value of a column of few values, else quantiles."""
    probs = [k / bins for k in range(1, bins)]
    wide = df.select(*(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in features))
    few = wide.agg(*(F.approx_count_distinct(c).alias(c) for c in features)).first()
    short = [c for c in features if few[c] <= bins // 2]  # the count is approximate; the set below is exact
    found = wide.agg(*(F.array_sort(F.collect_set(c)).alias(c) for c in short)).first() if short else {}
    long = [c for c in features if c not in short]
    spread = dict(zip(long, wide.approxQuantile(long, probs, 1 / (8 * bins)), strict=True)) if long else {}
    out = []
    for c in features:
        values = np.unique(np.array(found[c] if c in short else spread[c], dtype=np.float64))
        # a bin begins halfway between neighbours, so that a cut is not at a value itself
        out.append((values[1:] + values[:-1]) / 2)
    return out


def cells(df: DataFrame, features: Sequence[str], label: str, cuts: list[np.ndarray], packs: Packs) -> DataFrame:
    """Stored blocks of cells: codes (packs x cells, 16 bits), rows and label sums."""
    columns, names = [f"c{k}" for k in range(len(features))], [f"p{k}" for k in range(len(packs.bins))]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = []
            for k, c in enumerate(cuts):
                x = raw(b.column(k))
                bins.append(np.where(np.isnan(x), 0, np.searchsorted(c, x, side="right") + 1) if len(c) else np.zeros(len(x), int))
            yield pa.RecordBatch.from_arrays([*map(pa.array, packs.codes(bins)), b.column(len(cuts))], names=[*names, "y"])

    rows = df.select(*(F.col(c).cast("double").alias(n) for c, n in zip(features, columns, strict=True)), F.col(label).cast("double").alias("y"))
    each = rows.where("y is not null").mapInArrow(binned, ", ".join(f"{n} int" for n in names) + ", y double").groupBy(*names).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("s"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, CELLS):
                part = b.slice(at, CELLS)
                codes = b"".join(part.column(k).to_numpy().astype("<u2").tobytes() for k in range(len(names)))
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (
                    codes, part.column("n").to_numpy().tobytes(), part.column("s").to_numpy().tobytes())], schema=_BLOCK)

    # at least a block per core; one job per level follows, so these read the blocks without adaptive planning
    spread = each.repartition(df.sparkSession.sparkContext.defaultParallelism) if fewer_tasks(each) else each
    return planned_once(stored(spread.mapInArrow(blocks, BLOCK), "boost-cells")[0])


def fewer_tasks(each: DataFrame) -> bool:
    """Whether the shuffle partitions would leave cores without cells."""
    spark = each.sparkSession
    return spark.conf.get("spark.sql.adaptive.enabled") == "true" or \
        int(spark.conf.get("spark.sql.shuffle.partitions")) < spark.sparkContext.defaultParallelism


def planned_once(table: DataFrame) -> DataFrame:
    """The stored table in a session of its own, whose small jobs are not planned anew between their stages."""
    session = table.sparkSession.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", str(MERGERS))
    return session.read.schema(table.schema).parquet(*table.inputFiles())


def unpacked(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.frombuffer(block["n"])
    return np.frombuffer(block["codes"], "<u2").reshape(-1, len(n)), n, np.frombuffer(block["s"])


def gathered(blocks: Iterable[dict]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Codes, rows and label sums of the blocks, joined to about ``HELD`` cells."""
    some, size = [], 0
    for block in blocks:
        some.append(unpacked(block))
        size += len(some[-1][1])
        if size >= HELD:
            yield tuple(np.concatenate(x, axis=-1) for x in zip(*some, strict=True))
            some, size = [], 0
    if some:
        yield tuple(np.concatenate(x, axis=-1) for x in zip(*some, strict=True))


def add_sums(total: np.ndarray, codes: np.ndarray, n: np.ndarray, s: np.ndarray, p: np.ndarray, at: np.ndarray, starts: np.ndarray) -> None:
    """Add the cells' gradients and hessians to ``total`` (2 x (open nodes x all codes)); ``at`` is a cell's open node or -1."""
    inside = np.flatnonzero(at >= 0)
    if len(inside) < len(at):
        codes, n, s, p, at = [c.take(inside) for c in codes], n.take(inside), s.take(inside), p.take(inside), at.take(inside)
    g, sums = n * p - s, total.reshape(2, -1, int(starts[-1]))
    for f in range(len(starts) - 1):
        bins = int(starts[f + 1] - starts[f])
        key = at * bins + codes[f]
        for k, x in enumerate((g, n)):
            sums[k, :, starts[f]:starts[f + 1]] += np.bincount(key, x, sums.shape[1] * bins).reshape(-1, bins)


def places(tree: Tree, open_: np.ndarray) -> np.ndarray:
    """Number of each node among the open ones, or -1."""
    place = np.full(len(tree.feature), -1)
    place[open_] = np.arange(len(open_))
    return place


def cached(blocks: DataFrame, base: float) -> RDD:
    """Cached blocks (codes, rows, label sums, predictions): a level's job is short, and reading them anew would outlast it."""
    def run(part: Iterator[Row]) -> Iterator[tuple[np.ndarray, ...]]:
        for codes, n, s in gathered(block.asDict() for block in part):
            yield codes, n.astype(np.min_scalar_type(int(n.max()))), s, np.full(len(n), base)

    return blocks.rdd.mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK)


def applied(blocks: RDD, tree: Tree, packs: Packs) -> RDD:
    """Cached blocks with the tree's values added to the predictions."""
    def run(part: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
        way = Way(tree, packs)
        for codes, n, s, p in part:
            yield codes, n, s, p + tree.value.take(tree.leaves(codes, way=way))

    return blocks.mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK)


def level_job(blocks: RDD, tree: Tree, open_: np.ndarray, packs: Packs) -> np.ndarray:
    """The sums of a level (2 x open nodes x all bins of all columns) by one Spark job."""
    place, size = places(tree, open_), len(open_) * int(packs.column_starts[-1])

    def run(part: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        way, total = Way(tree, packs), np.zeros((2, len(open_) * int(packs.starts[-1])))
        for codes, n, s, p in part:
            add_sums(total, codes, n.astype(np.float64), s, p, place.take(tree.leaves(codes, way=way)), packs.starts)
        found = packs.by_column(total).reshape(2, size)
        hit = np.flatnonzero(found[1])
        if len(hit):
            yield hit, found[:, hit]

    out = np.zeros((2, size))
    sums = blocks.mapPartitions(run)
    if blocks.getNumPartitions() * size > DIRECT:
        def dense(part: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
            total = np.zeros((2, size))
            for hit, values in part:
                total[:, hit] += values
            yield total

        out += sums.mapPartitions(dense).treeReduce(np.add)
    else:
        for hit, values in sums.collect():
            out[:, hit] += values
    return out.reshape(2, len(open_), -1)


def best_cuts(g: np.ndarray, h: np.ndarray, starts: np.ndarray, penalty: float, least: float) -> dict[str, np.ndarray]:
    """Per node (rows of the sums ``g`` and ``h``): gain, column (-1 if no cut gains), cut, missing left, and the left child's
    sums. Of equal gains the first column, missing values to the right, and the lowest cut win."""
    nodes = len(g)
    rows = np.arange(nodes)
    best = {"gain": np.zeros(nodes), "feature": np.full(nodes, -1), "cut": np.zeros(nodes, int), "missing_left": np.zeros(nodes, bool),
            "g": np.zeros(nodes), "h": np.zeros(nodes)}
    for f in range(len(starts) - 1):
        gs, hs = g[:, starts[f]:starts[f + 1]], h[:, starts[f]:starts[f + 1]]
        if gs.shape[1] < 3:  # no cut: a missing bin and one other
            continue
        whole_g, whole_h = gs.sum(axis=1, keepdims=True), hs.sum(axis=1, keepdims=True)
        left_g, left_h = np.cumsum(gs[:, 1:], axis=1)[:, :-1], np.cumsum(hs[:, 1:], axis=1)[:, :-1]
        for missing_left in (False, True):
            if missing_left and not hs[:, 0].any():
                continue
            lg, lh = left_g + gs[:, :1] * missing_left, left_h + hs[:, :1] * missing_left
            rg, rh = whole_g - lg, whole_h - lh
            fine = (lh >= least) & (rh >= least)
            if missing_left:
                fine &= hs[:, :1] > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = lg ** 2 / (lh + penalty) + rg ** 2 / (rh + penalty) - whole_g ** 2 / (whole_h + penalty)
            gain = np.where(fine, gain / 2, 0)
            k = gain.argmax(axis=1)
            top = gain[rows, k]
            better = top > best["gain"] * (1 + 1e-12) + 1e-9
            for name, value in (("gain", top), ("feature", np.full(nodes, f)), ("cut", k + 1), ("missing_left", np.full(nodes, missing_left)),
                                ("g", lg[rows, k]), ("h", lh[rows, k])):
                best[name] = np.where(better, value, best[name])
    return best


def grow(sums: Callable[[Tree, np.ndarray], np.ndarray], cuts: list[np.ndarray], starts: np.ndarray, depth: int, rate: float,
         penalty: float, least: float) -> Tree:
    """One tree; ``sums`` gives the gradient and hessian sums of the given open nodes of an unfinished tree."""
    tree = stub()
    open_ = np.zeros(1, dtype=int)
    for level in range(depth):
        if level == 0:
            g, h = sums(tree, open_)
        else:  # a child of every two, and what its parent has besides
            both = np.empty((2, len(open_), int(starts[-1])))
            rows = np.arange(0, len(open_), 2)
            both[:, rows + fewer] = sums(tree, open_[rows + fewer])
            both[:, rows + 1 - fewer] = np.stack([g, h])[:, split] - both[:, rows + fewer]
            g, h = both
            g[h == 0] = 0.0  # without what rounding leaves in bins without rows
        whole_g, whole_h = g[:, :starts[1]].sum(axis=1), h[:, :starts[1]].sum(axis=1)
        if level == 0:  # the root's value, should it stay a leaf
            tree.value[0] = -rate * whole_g[0] / (whole_h[0] + penalty)
        best = best_cuts(g, h, starts, penalty, least)
        split = best["feature"] >= 0
        m = 2 * int(split.sum())
        if not m:
            break
        at = open_[split]
        feature, cut, lg, lh = (best[c][split] for c in ("feature", "cut", "g", "h"))
        tree.feature[at], tree.cut[at], tree.missing_left[at], tree.gain[at] = feature, cut, best["missing_left"][split], best["gain"][split]
        tree.threshold[at] = [cuts[f][c - 1] for f, c in zip(feature, cut, strict=True)]
        tree.left[at] = len(tree.feature) + np.arange(0, m, 2)
        fewer = (whole_h[split] < 2 * lh).astype(int)
        weights = np.column_stack([-rate * lg / (lh + penalty), -rate * (whole_g[split] - lg) / (whole_h[split] - lh + penalty)]).reshape(-1)
        open_ = np.arange(len(tree.feature), len(tree.feature) + m)
        blank = np.zeros(m)
        tree = Tree(np.append(tree.feature, np.full(m, -1)), np.append(tree.cut, np.zeros(m, int)), np.append(tree.threshold, blank + np.nan),
                    np.append(tree.missing_left, np.zeros(m, bool)), np.append(tree.left, np.full(m, -1)), np.append(tree.value, weights),
                    np.append(tree.gain, blank))
    return tree


def boosted_in_task(blocks: Iterable[dict], base: float, cuts: list[np.ndarray], packs: Packs, rounds: int, **settings) -> Iterator[Tree]:
    """All rounds over cells in memory."""
    parts = [(codes, n, s, np.full(len(n), float(base))) for codes, n, s in gathered(blocks)]
    for _ in range(rounds):
        nodes = [np.zeros(len(n), dtype=np.int32) for _, n, _, _ in parts]  # where the cells stand in the unfinished tree

        def sums(tree: Tree, open_: np.ndarray) -> np.ndarray:
            way, place, total = Way(tree, packs), places(tree, open_), np.zeros((2, len(open_) * int(packs.starts[-1])))
            for k, (codes, n, s, p) in enumerate(parts):
                nodes[k] = tree.leaves(codes, nodes[k], way)  # noqa: B023
                add_sums(total, codes, n, s, p, place.take(nodes[k]), packs.starts)  # noqa: B023
            return packs.by_column(total)

        tree = grow(sums, cuts, packs.column_starts, **settings)
        way = Way(tree, packs)
        for node, (codes, _, _, p) in zip(nodes, parts, strict=True):
            p += tree.value.take(tree.leaves(codes, node, way))
        yield tree


def fit(train: DataFrame, features: Sequence[str], label: str = S.TARGET, rounds: int = 200, depth: int = 6, rate: float = 0.1,
        penalty: float = 1.0, least: float = 1.0, bins: int = 256, keep: int = KEEP, one_task: int = ONE_TASK) -> Boosted:
    """``rounds`` trees of at most ``depth`` levels. ``penalty`` is the L2 term of leaf weights, ``least`` the smallest
    hessian sum of a child. Rows without a label are left out; missing features go to the side that gains more."""
    cuts = cut_points(train.where(F.col(label).isNotNull()), features, bins)
    sizes = [len(c) + 2 if len(c) else 1 for c in cuts]  # the missing bin, and one more bin than cuts
    packs = Packs(sizes, PACK >> max(0, depth - 6))
    blocks = cells(train, features, label, cuts, packs)
    sums = blocks.mapInArrow(_totals, "cells long, n double, s double").agg(*(F.sum(c).alias(c) for c in ("cells", "n", "s"))).first()
    if not sums["n"]:
        raise ValueError("no rows to fit boosted trees on")
    base = sums["s"] / sums["n"]
    settings = {"depth": depth, "rate": rate, "penalty": penalty, "least": least}
    if sums["cells"] <= one_task:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = (block for b in batches for block in b.to_pylist())
            for k, tree in enumerate(boosted_in_task(held, base, cuts, packs, rounds, **settings)):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([pickle.dumps(tree)], pa.binary())], names=["k", "tree"])

        found = blocks.repartition(1).mapInArrow(run, "k long, tree binary").collect()
        trees = [pickle.loads(r["tree"]) for r in sorted(found, key=lambda r: r["k"])]
        return Boosted(float(base), trees, list(features))
    checkpoint_dir(train.sparkSession)
    trees: list[Tree] = []
    now, before = cached(blocks, base), None
    for k in range(rounds):
        if k:
            now, before = applied(now, trees[-1], packs), now
            if k % keep == 0:
                now.checkpoint()  # written by the job of the first level
        trees.append(grow(lambda tree, open_: level_job(now, tree, open_, packs), cuts, packs.column_starts, **settings))  # noqa: B023
        if before is not None:
            before.unpersist()
    now.unpersist()
    return Boosted(float(base), trees, list(features))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for block in b.to_pylist():
            _, n, s = unpacked(block)
            yield pa.RecordBatch.from_arrays([pa.array([len(n)]), pa.array([n.sum()]), pa.array([s.sum()])], names=["cells", "n", "s"])
