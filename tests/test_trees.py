"""Forest and boosted trees against brute force and SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripcraft.operators import boosting, forest


def brute_tree(x, y, w):
    """Plain recursive CART: {(): value} or (feature, threshold, left, right)."""
    if len(set(y.tolist())) == 1 or (x == x[0]).all():
        return float(np.average(y, weights=w))
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for low, high in zip(values[:-1], values[1:], strict=True):
            t = (low + high) / 2
            left = x[:, f] <= t
            error = sum((w[m] * (y[m] - np.average(y[m], weights=w[m])) ** 2).sum() for m in (left, ~left))
            if best is None or error < best[0] - 1e-6:
                best = (error, f, t)
    whole = (w * (y - np.average(y, weights=w)) ** 2).sum()
    if whole - best[0] <= 1e-6:
        return float(np.average(y, weights=w))
    _, f, t = best
    left = x[:, f] <= t
    return f, t, brute_tree(x[left], y[left], w[left]), brute_tree(x[~left], y[~left], w[~left])


def nested(tree, k=0):
    if tree["feature"][k] < 0:
        return float(tree["value"][k])
    left = int(tree["left"][k])
    return int(tree["feature"][k]), float(tree["threshold"][k]), nested(tree, left), nested(tree, left + 1)


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return isinstance(a, float) and isinstance(b, float) and abs(a - b) < 1e-9
    return a[0] == b[0] and abs(a[1] - b[1]) < 1e-12 and same(a[2], b[2]) and same(a[3], b[3])


@pytest.mark.parametrize("seed", range(8))
def test_tree_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 4, 60), rng.integers(0, 12, 60) / 3, rng.normal(size=60).round(1)]).astype(float)
    y, w = rng.integers(0, 1000, 60).astype(float), rng.integers(1, 4, 60).astype(float)
    tree = forest.grow(x, y, w)
    assert same(nested(tree), brute_tree(x, y, w))
    inner = tree["feature"] >= 0
    left = tree["left"][inner]
    assert np.allclose(tree["weight"][left] + tree["weight"][left + 1], tree["weight"][inner])


def test_tree_edges():
    one = forest.grow(np.zeros((3, 2)), np.array([1.0, 2.0, 3.0]), np.ones(3))
    assert one["feature"].tolist() == [-1] and one["value"].tolist() == [2.0]
    pure = forest.grow(np.arange(6.0).reshape(3, 2), np.full(3, 7.0), np.ones(3))
    assert pure["feature"].tolist() == [-1]
    stump = forest.grow(np.arange(8.0)[:, None], np.arange(8.0), np.ones(8), depth=1)
    assert len(stump["feature"]) == 3 and stump["threshold"][0] == 3.5


def test_forest_on_spark(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b), float(c), float(100 * a + (b > 5) * 30 + rng.integers(0, 3)))
            for a, b, c in zip(rng.integers(0, 9, 400), rng.integers(0, 11, 400), rng.normal(size=400), strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    model = forest.fit(df.repartition(3), ["a", "b", "c"], "y", trees=6, seed=3)
    again = forest.fit(df.repartition(5), ["a", "b", "c"], "y", trees=6, seed=3)
    assert sorted(map(str, model.nodes.collect())) == sorted(map(str, again.nodes.collect()))
    shares = {r.feature: r.importance for r in model.importances().collect()}
    assert abs(sum(shares.values()) - 1) < 1e-9 and shares["a"] > shares["b"] > shares["c"]
    # every tree equals brute force on its own resample
    x, y = forest.sample_arrays(df, ["a", "b", "c"], "y")
    packed = model.packed()
    for k, tree in enumerate(packed):
        assert same(nested(tree), brute_tree(*forest.bootstrapped(x, y, 3, k)))
    got = {tuple(r)[:3]: r.prediction for r in model.predict(df).collect()}
    for r in rows[:20]:
        assert abs(got[r[:3]] - np.mean([forest.descend(t, np.array([r[:3]]))[0] for t in packed])) < 1e-9
    model.save(str(tmp_path / "forest"))
    loaded = forest.Forest.load(spark, str(tmp_path / "forest"))
    assert loaded.features == ["a", "b", "c"] and loaded.nodes.count() == model.nodes.count()
    with pytest.raises(ValueError, match="no rows"):
        forest.fit(df.limit(0), ["a", "b", "c"], "y", trees=1)


def sample_rows(seed=4, n=300):
    rng = np.random.default_rng(seed)
    return [(None if rng.random() < 0.1 else float(a), None if rng.random() < 0.2 else float(b), float(a * 7 + (b % 3) * 11 + rng.integers(0, 5)))
            for a, b in zip(rng.integers(0, 9, n), rng.integers(0, 13, n), strict=True)]


@pytest.mark.parametrize("one_task", [0, 1 << 20])
def test_first_cut_equals_sql(spark, one_task):
    """Gradient and hessian sums, both sides for the missing values, regularised gain and leaf weights: in SQL."""
    rows = sample_rows()
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(4)
    model = boosting.fit(df, ["a", "b"], "y", rounds=1, depth=1, rate=0.3, penalty=1.0, one_task=one_task)
    con = duckdb.connect()
    con.execute("create table t (a double, b double, y double)")
    con.executemany("insert into t values (?, ?, ?)", rows)
    best = con.execute("""
with g as (select *, (select avg(y) from t) - y as g from t),
x as (select 'a' as f, a as x, g from g union all select 'b', b, g from g),
c as (select f, x, lead(x) over (partition by f order by x) as up from (select distinct f, x from x where x is not null)),
s as (select c.f, (c.x + c.up) / 2 as t, m.side,
        sum(case when x.x <= c.x or (x.x is null and m.side) then x.g else 0 end) as lg,
        count(case when x.x <= c.x or (x.x is null and m.side) then 1 end) as lh, sum(x.g) as wg, count(*) as wh
      from c join x on x.f = c.f, (values (false), (true)) m(side) where c.up is not null group by all)
select f, t, side, (lg * lg / (lh + 1) + (wg - lg) * (wg - lg) / (wh - lh + 1) - wg * wg / (wh + 1)) / 2 as gain,
       -0.3 * lg / (lh + 1) as l, -0.3 * (wg - lg) / (wh - lh + 1) as r from s order by gain desc limit 1""").fetchone()
    root, left, right = model.nodes(spark).orderBy("node").collect()
    assert (root.feature, root.threshold, root.missing_left) == best[:3]
    assert np.allclose([root.gain, left.value, right.value], best[3:])
    assert abs(model.base - np.mean([r[2] for r in rows])) < 1e-9


def plain_boosting(rows, rounds, depth, rate):
    """Row by row, without cells, histograms or blocks: predictions of the training rows."""
    x = np.array([[np.nan if v is None else v for v in r[:2]] for r in rows])
    y = np.array([r[2] for r in rows])
    p = np.full(len(y), y.mean())
    for _ in range(rounds):
        g, step = p - y, np.zeros(len(y))

        def cut(at, level, g=g, step=step):
            score = lambda m: g[m].sum() ** 2 / (m.sum() + 1)
            step[at] = -rate * g[at].sum() / (at.sum() + 1)
            best = (1e-9, None)
            for f in range(2) if level < depth else ():
                values = np.unique(x[~np.isnan(x[:, f]), f])
                for t in (values[1:] + values[:-1]) / 2:
                    for side in (False, True):
                        left = at & np.where(np.isnan(x[:, f]), side, x[:, f] < t)
                        if left.sum() and (at & ~left).sum():
                            gain = (score(left) + score(at & ~left) - score(at)) / 2
                            if gain > best[0] * (1 + 1e-12) + 1e-9:
                                best = (gain, left)
            if best[1] is not None:
                cut(best[1], level + 1)
                cut(at & ~best[1], level + 1)

        cut(np.ones(len(y), dtype=bool), 0)
        p = p + step
    return p


@pytest.mark.parametrize(("keep", "one_task"), [(2, 0), (10, 0), (10, 1 << 20)])
def test_rounds_equal_plain_boosting(spark, monkeypatch, keep, one_task):
    """Several rounds over several blocks, by jobs with stored predictions and in one task, missing values on both sides."""
    monkeypatch.setattr(boosting, "CELLS", 16)
    rows = sample_rows(5, 120)
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a double, b double, y double")
    model = boosting.fit(df.repartition(4), ["a", "b"], "y", rounds=5, depth=3, rate=0.3, keep=keep, one_task=one_task)
    got = [r.prediction for r in model.predict(df).orderBy("k").collect()]
    assert np.allclose(got, plain_boosting(rows, 5, 3, 0.3), atol=1e-6)


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(5000).select((F.col("id") / 7).alias("x"), F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 3).alias("z"))
    long, short = boosting.cut_points(df, ["x", "z"], 32)
    assert 28 <= len(long) <= 31 and np.allclose(np.diff(long), 5000 / 7 / 32, rtol=0.2) and short.tolist() == [0.5, 1.5]


def test_boosting_edges(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0), (None, 3.0), (2.0, None)], "x double, y double")
    assert [t.feature.tolist() for t in boosting.fit(df.limit(2), ["x"], "y", rounds=2).trees] == [[-1], [-1]]
    got = boosting.fit(df, ["x"], "y", rounds=1).predict(df).collect()
    assert len(got) == 4 and all(np.isfinite(r.prediction) for r in got)
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(df.limit(0), ["x"], "y", rounds=1)


def test_registered_sizes():
    from tripcraft.plans import q_models as Q
    assert (Q.FOREST_TREES, Q.FOREST_DEPTH, Q.BOOST_ROUNDS, Q.PRUNING_ROUNDS) == (100, None, 200, 200)


@pytest.mark.parametrize("direct", [0, 1 << 22])
def test_level_sums_are_added_by_the_driver_or_by_tasks(spark, monkeypatch, direct):
    monkeypatch.setattr(boosting, "CELLS", 16)
    monkeypatch.setattr(boosting, "DIRECT", direct)
    rows = sample_rows(6, 120)
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a double, b double, y double").repartition(4)
    model = boosting.fit(df, ["a", "b"], "y", rounds=4, depth=3, rate=0.3, keep=2, one_task=0)
    assert np.allclose([r.prediction for r in model.predict(df).orderBy("k").collect()], plain_boosting(rows, 4, 3, 0.3), atol=1e-6)


def test_cells_go_on_from_where_they_stand(spark):
    """Leaves found from the nodes of an earlier level are those found from the root."""
    codes = np.random.default_rng(2).integers(0, 5, size=(2, 400)).astype("<u2")
    n, s = np.ones(400), codes[0] * 3.0 + (codes[1] == 2) * 5 - codes[1]
    cuts = [np.arange(3) + 0.5] * 2
    starts = np.array([0, 5, 10])
    node, trees = np.zeros(400, dtype=np.int32), []

    def sums(tree, open_):
        nonlocal node
        node = tree.leaves(codes, node)
        assert np.array_equal(node, tree.leaves(codes))
        total = np.zeros((2, len(open_) * 10))
        boosting.add_sums(total, codes, n, s, np.zeros(400), boosting.places(tree, open_)[node], starts)
        return total.reshape(2, len(open_), 10)

    trees.append(boosting.grow(sums, cuts, starts, 3, 0.1, 1.0, 1.0))
    assert (trees[0].feature >= 0).sum() >= 3 and np.array_equal(trees[0].leaves(codes, node), trees[0].leaves(codes))
    assert boosting.stub().leaves(codes[:, :0]).shape == (0,)


@pytest.mark.parametrize("most", [0, 30, 4096])
def test_packed_columns_give_the_sums_and_steps_of_columns(most):
    rng = np.random.default_rng(8)
    sizes = [3, 5, 1, 9, 4, 4]
    codes = np.stack([rng.integers(0, z, 500) for z in sizes])
    packs = boosting.Packs(sizes, most)
    assert len(packs.bins) == {0: 6, 30: 3, 4096: 1}[most] and all(x <= max(most, 9) for x in packs.bins)
    packed = np.stack(packs.codes(codes)).astype("<u2")
    n, s, at = rng.integers(1, 4, 500).astype(float), rng.normal(size=500), rng.integers(-1, 3, 500)
    total = np.zeros((2, 3 * int(packs.starts[-1])))
    boosting.add_sums(total, packed, n, s, np.ones(500), at, packs.starts)
    got = packs.by_column(total)
    for k, x in enumerate((n - s, n)):
        want = [[x[(at == a) & (codes[f] == v)].sum() for f in range(6) for v in range(sizes[f])] for a in range(3)]
        assert np.allclose(got[k], want)
    tree = boosting.Tree(np.array([3, 1, -1, -1, 4, -1, -1]), np.array([6, 2, 0, 0, 1, 0, 0]), np.zeros(7), np.array([0, 1, 0, 0, 1, 0, 0], bool),
                         np.array([1, 3, -1, -1, 5, -1, -1]), np.zeros(7), np.zeros(7))
    want = [2 if not 0 < c[3] <= 6 else 3 if c[1] <= 2 else 5 if c[4] <= 1 else 6 for c in codes.T]
    assert tree.leaves(codes).tolist() == tree.leaves(packed, way=boosting.Way(tree, packs)).tolist() == want


def test_one_child_of_two_is_summed():
    """Below the root cells are added for the child of fewer rows only, and trees are those of sums of all nodes."""
    rng = np.random.default_rng(9)
    codes = rng.integers(0, 6, size=(3, 900)).astype("<u2")
    n, s = rng.integers(1, 4, 900).astype(float), rng.normal(size=900) + codes[0] * codes[1]
    cuts, starts = [np.arange(4) + 0.5] * 3, np.array([0, 6, 12, 18])
    asked = []

    def sums(tree, open_):
        place = boosting.places(tree, open_)[tree.leaves(codes)]
        total = np.zeros((2, len(open_) * 18))
        boosting.add_sums(total, codes, n, s, np.zeros(900), place, starts)
        asked.append(n[place >= 0].sum() / n.sum())
        return total.reshape(2, len(open_), 18)

    tree = boosting.grow(sums, cuts, starts, 4, 0.1, 1.0, 1.0)
    assert asked[0] == 1 and len(asked) == 4 and max(asked[1:]) <= 0.5
    node, value = tree.leaves(codes), tree.value.copy()
    for k in np.unique(node):
        assert np.isclose(value[k], 0.1 * s[node == k].sum() / (n[node == k].sum() + 1))


def test_learners_of_the_comparison_run_at_the_same_time(spark):
    from threading import Barrier

    from tripcraft import schema as S
    from tripcraft.operators import ml as M
    together = Barrier(4, timeout=60)

    def learner(shift):
        def run(train, test, features):
            together.wait()
            return test.withColumn("prediction", F.lit(10.0 + shift) + F.lit(train.count()))
        return run

    rows = spark.range(6).select(*(F.when(F.col("id") == k, None).otherwise(F.lit(1.0)).alias(c) for k, c in enumerate(S.FULL_FEATURES)),
                                 F.col("id").cast("double").alias(S.TARGET))
    got = M.pruning_comparison(rows, rows.where(f"{S.TARGET} < 5"), {"a": learner(0), "b": learner(1)}).collect()
    y = [k for k in range(6) if S.FULL_FEATURES[k] not in S.REDUCED_FEATURES]  # rows without nulls in the reduced list
    assert [r.model for r in got] == ["a_full", "b_full", "a_reduced", "b_reduced"]
    assert [r.n for r in got] == [0, 0, sum(v < 5 for v in y), sum(v < 5 for v in y)]
    assert [r.mae for r in got[2:]] == [round(float(np.mean([10 + x + len(y) - v for v in y if v < 5])), 6) for x in (0, 1)]


def test_jobs_equal_the_one_task(spark, monkeypatch):
    """Thirteen columns, packed; blocks of several elements, predictions checkpointed between; the same trees either way."""
    monkeypatch.setattr(boosting, "CELLS", 32)
    monkeypatch.setattr(boosting, "HELD", 64)
    rng = np.random.default_rng(11)
    names = [f"x{k}" for k in range(13)]
    x = np.column_stack([rng.integers(0, z, 600) for z in (4, 7, 40, 6, 1, 2, 24, 7, 12, 2, 2, 2, 6)]).astype(float)
    y = x[:, 2] * 45 + x[:, 6] * (x[:, 0] > 1) + rng.integers(0, 90, 600)
    rows = [(*(None if rng.random() < 0.05 else float(v) for v in r), float(t)) for r, t in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", y double").repartition(3)
    one, jobs = (boosting.fit(df, names, "y", rounds=5, depth=4, keep=2, one_task=t) for t in (1 << 20, 0))
    for a, b in zip(one.trees, jobs.trees, strict=True):
        assert a.feature.tolist() == b.feature.tolist() and a.cut.tolist() == b.cut.tolist() and np.allclose(a.value, b.value)
