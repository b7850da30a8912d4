"""Exploration operators against brute-force numpy on small frames, plus edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripcraft.operators import explore as E


@pytest.fixture(scope="module")
def xy(spark):
    rng = np.random.default_rng(7)
    x = rng.gamma(2.0, 3.0, 3000)
    y = 2.5 * x + rng.normal(0, 4, 3000)
    g = rng.integers(0, 3, 3000)
    pdf = [(float(a), float(b), int(c)) for a, b, c in zip(x, y, g)]
    return spark.createDataFrame(pdf, "x double, y double, g int"), x, y, g


def test_histogram_matches_numpy(xy):
    df, x, _, _ = xy
    h = E.histogram(df, "x", 40).collect()
    counts, edges = np.histogram(x, bins=40)
    assert [r["count"] for r in h] == counts.tolist()
    assert abs(h[0].bin_lo - edges[0]) < 1e-6 and abs(h[-1].bin_hi - edges[-1]) < 1e-6


def test_histogram_density_and_groups(xy):
    df, x, _, g = xy
    h = E.histogram(df, "x", 25, by="g", density=True).collect()
    for k in range(3):
        rows = [r for r in h if r.g == k]
        dens, _ = np.histogram(x[g == k], bins=25, density=True)
        assert np.allclose([r.density for r in rows], dens, rtol=0, atol=1e-9)
        assert sum(r["count"] for r in rows) == int((g == k).sum())


def test_histogram_min_equals_max_and_empty(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    h = E.histogram(df, "x", 10).collect()
    assert len(h) == 10 and sum(r["count"] for r in h) == 2
    assert abs(h[0].bin_lo - 4.5) < 1e-9 and abs(h[-1].bin_hi - 5.5) < 1e-9
    empty = spark.createDataFrame([], "x double")
    e = E.histogram(empty, "x", 10).collect()
    assert len(e) == 10 and sum(r["count"] for r in e) == 0 and e[0].bin_lo == 0.0 and e[-1].bin_hi == 1.0


@pytest.mark.parametrize("method", ["moments", "exact"])
def test_kde_matches_bruteforce(xy, method):
    df, x, _, _ = xy
    k = E.kde(df, "x", grid=50, method=method).collect()
    bw = x.std(ddof=1) * len(x) ** (-0.2)
    grid = np.linspace(x.min(), x.max(), 50)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / bw) ** 2).sum(axis=1) / (len(x) * bw * math.sqrt(2 * math.pi))
    assert np.allclose([r.density for r in k], dens, atol=1e-8)


def test_kde_edges(spark):
    """Far outliers (cells without a term in reach), a constant column and an empty one."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=300), [1e4, -3e3]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    a, b = ([r.density for r in E.kde(df, "x", grid=80, method=m).collect()] for m in ("moments", "exact"))
    assert len(a) == 80 and np.allclose(a, b, rtol=0, atol=1e-9)
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert all(r.density is None for r in E.kde(same, "x", grid=5).collect())
    assert [r.density for r in E.kde(df.limit(0), "x", grid=5).collect()] == []


def test_correlation_large_offsets_and_nulls(spark):
    """A mean far above the spread, NaN and null as missing, a pair without a complete row, an empty table."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=500)
    rows = [(1e9 + float(v), float(2 * v + rng.normal()), None if k % 3 else float(v), float("nan") if k % 3 == 0 else 1.0 * k)
            for k, v in enumerate(a)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    r = {(x.x, x.y): x.r for x in E.correlation(df.repartition(3), ["a", "b", "c", "d"]).collect()}
    cols = [np.array([np.nan if v is None else v for v in c]) for c in zip(*rows, strict=True)]
    for (x, i), (y, j) in [(("b", 1), ("a", 0)), (("c", 2), ("a", 0)), (("c", 2), ("b", 1)), (("d", 3), ("b", 1))]:
        both = ~np.isnan(cols[i]) & ~np.isnan(cols[j])
        assert abs(r[(x, y)] - np.corrcoef(cols[i][both], cols[j][both])[0, 1]) < 2e-6
    assert r[("d", "c")] is None
    assert [x.r for x in E.correlation(df.limit(0), ["a", "b"]).collect()] == [None]


def hexbin_bruteforce(x, y, gridsize=60):
    nx, ny = gridsize, int(gridsize / math.sqrt(3))
    xmin, xmax, ymin, ymax = x.min(), x.max(), y.min(), y.max()
    pad = 1e-9 * (xmax - xmin)
    xmin, xmax = xmin - pad, xmax + pad
    sx, sy = (xmax - xmin) / nx, (ymax - ymin) / ny
    ix, iy = (x - xmin) / sx, (y - ymin) / sy
    ix1, iy1, ix2, iy2 = np.round(ix), np.round(iy), np.floor(ix), np.floor(iy)
    d1 = (ix - ix1) ** 2 + 3.0 * (iy - iy1) ** 2
    d2 = (ix - ix2 - 0.5) ** 2 + 3.0 * (iy - iy2 - 0.5) ** 2
    out = {}
    for a, b1, b2, c1, c2, first in zip(ix1, iy1, ix2, iy2, iy2, d1 < d2):
        key = (1, int(a), int(b1)) if first else (2, int(b2), int(c1))
        out[key] = out.get(key, 0) + 1
    return out


def test_hexbin_matches_bruteforce(xy):
    df, x, y, _ = xy
    got = {(r.lattice, r.ix, r.iy): r["count"] for r in E.hexbin(df, "x", "y", 60).collect()}
    assert got == hexbin_bruteforce(x, y, 60)


def test_box_stats_match_matplotlib_rules(xy):
    df, x, _, g = xy
    rows = {r.g: r for r in E.box_stats(df, "x", "g").collect()}
    for k in range(3):
        v = np.sort(x[g == k])
        q1, med, q3 = np.percentile(v, [25, 50, 75])
        iqr = q3 - q1
        hi = v[v <= q3 + 1.5 * iqr].max()
        lo = v[v >= q1 - 1.5 * iqr].min()
        r = rows[k]
        assert abs(r.q1 - q1) < 1e-6 and abs(r.median - med) < 1e-6 and abs(r.q3 - q3) < 1e-6
        assert abs(r.whishi - max(hi, q3)) < 1e-6 and abs(r.whislo - min(lo, q1)) < 1e-6
        assert r.outliers == int(((v < lo) | (v > hi)).sum())
        assert abs(r.notch_hi - (med + 1.57 * iqr / math.sqrt(len(v)))) < 1e-6


def test_correlation_pairwise_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0, None), (2.0, 4.1, 0.0, 1.0), (3.0, 5.9, 0.0, 3.0), (4.0, 8.2, 0.0, 2.0)],
                               "a double, b double, c double, d double")
    r = {(x.x, x.y): x.r for x in E.correlation(df, ["a", "b", "c", "d"]).collect()}
    assert len(r) == 6
    assert abs(r[("b", "a")] - np.corrcoef([1, 2, 3, 4], [2, 4.1, 5.9, 8.2])[0, 1]) < 1e-6
    assert r[("c", "a")] is None  # constant column -> undefined, not an error
    assert abs(r[("d", "a")] - np.corrcoef([2, 3, 4], [1, 3, 2])[0, 1]) < 1e-6  # pairwise complete


def test_percentile_interpolation_and_medians(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 10]], "x double")
    assert abs(df.agg(F.percentile("x", F.lit(0.95))).first()[0] - 8.8) < 1e-12
    m = E.medians(df, {"all": ("x", None), "small": ("x", F.col("x") < 4)}).collect()
    assert {r.name: r.median for r in m} == {"all": 3.0, "small": 2.0}


def test_trend_line_points(xy):
    df, x, y, _ = xy
    t = E.trend_line(df, "x", "y", 200).collect()
    m, b = np.polyfit(x, y, 1)
    assert len(t) == 200 and abs(t[0].slope - m) < 1e-5 and abs(t[0].intercept - b) < 1e-5
    assert abs(t[-1].x - x.max()) < 1e-6


def test_threshold_shares_and_flag_combinations(spark):
    df = spark.createDataFrame([(-1.0, 1, 0), (5.0, 0, 0), (None, 0, 1), (200.0, 1, 0)], "d double, f1 int, f2 int")
    s = {r.rule: r.pct for r in E.threshold_shares(df, {"neg": ("d", F.col("d") < 0, None),
                                                        "long": ("d", F.col("d") > 180, F.col("d") > 0)}).collect()}
    assert abs(s["neg"] - 100 / 3) < 1e-5 and s["long"] == 50.0
    fc = E.flag_combinations(df, ["f1", "f2"], names=["a", "b"]).collect()
    assert (fc[0].label, fc[0]["count"]) == ("a=1, b=0", 2)
    assert sorted((r.label, r["count"]) for r in fc[1:]) == [("a=0, b=0", 1), ("a=0, b=1", 1)]


def test_temporal_profile_grouping_sets(spark):
    df = spark.createDataFrame([(8, 2, 1, 10.0), (8, 1, 1, 20.0), (17, 2, 2, 30.0)],
                               "pickup_hour int, pickup_dayofweek int, pickup_month int, trip_duration_min double")
    rows = {(r.dimension, r.key): (r.mean_duration, r.n, r.band) for r in E.temporal_profile(df).collect()}
    assert rows[("hour", 8)] == (15.0, 2, "rush") and rows[("dayofweek", 1)] == (20.0, 1, "weekend")
    assert rows[("month", 2)] == (30.0, 1, None) and len(rows) == 6
