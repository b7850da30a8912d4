"""Exploration tables (inventory D3-D15), exact over all rows.

Every operator is one or two aggregations whose results are small (bins, groups, grid points);
per-row work stays in codegen'd projections, and only one-row / per-group statistics are joined
back (broadcast when their size has been checked).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcraft.functions import columns as C

# Broadcast a dimension table only up to this many rows (checked); beyond it, a shuffle join.
BROADCAST_ROW_LIMIT = 100_000
# Broadcast a statistics table only up to this size of its files (checked); beyond it, a salted join.
BROADCAST_BYTES = 16 << 20
SALTS = 64


def present(column: str) -> Column:
    """Neither null nor NaN (pandas' missing values)."""
    return F.col(column).isNotNull() & ~F.isnan(column)


def quantiles_by(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str], names: Sequence[str],
                 weight: str | None = None) -> DataFrame:
    from tripcraft.operators.quality import exact_quantiles
    return exact_quantiles(df, column, probs, by, names, weight)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row statistics table (a global aggregate) to every row.

    The row is one struct-valued scalar subquery: it runs once, later references reuse it, the
    data side stays in its codegen stage, and no join is planned. More than one row is an error,
    so the size bound is enforced, not assumed."""
    cols = one_row.columns
    s = one_row.select(F.struct(*cols).alias("_s")).scalar()
    return df.withColumns({c: s[c] for c in cols})


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a per-key statistics table to the data without moving the data by key (null keys match).

    The statistics are computed once into the shared folder, so their size is known: up to
    BROADCAST_BYTES they are broadcast. Beyond it the join shuffles both sides on the key and a
    salt (the data's scan partition), with the statistics repeated per salt, so that a hot key is
    spread over SALTS tasks. The data side is never broadcast: the hint names the statistics.
    Keyless (one-row) statistics go through `with_scalars`."""
    if not on:
        return with_scalars(big, small)
    from tripcraft.session import stored
    table, size = stored(small, "statistics")
    renamed = table.select(*(F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in table.columns))
    match = F.lit(True)
    for c in on:
        match = match & big[c].eqNullSafe(renamed[f"_on_{c}"])
    if size <= BROADCAST_BYTES:
        joined = big.join(F.broadcast(renamed), match, how)
    else:
        salted = big.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        repeated = renamed.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        match = salted["_salt"] == repeated["_copy"]
        for c in on:
            match = match & salted[c].eqNullSafe(repeated[f"_on_{c}"])
        joined = salted.join(repeated.hint("merge"), match, how).drop("_salt", "_copy")
    return joined.drop(*(f"_on_{c}" for c in on))


def flag_combinations(df: DataFrame, flags: Sequence[str], ascending: bool = False,
                      sep: str = ", ", names: Sequence[str] | None = None) -> DataFrame:
    """Row count per combination of integer flags, with a composite label, sorted by count."""
    g = df.groupBy(*flags).agg(F.count(F.lit(1)).alias("count"))
    g = g.withColumn("label", C.flag_label(flags, sep, names))
    return g.orderBy(F.col("count").asc() if ascending else F.col("count").desc(), *flags)


def temporal_profile(df: DataFrame, value: str = "trip_duration_min") -> DataFrame:
    """Mean of `value` and row count by pickup hour, weekday and month, in ONE pass (grouping sets).

    Output (dimension, key, band, mean_duration, n); band annotates rush hours and weekend days.
    """
    dims = ["pickup_hour", "pickup_dayofweek", "pickup_month"]
    g = df.groupingSets([[d] for d in dims], *dims).agg(
        F.avg(value).alias("mean_duration"), F.count(F.lit(1)).alias("n"),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    dimension = (F.when(F.col("_g_pickup_hour") == 0, "hour")
                 .when(F.col("_g_pickup_dayofweek") == 0, "dayofweek").otherwise("month"))
    key = (F.when(F.col("_g_pickup_hour") == 0, F.col("pickup_hour"))
           .when(F.col("_g_pickup_dayofweek") == 0, F.col("pickup_dayofweek")).otherwise(F.col("pickup_month")))
    band = (F.when(F.col("_g_pickup_hour") == 0, C.hour_band(F.col("pickup_hour")))
            .when(F.col("_g_pickup_dayofweek") == 0, C.day_kind(F.col("pickup_dayofweek"))))
    return g.select(dimension.alias("dimension"), key.cast("int").alias("key"), band.alias("band"),
                    F.round("mean_duration", 6).alias("mean_duration"), F.col("n").cast("bigint").alias("n")
                    ).orderBy("dimension", "key")


def medians(df: DataFrame, specs: Mapping[str, tuple[str, Column | None]]) -> DataFrame:
    """Exact interpolated medians: {name: (column, row filter or None)} -> (name, median), one scan.

    Each row becomes one (name, value) record per spec; (name, value) counts are aggregated first, and the
    ranks are read from their range partitions (`exact_quantiles`)."""
    recs = F.array(*[F.struct(F.lit(n).alias("name"),
                              (F.col(c) if cond is None else F.when(cond, F.col(c))).cast("double").alias("v"))
                     for n, (c, cond) in specs.items()])
    long = df.select(F.explode(recs).alias("r")).select("r.*")
    q = quantiles_by(long, "v", [0.5], ["name"], ["median"])
    names = df.sparkSession.createDataFrame([(n,) for n in specs], "name string")
    return names.join(q, "name", "left").select("name", F.round("median", 6).alias("median"))


def threshold_shares(df: DataFrame, rules: Mapping[str, tuple[str, Column, Column | None]]) -> DataFrame:
    """Percent of rows meeting a predicate among non-null rows of a column (optionally restricted).

    rules: {name: (column, predicate, restriction or None)} -> (rule, pct, n), one scan."""
    aggs = []
    for name, (c, pred, within) in rules.items():
        base = F.col(c).isNotNull() if within is None else (F.col(c).isNotNull() & within)
        aggs += [F.avg(F.when(base, F.when(pred, 100.0).otherwise(0.0))).alias(name),
                 F.count_if(base).alias(f"{name}__n")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(n).alias("rule"), F.round(F.col(n), 6).alias("pct"),
                     F.col(f"{n}__n").cast("bigint").alias("n")) for n in rules]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def correlation(df: DataFrame, cols: Sequence[str], places: int = 6) -> DataFrame:
    """Pearson r for every pair (lower triangle), pairwise-complete; null where a side is constant.

    Block moment matrices: a task adds up, over its Arrow batches, X'X, X'M, (X^2)'M and M'M (M marks present
    values, X holds them less a shift, 0 where missing), and gives one row. The rows are added by one aggregate of
    4 x columns^2 numbers, so no row of the data becomes more than one row anywhere. The shift is the mean of the first
    thousand rows: it keeps the sums small against the spread, any other gives the same result up to rounding."""
    cols = list(cols)
    d = len(cols)
    data = df.select(*(F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)))
    first = data.limit(1000).agg(*(F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in data.columns)).first()
    shift = np.array([first[k] if first[k] is not None and math.isfinite(first[k]) else 0.0 for k in range(d)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, d, d))
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            m = ~np.isnan(x)
            x, m = np.where(m, x - shift, 0.0), m.astype(np.float64)
            for part, left, right in zip(total, (x, x, x * x, m), (x, m, m, m), strict=True):
                part += np.einsum("ni,nj->ij", left, right)
        yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1).tolist()], pa.list_(pa.float64()))], names=["s"])

    parts = data.mapInArrow(run, "s array<double>")
    sums = parts.select(F.posexplode("s").alias("k", "s")).groupBy("k").agg(F.sum("s").alias("s"))
    s = F.col("s")
    at = lambda part, i, j: F.try_element_at(s, F.lit(1) + (F.lit(part * d) + i) * d + j)
    whole = sums.agg(F.array_sort(F.collect_list(F.struct("k", "s"))).alias("s")).select(F.transform("s", lambda e: e["s"]).alias("s"))
    pairs = whole.select("s", F.explode(F.sequence(F.lit(0), F.lit(d - 1))).alias("i")).where("i > 0").select(
        "s", "i", F.explode(F.sequence(F.lit(0), F.col("i") - 1)).alias("j"))
    i, j = F.col("i"), F.col("j")
    n, si, sj = at(3, i, j), at(1, i, j), at(1, j, i)  # rows of the pair, sums of either side over them
    cov, vi, vj = at(0, i, j) - si * F.try_divide(sj, n), at(2, i, j) - si * F.try_divide(si, n), at(2, j, i) - sj * F.try_divide(sj, n)
    # rounding of the sums is no spread
    spread = lambda v, part: F.when(v > F.lit(1e-12) * part, v)
    r = F.try_divide(cov, F.sqrt(spread(vi, at(2, i, j))) * F.sqrt(spread(vj, at(2, j, i))))
    names = F.array(*(F.lit(c) for c in cols))
    return pairs.select(F.element_at(names, i + 1).alias("x"), F.element_at(names, j + 1).alias("y"), F.round(r, places).alias("r"))


def trend_line(df: DataFrame, x: str, y: str, points: int = 200) -> DataFrame:
    """Least-squares line y ~ x (rows with both present) and `points` evenly spaced points on it."""
    s = df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
               F.min(F.when(F.col(y).isNotNull(), F.col(x))).alias("lo"),
               F.max(F.when(F.col(y).isNotNull(), F.col(x))).alias("hi"))
    k = F.col("k")
    xs = F.col("lo") + (F.col("hi") - F.col("lo")) * k / F.lit(points - 1)
    return (s.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
            .select(k.cast("int").alias("k"), F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"),
                    F.round(xs, 6).alias("x"), F.round(F.col("slope") * xs + F.col("intercept"), 6).alias("y")))


def bin_index(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin in [0, bins): floor((x-lo)/(hi-lo)*bins), the maximum in the last bin."""
    return F.least(F.floor((x - lo) / (hi - lo) * F.lit(bins)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None, density: bool = False) -> DataFrame:
    """numpy-style histogram over [min, max] (per group when `by`), empty bins kept.

    Pass 1: min/max (per group). Pass 2: bin each row against its group's range, count per
    (group, bin) with map-side partial aggregation. Bins with no rows come from a spine made by
    exploding sequence(0, bins-1) on the statistics table (no join with the data).
    min = max is widened by +-0.5 and an empty input spans [0, 1], as numpy does.
    """
    keys = [by] if by else []
    data = df.select(*keys, F.col(column).cast("double").alias("x")).filter(present("x"))
    stats = data.groupBy(*keys).agg(F.min("x").alias("mn"), F.max("x").alias("mx"), F.count(F.lit(1)).alias("total"))
    # numpy: min = max widens by 0.5 each side; an empty input spans [0, 1].
    stats = stats.select(*keys, "total",
                         F.coalesce(F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")),
                                    F.lit(0.0)).alias("lo"),
                         F.coalesce(F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")),
                                    F.lit(1.0)).alias("hi"))
    binned = join_small(data, stats, keys).select(*keys, bin_index(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin"))
    counts = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    spine = stats.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = spine.join(counts, keys + ["bin"], "left").select(
        *keys, F.col("bin").cast("int").alias("bin"),
        F.round(F.col("lo") + width * F.col("bin"), 6).alias("bin_lo"),
        F.round(F.col("lo") + width * (F.col("bin") + 1), 6).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        *([F.round(F.try_divide(F.coalesce(F.col("count"), F.lit(0)).cast("double"), F.col("total") * width), 9)
            .alias("density")] if density else []))
    return out.orderBy(*keys, "bin")


KDE_CELLS = 4  # cells of a bandwidth
KDE_TERMS = 10


def _hermite(terms: int) -> list[list[int]]:
    """Coefficients (ascending powers) of the Hermite polynomials He_0 ... of probability theory."""
    rows = [[1], [0, 1]]
    for p in range(1, terms - 1):
        up = [0, *rows[p]]
        rows.append([c - p * (rows[p - 1][m] if m < len(rows[p - 1]) else 0) for m, c in enumerate(up)])
    return rows[:terms]


def kde(df: DataFrame, column: str, grid: int = 200, cut: float = 0.0, bins: int = 80, method: str = "moments") -> DataFrame:
    """Gaussian kernel density on `grid` evenly spaced points, Scott bandwidth sd_samp * n^(-1/5).

    moments: rows collapse to cells a quarter of a bandwidth wide, each with its first ten power sums of u = (x - centre)
    / bandwidth, in one map-side aggregate; with t = (grid point - centre) / bandwidth a row's kernel is exp(-(t - u)^2 / 2)
    = exp(-t^2 / 2) * sum of He_p(t) u^p / p!, so a cell adds a polynomial in t. Since |He_p(t)| exp(-t^2 / 4) <= 1.09
    sqrt(p!) and |u| <= 1/8, what is left out is below 1.1 * 8^-10 / sqrt(10!) < 6e-13 of a kernel's peak. Kernel work
    grows with the cells (range / bandwidth), not with rows or distinct values.
    exact: every distinct value adds its own term to every grid point.
    Grid spans [min - cut*bw, max + cut*bw]; `count_scaled` is the density on the scale of a histogram
    of `bins` bins over [min, max] (n * density * bin width), as a curve drawn over it.
    """
    if method not in ("moments", "exact"):
        raise ValueError(f"method must be 'moments' or 'exact', not {method!r}")
    data = df.select(F.col(column).cast("double").alias("x")).filter(present("x"))
    stats = data.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("mn"),
                     F.max("x").alias("mx"))
    stats = stats.withColumn("bw", F.nullif(F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)), F.lit(0.0)))
    stats = stats.withColumns({"g_lo": F.col("mn") - F.lit(cut) * F.col("bw"), "g_hi": F.col("mx") + F.lit(cut) * F.col("bw")})
    gx = F.col("g_lo") + (F.col("g_hi") - F.col("g_lo")) * F.col("k") / F.lit(grid - 1)
    points = F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))
    if method == "exact":
        values = data.groupBy("x").agg(F.count(F.lit(1)).alias("w"))
        terms = with_scalars(values, stats).withColumn("k", points).withColumn("gx", gx).withColumn(
            "t", F.col("w") * F.exp(-0.5 * F.pow((F.col("gx") - F.col("x")) / F.col("bw"), 2)))
    else:
        cell = F.floor((F.col("x") - F.col("mn")) / F.col("bw") * KDE_CELLS)
        centre = F.col("mn") + (F.col("cell") + 0.5) / KDE_CELLS * F.col("bw")
        placed = with_scalars(data, stats.select("mn", "bw")).withColumn("cell", cell).withColumn("u", (F.col("x") - centre) / F.col("bw"))
        power, powers = F.lit(1.0), []
        for _ in range(KDE_TERMS):
            powers.append(power)
            power = power * F.col("u")
        sums = placed.groupBy("cell").agg(*(F.sum(p).alias(f"m{k}") for k, p in enumerate(powers)))
        rows = _hermite(KDE_TERMS)
        # the cell's polynomial in t
        poly = {f"p{m}": sum((F.col(f"m{p}") * F.lit(rows[p][m] / math.factorial(p)) for p in range(m, KDE_TERMS)
                              if m < len(rows[p]) and rows[p][m]), F.lit(0.0)) for m in range(KDE_TERMS)}
        terms = with_scalars(sums.select("cell", *(c.alias(n) for n, c in poly.items())), stats).withColumn("k", points).withColumn(
            "gx", gx).withColumn("u", (F.col("gx") - centre) / F.col("bw"))
        value = F.col(f"p{KDE_TERMS - 1}")
        for m in range(KDE_TERMS - 2, -1, -1):
            value = value * F.col("u") + F.col(f"p{m}")
        terms = terms.withColumn("t", value * F.exp(-0.5 * F.col("u") * F.col("u")))
    dens = terms.groupBy("k", "gx", "n", "bw", "mn", "mx").agg(F.sum("t").alias("s"))
    d = F.col("s") / (F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi)))
    return dens.select(F.col("k").cast("int").alias("k"), F.round("gx", 6).alias("x"), F.round(d, 9).alias("density"),
                       F.round(d * F.col("n") * (F.col("mx") - F.col("mn")) / F.lit(bins), 6).alias("count_scaled")).orderBy("k")


def hexbin(df: DataFrame, x: str, y: str, gridsize: int = 60, mincnt: int = 1) -> DataFrame:
    """Hexagonal binning as matplotlib's hexbin: two offset lattices, nearest centre wins.

    nx = gridsize, ny = int(nx / sqrt(3)); x range padded by 1e-9 of its span; rint is half-even
    like numpy's round. Output one row per cell with >= mincnt points: (lattice, ix, iy, centre,
    count, log10 count).
    """
    nx = gridsize
    ny = int(nx / math.sqrt(3))
    data = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter(present("x") & present("y"))
    s = data.agg(F.min("x").alias("xmin0"), F.max("x").alias("xmax0"), F.min("y").alias("ymin0"), F.max("y").alias("ymax0"))

    def nonsingular(lo, hi):
        same = F.col(hi) - F.col(lo) == 0
        lo2 = F.when(same & (F.col(lo) == 0), -0.1).when(same, F.col(lo) - 0.1 * F.abs(F.col(lo))).otherwise(F.col(lo))
        hi2 = F.when(same & (F.col(hi) == 0), 0.1).when(same, F.col(hi) + 0.1 * F.abs(F.col(hi))).otherwise(F.col(hi))
        return lo2, hi2

    xl, xh = nonsingular("xmin0", "xmax0")
    yl, yh = nonsingular("ymin0", "ymax0")
    s = s.select(xl.alias("xl"), xh.alias("xh"), yl.alias("ymin"), yh.alias("ymax"))
    pad = (F.col("xh") - F.col("xl")) * 1e-9
    s = s.select((F.col("xl") - pad).alias("xmin"), (F.col("xh") + pad).alias("xmax"), "ymin", "ymax")
    s = s.withColumns({"sx": (F.col("xmax") - F.col("xmin")) / nx, "sy": (F.col("ymax") - F.col("ymin")) / ny})
    p = with_scalars(data, s)
    p = p.withColumns({"fx": (F.col("x") - F.col("xmin")) / F.col("sx"), "fy": (F.col("y") - F.col("ymin")) / F.col("sy")})
    p = p.withColumns({"ix1": F.rint("fx"), "iy1": F.rint("fy"), "ix2": F.floor("fx"), "iy2": F.floor("fy")})
    d1 = F.pow(F.col("fx") - F.col("ix1"), 2) + 3.0 * F.pow(F.col("fy") - F.col("iy1"), 2)
    d2 = F.pow(F.col("fx") - F.col("ix2") - 0.5, 2) + 3.0 * F.pow(F.col("fy") - F.col("iy2") - 0.5, 2)
    first = d1 < d2
    cell = p.select(
        F.when(first, 1).otherwise(2).alias("lattice"),
        F.when(first, F.col("ix1")).otherwise(F.col("ix2")).cast("int").alias("ix"),
        F.when(first, F.col("iy1")).otherwise(F.col("iy2")).cast("int").alias("iy"),
        "xmin", "ymin", "sx", "sy")
    g = cell.groupBy("lattice", "ix", "iy", "xmin", "ymin", "sx", "sy").agg(F.count(F.lit(1)).alias("count"))
    off = F.when(F.col("lattice") == 2, 0.5).otherwise(0.0)
    return g.filter(F.col("count") >= mincnt).select(
        "lattice", "ix", "iy",
        F.round(F.col("xmin") + (F.col("ix") + off) * F.col("sx"), 6).alias("cx"),
        F.round(F.col("ymin") + (F.col("iy") + off) * F.col("sy"), 6).alias("cy"),
        F.col("count").cast("bigint").alias("count"),
        F.round(F.log10(F.col("count")), 9).alias("log_count"))


def box_stats(df: DataFrame, column: str, by: str, whis: float = 1.5) -> DataFrame:
    """Box-plot statistics per group (matplotlib conventions): interpolated quartiles, whiskers at
    the furthest points inside q1 - whis*IQR / q3 + whis*IQR, outlier count, notch median +-
    1.57*IQR/sqrt(n), mean.

    One pass over the data counts (group, value) pairs; quartiles, whiskers and outliers all come
    from that table, and the per-group statistics are joined to it, never to the data. NaN counts as
    missing, as in pandas.
    """
    from tripcraft.session import stored
    data = df.select(F.col(by).alias("grp"), F.col(column).cast("double").alias("x")).filter(present("x"))
    vc, _ = stored(data.groupBy("grp", "x").agg(F.count(F.lit(1)).alias("_w")), "values")
    q = quantiles_by(vc, "x", [0.25, 0.5, 0.75], ["grp"], ["q1", "median", "q3"], weight="_w")
    sums = vc.groupBy("grp").agg(F.sum("_w").alias("n"), (F.sum(F.col("x") * F.col("_w")) / F.sum("_w")).alias("mean"))
    q = q.withColumnRenamed("grp", "_g").join(sums, F.col("_g").eqNullSafe(F.col("grp"))).drop("_g")
    q = q.withColumns({"iqr": F.col("q3") - F.col("q1")})
    q = q.withColumns({"lo_f": F.col("q1") - whis * F.col("iqr"), "hi_f": F.col("q3") + whis * F.col("iqr")})
    j = join_small(vc, q, ["grp"])
    # matplotlib: whiskers at the furthest points not beyond each fence (the quartile when there is
    # none); every point beyond a fence is an outlier.
    stat_cols = ["grp", "q1", "median", "q3", "n", "mean", "iqr"]
    # The per-group statistics ride along as grouping keys (one value per group), so the
    # statistics table is joined to the data once.
    out = j.groupBy(*stat_cols).agg(
        F.min(F.when(F.col("x") >= F.col("lo_f"), F.col("x"))).alias("whislo0"),
        F.max(F.when(F.col("x") <= F.col("hi_f"), F.col("x"))).alias("whishi0"),
        F.sum(F.when((F.col("x") < F.col("lo_f")) | (F.col("x") > F.col("hi_f")), F.col("_w")).otherwise(0)).alias("outliers"),
        F.min("x").alias("mn"), F.max("x").alias("mx"))
    out = out.withColumns({"whislo": F.coalesce(F.least(F.col("whislo0"), F.col("q1")), F.col("q1")),
                           "whishi": F.coalesce(F.greatest(F.col("whishi0"), F.col("q3")), F.col("q3"))})
    notch = 1.57 * F.col("iqr") / F.sqrt(F.col("n").cast("double"))
    r6 = lambda c: F.round(c, 6)
    return out.select(
        F.col("grp").alias(by), F.col("n").cast("bigint").alias("n"), r6(F.col("mean")).alias("mean"),
        r6(F.col("q1")).alias("q1"), r6(F.col("median")).alias("median"), r6(F.col("q3")).alias("q3"),
        r6(F.col("iqr")).alias("iqr"), r6(F.col("whislo")).alias("whislo"), r6(F.col("whishi")).alias("whishi"),
        F.col("outliers").cast("bigint").alias("outliers"),
        r6(F.col("median") - notch).alias("notch_lo"), r6(F.col("median") + notch).alias("notch_hi"),
        r6(F.col("mn")).alias("min_value"), r6(F.col("mx")).alias("max_value")).orderBy(by)


def present_labels(df: DataFrame, column: str, mapping: Mapping[int, str]) -> DataFrame:
    """Distinct known codes present, with their labels, in code order."""
    return (df.filter(F.col(column).isin(list(mapping))).select(F.col(column).cast("int").alias("code")).distinct()
            .select("code", C.label(F.col("code"), mapping).alias("label")).orderBy("code"))
