"""Registered exploration queries (D4-D15, B22-B24) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripcraft import schema as S
from tripcraft.functions import columns as C
from tripcraft.operators import explore as E
from tripcraft.operators import features as FE
from tripcraft.plans import oracle_sql as O
from tripcraft.plans.queries import CLEAN_CTES, W, cleaned, query, raw_features

CLEANED_MIN = ("cleaned_min AS (SELECT *, trip_duration_seconds / 60.0e0 AS trip_duration_min FROM cleaned)")


def cleaned_min(spark, sf):
    return cleaned(spark, sf).withColumn("trip_duration_min", C.minutes("trip_duration_seconds"))


# ---------------------------------------------------------------- D4 flag combinations

@query("flag_combinations", W(*CLEAN_CTES, body="""
SELECT flag_no_meter, flag_overcharge, count(*) AS count,
  'no_meter=' || flag_no_meter || chr(10) || 'overcharge=' || flag_overcharge AS label
FROM cleaned GROUP BY flag_no_meter, flag_overcharge"""))
def q_flag_combinations(spark, sf):
    return E.flag_combinations(cleaned(spark, sf), ["flag_no_meter", "flag_overcharge"], ascending=False,
                               sep="\n", names=["no_meter", "overcharge"])


@query("flag_combinations_raw", W(O.TRIPS, O.RAWF, body="""
SELECT has_negative_fee, no_meter, count(*) AS count,
  'neg_fee=' || has_negative_fee || ', no_meter=' || no_meter AS label
FROM rawf GROUP BY has_negative_fee, no_meter"""))
def q_flag_combinations_raw(spark, sf):
    return E.flag_combinations(raw_features(spark, sf), ["has_negative_fee", "no_meter"], ascending=True,
                               names=["neg_fee", "no_meter"])


# ---------------------------------------------------------------- D5 negative fee counts

@query("negative_fee_counts", W(O.TRIPS, body=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < 0) AS negative_rows,"
    f" round(count(*) FILTER (WHERE {c} < 0) * 100.0e0 / count(*), 6) AS pct_of_rows FROM trips"
    for c in S.NEG_FEE_COLUMNS)))
def q_negative_fee_counts(spark, sf):
    from tripcraft.operators.quality import negative_counts
    from tripcraft.plans.queries import trips
    return negative_counts(trips(spark, sf))


# ---------------------------------------------------------------- D6 temporal profiles

def _profile_sql(src: str) -> str:
    return f"""
SELECT CASE WHEN grouping(pickup_hour) = 0 THEN 'hour' WHEN grouping(pickup_dayofweek) = 0 THEN 'dayofweek'
            ELSE 'month' END AS dimension,
  CAST(CASE WHEN grouping(pickup_hour) = 0 THEN pickup_hour WHEN grouping(pickup_dayofweek) = 0 THEN pickup_dayofweek
            ELSE pickup_month END AS INTEGER) AS key,
  CASE WHEN grouping(pickup_hour) = 0 THEN
         CASE WHEN pickup_hour BETWEEN 7 AND 9 OR pickup_hour BETWEEN 16 AND 19 THEN 'rush' ELSE 'other' END
       WHEN grouping(pickup_dayofweek) = 0 THEN
         CASE WHEN pickup_dayofweek IN (1, 7) THEN 'weekend' ELSE 'weekday' END END AS band,
  round(avg(trip_duration_min), 6) AS mean_duration, count(*) AS n
FROM {src} GROUP BY GROUPING SETS ((pickup_hour), (pickup_dayofweek), (pickup_month))"""


@query("temporal_profile_raw", W(O.TRIPS, O.RAWF, body=_profile_sql("rawf")))
def q_temporal_profile_raw(spark, sf):
    return E.temporal_profile(raw_features(spark, sf))


@query("temporal_profile", W(*CLEAN_CTES, CLEANED_MIN, body=_profile_sql("cleaned_min")))
def q_temporal_profile(spark, sf):
    return E.temporal_profile(cleaned_min(spark, sf))


# ---------------------------------------------------------------- D7 medians, D8 shares

@query("medians", W(*CLEAN_CTES, CLEANED_MIN, body="""
SELECT 'duration_min' AS name, round(quantile_cont(trip_duration_min, 0.5), 6) AS median FROM cleaned_min
UNION ALL SELECT 'speed_capped_60', round(quantile_cont(speed_mph_proxy, 0.5) FILTER (WHERE speed_mph_proxy <= 60), 6)
FROM cleaned_min"""))
def q_medians(spark, sf):
    return E.medians(cleaned_min(spark, sf), {
        "duration_min": ("trip_duration_min", None),
        "speed_capped_60": ("speed_mph_proxy", F.col("speed_mph_proxy") <= 60),
    })


@query("medians_raw", W(O.TRIPS, O.RAWF, body="""
SELECT 'speed_0_120' AS name,
  round(quantile_cont(speed_mph_proxy, 0.5) FILTER (WHERE speed_mph_proxy BETWEEN 0 AND 120), 6) AS median FROM rawf"""))
def q_medians_raw(spark, sf):
    return E.medians(raw_features(spark, sf), {"speed_0_120": ("speed_mph_proxy", F.col("speed_mph_proxy").between(0, 120))})


def _share_sql(name, col, pred, within="TRUE", src="rawf"):
    base = f"{col} IS NOT NULL AND ({within})"
    return (f"SELECT '{name}' AS rule, round(avg(CASE WHEN {base} THEN CASE WHEN {pred} THEN 100.0e0 ELSE 0.0e0 END END), 6)"
            f" AS pct, count(*) FILTER (WHERE {base}) AS n FROM {src}")


@query("threshold_shares", W(O.TRIPS, O.RAWF, body=" UNION ALL ".join([
    _share_sql("duration_negative", "trip_duration_min", "trip_duration_min < 0"),
    _share_sql("duration_over_3h", "trip_duration_min", "trip_duration_min > 180", "trip_duration_min > 0"),
    _share_sql("speed_over_60", "speed_mph_proxy", "speed_mph_proxy > 60")])))
def q_threshold_shares(spark, sf):
    d = F.col("trip_duration_min")
    return E.threshold_shares(raw_features(spark, sf), {
        "duration_negative": ("trip_duration_min", d < 0, None),
        "duration_over_3h": ("trip_duration_min", d > 180, d > 0),
        "speed_over_60": ("speed_mph_proxy", F.col("speed_mph_proxy") > 60, None),
    })


@query("threshold_shares_clean", W(*CLEAN_CTES, body=_share_sql(
    "speed_over_60", "speed_mph_proxy", "speed_mph_proxy > 60", src="cleaned")))
def q_threshold_shares_clean(spark, sf):
    return E.threshold_shares(cleaned(spark, sf), {
        "speed_over_60": ("speed_mph_proxy", F.col("speed_mph_proxy") > 60, None)})


# ---------------------------------------------------------------- D9 correlation

def _corr_sql(cols, src):
    items = []
    for i, a in enumerate(cols):
        for b in cols[:i]:
            ma = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
            mb = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
            r = (f"CASE WHEN stddev_pop({ma}) = 0 OR stddev_pop({mb}) = 0 THEN NULL"
                 f" ELSE round(covar_pop({ma}, {mb}) / (stddev_pop({ma}) * stddev_pop({mb})), 6) END")
            items.append(f"{{'x': '{a}', 'y': '{b}', 'r': {r}}}")
    return f"SELECT unnest(l, recursive := true) FROM (SELECT [{', '.join(items)}] AS l FROM {src})"


@query("correlation", W(*CLEAN_CTES, body=_corr_sql(S.CLEAN_CORR_COLUMNS, "cleaned")))
def q_correlation(spark, sf):
    df = FE.keep_present(cleaned(spark, sf), S.CLEAN_CORR_COLUMNS)
    return E.correlation(FE.to_double(df, df.columns), df.columns)


@query("correlation_raw", W(O.TRIPS, O.RAWF, body=_corr_sql(S.RAW_CORR_COLUMNS, "rawf")))
def q_correlation_raw(spark, sf):
    df = FE.keep_present(raw_features(spark, sf), S.RAW_CORR_COLUMNS)
    return E.correlation(FE.to_double(df, df.columns, strict=False), df.columns)


# ---------------------------------------------------------------- D10 trend line

@query("trend_line", W(*CLEAN_CTES, CLEANED_MIN, """
s AS (SELECT regr_slope(trip_duration_min, trip_distance) AS slope, regr_intercept(trip_duration_min, trip_distance) AS intercept,
        min(trip_distance) AS lo, max(trip_distance) AS hi
      FROM cleaned_min WHERE trip_distance IS NOT NULL AND trip_duration_min IS NOT NULL),
g AS (SELECT CAST(k AS INTEGER) AS k, slope, intercept, lo + (hi - lo) * k / 199.0e0 AS xs FROM s, range(0, 200) r(k))""",
                       body="""
SELECT k, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(xs, 6) AS x,
  round(slope * xs + intercept, 6) AS y FROM g"""))
def q_trend_line(spark, sf):
    df = FE.drop_nulls(cleaned_min(spark, sf), ["trip_distance", "trip_duration_min"])
    return E.trend_line(df, "trip_distance", "trip_duration_min", 200)


# ---------------------------------------------------------------- D11 histograms

def _hist_query(ctes, src, col, bins, by=None, density=False, where="TRUE"):
    k = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    join_on = f"hd.{by} = hs.{by}" if by else "TRUE"
    on = f"c.bin = s.bin AND c.{by} = s.{by}" if by else "c.bin = s.bin"
    dens = (f", round(coalesce(c.count, 0) / (s.total * (s.hi - s.lo) / {bins}), 9) AS density" if density else "")
    block = f"""
hd AS (SELECT {k}CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL AND ({where})),
hs0 AS (SELECT {k}min(x) AS mn, max(x) AS mx, count(*) AS total FROM hd {grp}),
hs AS (SELECT {k}total, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
              CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM hs0),
hb AS (SELECT {('hd.' + by + ', ') if by else ''}CAST(least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin
       FROM hd JOIN hs ON {join_on}),
hc AS (SELECT {k}bin, count(*) AS count FROM hb GROUP BY {k}bin),
spine AS (SELECT hs.*, CAST(b AS INTEGER) AS bin FROM hs, range(0, {bins}) r(b))"""
    body = f"""
SELECT {('s.' + by + ', ') if by else ''}s.bin, round(s.lo + (s.hi - s.lo) / {bins} * s.bin, 6) AS bin_lo,
  round(s.lo + (s.hi - s.lo) / {bins} * (s.bin + 1), 6) AS bin_hi, CAST(coalesce(c.count, 0) AS BIGINT) AS count{dens}
FROM spine s LEFT JOIN hc c ON {on}"""
    return W(*ctes, block, body=body)


@query("hist_duration", _hist_query(CLEAN_CTES + (CLEANED_MIN,), "cleaned_min", "trip_duration_min", 80))
def q_hist_duration(spark, sf):
    return E.histogram(cleaned_min(spark, sf), "trip_duration_min", 80)


@query("hist_speed", _hist_query(CLEAN_CTES, "cleaned", "speed_mph_proxy", 100))
def q_hist_speed(spark, sf):
    return E.histogram(cleaned(spark, sf), "speed_mph_proxy", 100)


@query("hist_density_by_flag", _hist_query((O.TRIPS, O.RAWF), "rawf", "trip_duration_min", 100, by="has_negative_fee",
                                           density=True, where="trip_duration_min BETWEEN -30 AND 200"))
def q_hist_density_by_flag(spark, sf):
    df = FE.zoom(raw_features(spark, sf), {"trip_duration_min": (-30, 200)})
    return E.histogram(df, "trip_duration_min", 100, by="has_negative_fee", density=True)


# The remaining histograms of the raw and cleaned charts: key -> (column, bins, kept rows as SQL).
_RAW_HISTOGRAMS = {
    "hist_duration_raw": ("trip_duration_min", 200, "TRUE"),
    "hist_duration_raw_zoom": ("trip_duration_min", 150, "trip_duration_min BETWEEN -30 AND 200"),
    "hist_duration_raw_positive": ("trip_duration_min", 200, "trip_duration_min > 0"),
    "hist_speed_raw": ("speed_mph_proxy", 300, "TRUE"),
    "hist_speed_raw_zoom": ("speed_mph_proxy", 120, "speed_mph_proxy BETWEEN 0 AND 120"),
}


def _register_raw_histogram(key, column, bins, where):
    @query(key, _hist_query((O.TRIPS, O.RAWF), "rawf", column, bins, where=where))
    def run(spark, sf):
        return E.histogram(raw_features(spark, sf).filter(where), column, bins)


for _key, _spec in _RAW_HISTOGRAMS.items():
    _register_raw_histogram(_key, *_spec)


@query("hist_speed_capped", _hist_query(CLEAN_CTES, "cleaned", "speed_mph_proxy", 80, where="speed_mph_proxy <= 60"))
def q_hist_speed_capped(spark, sf):
    return E.histogram(cleaned(spark, sf).filter(F.col("speed_mph_proxy") <= 60), "speed_mph_proxy", 80)


# ---------------------------------------------------------------- D12 KDE

def _kde_query(ctes, src, col, bins, where="TRUE"):
    return W(*ctes, f"""
kd AS (SELECT {col} AS x FROM {src} WHERE {col} IS NOT NULL AND ({where})),
ks AS (SELECT count(*) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM kd),
kb AS (SELECT n, mn, mx, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw, mn AS g_lo, mx AS g_hi FROM ks),
kv AS (SELECT x, count(*) AS w FROM kd GROUP BY x),
kg AS (SELECT CAST(k AS INTEGER) AS k, g_lo + (g_hi - g_lo) * k / 199.0e0 AS gx, n, bw, mn, mx FROM kb, range(0, 200) r(k)),
kt AS (SELECT kg.k, kg.gx, kg.n, kg.bw, kg.mn, kg.mx, sum(kv.w * exp(-0.5 * pow((kg.gx - kv.x) / kg.bw, 2))) AS s
       FROM kg, kv GROUP BY kg.k, kg.gx, kg.n, kg.bw, kg.mn, kg.mx)""", body=f"""
SELECT k, round(gx, 6) AS x, round(s / (n * bw * sqrt(2 * pi())), 9) AS density,
  round(s / (n * bw * sqrt(2 * pi())) * n * (mx - mn) / {bins}, 6) AS count_scaled FROM kt""")


@query("kde_duration", _kde_query((*CLEAN_CTES, CLEANED_MIN), "cleaned_min", "trip_duration_min", 80))
def q_kde_duration(spark, sf):
    return E.kde(cleaned_min(spark, sf), "trip_duration_min", 200)


@query("kde_speed", _kde_query(CLEAN_CTES, "cleaned", "speed_mph_proxy", 100))
def q_kde_speed(spark, sf):
    return E.kde(cleaned(spark, sf), "speed_mph_proxy", 200, bins=100)


@query("kde_speed_capped", _kde_query(CLEAN_CTES, "cleaned", "speed_mph_proxy", 80, "speed_mph_proxy <= 60"))
def q_kde_speed_capped(spark, sf):
    return E.kde(cleaned(spark, sf).filter(F.col("speed_mph_proxy") <= 60), "speed_mph_proxy", 200, bins=80)


@query("kde_speed_zoom_raw", _kde_query((O.TRIPS, O.RAWF), "rawf", "speed_mph_proxy", 120, "speed_mph_proxy BETWEEN 0 AND 120"))
def q_kde_speed_zoom_raw(spark, sf):
    return E.kde(FE.zoom(raw_features(spark, sf), {"speed_mph_proxy": (0, 120)}), "speed_mph_proxy", 200, bins=120)


# ---------------------------------------------------------------- D13 hexbin

def _hex_sql(src, x, y, gridsize=60):
    import math
    nx, ny = gridsize, int(gridsize / math.sqrt(3))
    return f"""
xd AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
xs0 AS (SELECT min(x) AS xl, max(x) AS xh, min(y) AS ymin, max(y) AS ymax FROM xd),
xs AS (SELECT xl - (xh - xl) * 1e-9 AS xmin, xh + (xh - xl) * 1e-9 AS xmax, ymin, ymax FROM xs0),
xs2 AS (SELECT *, (xmax - xmin) / {nx} AS sx, (ymax - ymin) / {ny} AS sy FROM xs),
xp AS (SELECT (x - xmin) / sx AS fx, (y - ymin) / sy AS fy, xmin, ymin, sx, sy FROM xd, xs2),
xq AS (SELECT *, round_even(fx, 0) AS ix1, round_even(fy, 0) AS iy1, floor(fx) AS ix2, floor(fy) AS iy2 FROM xp),
xc AS (SELECT CASE WHEN pow(fx - ix1, 2) + 3.0 * pow(fy - iy1, 2) < pow(fx - ix2 - 0.5, 2) + 3.0 * pow(fy - iy2 - 0.5, 2)
                   THEN 1 ELSE 2 END AS lattice, * FROM xq),
xg AS (SELECT lattice, CAST(CASE WHEN lattice = 1 THEN ix1 ELSE ix2 END AS INTEGER) AS ix,
              CAST(CASE WHEN lattice = 1 THEN iy1 ELSE iy2 END AS INTEGER) AS iy, xmin, ymin, sx, sy, count(*) AS count
       FROM xc GROUP BY ALL)"""


_HEX_BODY = """
SELECT CAST(lattice AS INTEGER) AS lattice, ix, iy,
  round(xmin + (ix + CASE WHEN lattice = 2 THEN 0.5 ELSE 0.0 END) * sx, 6) AS cx,
  round(ymin + (iy + CASE WHEN lattice = 2 THEN 0.5 ELSE 0.0 END) * sy, 6) AS cy,
  count, round(log10(count), 9) AS log_count FROM xg WHERE count >= 1"""


@query("hexbin_distance_duration", W(*CLEAN_CTES, CLEANED_MIN, _hex_sql("cleaned_min", "trip_distance", "trip_duration_min"),
                                     body=_HEX_BODY))
def q_hexbin_distance_duration(spark, sf):
    return E.hexbin(cleaned_min(spark, sf), "trip_distance", "trip_duration_min", 60)


@query("hexbin_raw", W(O.TRIPS, O.RAWF, _hex_sql("rawf", "trip_distance", "trip_duration_min"), body=_HEX_BODY))
def q_hexbin_raw(spark, sf):
    return E.hexbin(raw_features(spark, sf), "trip_distance", "trip_duration_min", 60)


_ZOOM = {"trip_distance": (0, 40), "trip_duration_min": (0, 120)}


@query("hexbin_raw_zoom", W(O.TRIPS, O.RAWF, """
zoomed AS (SELECT * FROM rawf WHERE trip_distance BETWEEN 0 AND 40 AND trip_duration_min BETWEEN 0 AND 120)""",
                            _hex_sql("zoomed", "trip_distance", "trip_duration_min"), body=_HEX_BODY))
def q_hexbin_raw_zoom(spark, sf):
    return E.hexbin(FE.zoom(raw_features(spark, sf), _ZOOM), "trip_distance", "trip_duration_min", 60)


# ---------------------------------------------------------------- D14 box statistics, D15 labels

def _box_sql(src, col, by, where="TRUE", label_expr=None):
    grp = label_expr or by
    return f"""
bd AS (SELECT {grp} AS grp, CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL AND ({where})),
bq AS (SELECT grp, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3,
              count(*) AS n, avg(x) AS mean FROM bd GROUP BY grp),
bq2 AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM bq),
bw AS (SELECT bd.grp, min(x) FILTER (WHERE x >= lo_f) AS wl, max(x) FILTER (WHERE x <= hi_f) AS wh,
              count(*) FILTER (WHERE x < lo_f OR x > hi_f) AS outliers, min(x) AS mn, max(x) AS mx
       FROM bd JOIN bq2 ON bd.grp = bq2.grp GROUP BY bd.grp)""", f"""
SELECT q.grp AS {by}, n, round(mean, 6) AS mean, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(iqr, 6) AS iqr, round(coalesce(least(wl, q1), q1), 6) AS whislo, round(coalesce(greatest(wh, q3), q3), 6) AS whishi,
  outliers, round(median - 1.57 * iqr / sqrt(n), 6) AS notch_lo, round(median + 1.57 * iqr / sqrt(n), 6) AS notch_hi,
  round(mn, 6) AS min_value, round(mx, 6) AS max_value
FROM bq2 q JOIN bw ON q.grp = bw.grp"""


_bo_ctes, _bo_body = _box_sql("cleaned_min", "trip_duration_min", "flag_overcharge")


@query("box_by_overcharge", W(*CLEAN_CTES, CLEANED_MIN, _bo_ctes, body=_bo_body))
def q_box_by_overcharge(spark, sf):
    return E.box_stats(cleaned_min(spark, sf), "trip_duration_min", "flag_overcharge")


def _case_map(col, mapping):
    return "CASE " + " ".join(f"WHEN {col} = {k} THEN '{v}'" for k, v in mapping.items()) + " END"


_rc_ctes, _rc_body = _box_sql("rawf", "speed_mph_proxy", "rate_label",
                              where="RatecodeID IN (1, 2, 3, 4, 5, 6) AND speed_mph_proxy BETWEEN 0 AND 120",
                              label_expr=_case_map("RatecodeID", S.RATECODE_LABELS))


@query("speed_box_by_ratecode", W(O.TRIPS, O.RAWF, _rc_ctes, body=_rc_body))
def q_speed_box_by_ratecode(spark, sf):
    df = FE.known_codes(raw_features(spark, sf), "RatecodeID", S.RATECODE_LABELS)
    df = FE.zoom(df, {"speed_mph_proxy": (0, 120)}).withColumn("rate_label", C.label("RatecodeID", S.RATECODE_LABELS))
    return E.box_stats(df, "speed_mph_proxy", "rate_label")


@query("present_labels", W(O.TRIPS, O.RAWF, body=f"""
SELECT DISTINCT CAST(RatecodeID AS INTEGER) AS code, {_case_map('RatecodeID', S.RATECODE_LABELS)} AS label
FROM rawf WHERE RatecodeID IN (1, 2, 3, 4, 5, 6) AND speed_mph_proxy BETWEEN 0 AND 120"""))
def q_present_labels(spark, sf):
    df = FE.zoom(raw_features(spark, sf), {"speed_mph_proxy": (0, 120)})
    return E.present_labels(df, "RatecodeID", S.RATECODE_LABELS)


@query("label_codes", W(*CLEAN_CTES, body=f"""
SELECT pickup_dayofweek, {_case_map('pickup_dayofweek', S.DAY_SHORT)} AS day_label,
  pickup_month, {_case_map('pickup_month', S.MONTH_SHORT)} AS month_label,
  ratecode_clean, {_case_map('ratecode_clean', S.RATECODE_LABELS)} AS rate_label,
  payment_type, {_case_map('payment_type', S.PAYMENT_TYPES)} AS payment_label FROM cleaned"""))
def q_label_codes(spark, sf):
    return cleaned(spark, sf).select(
        "pickup_dayofweek", C.label("pickup_dayofweek", S.DAY_SHORT).alias("day_label"),
        "pickup_month", C.label("pickup_month", S.MONTH_SHORT).alias("month_label"),
        "ratecode_clean", C.label("ratecode_clean", S.RATECODE_LABELS).alias("rate_label"),
        "payment_type", C.label("payment_type", S.PAYMENT_TYPES).alias("payment_label"))


def _case_unmap(col, mapping):
    return "CASE " + " ".join(f"WHEN {col} = '{v}' THEN {k}" for k, v in mapping.items()) + " END"


@query("labels_to_codes", W(*CLEAN_CTES, f"""
named AS (SELECT {_case_map('pickup_dayofweek', S.DAY_NAMES)} AS day_name, {_case_map('pickup_month', S.MONTH_NAMES)} AS month_name,
  {_case_map('payment_type', S.PAYMENT_TYPES)} AS payment_name FROM cleaned)""", body=f"""
SELECT day_name, CAST({_case_unmap('day_name', S.DAY_NAMES)} AS INTEGER) AS pickup_dayofweek,
  month_name, CAST({_case_unmap('month_name', S.MONTH_NAMES)} AS INTEGER) AS pickup_month,
  payment_name, CAST({_case_unmap('payment_name', S.PAYMENT_TYPES)} AS INTEGER) AS payment_type FROM named"""))
def q_labels_to_codes(spark, sf):
    named = cleaned(spark, sf).select(
        C.label("pickup_dayofweek", S.DAY_NAMES).alias("day_name"),
        C.label("pickup_month", S.MONTH_NAMES).alias("month_name"),
        C.label("payment_type", S.PAYMENT_TYPES).alias("payment_name"))
    return named.select(
        "day_name", C.unlabel("day_name", S.DAY_NAMES).cast("int").alias("pickup_dayofweek"),
        "month_name", C.unlabel("month_name", S.MONTH_NAMES).cast("int").alias("pickup_month"),
        "payment_name", C.unlabel("payment_name", S.PAYMENT_TYPES).cast("int").alias("payment_type"))
