"""Queries: exploratory statistics (A-*) on the EDA part (bucket < 80) of the processed table."""

from __future__ import annotations

from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.functions.stats import normal_quantiles
from resale.operators import eda
from resale.plans import prepared as P
from resale.plans.oracle_base import WITH_PROCESSED
from resale.plans.registry import query
from resale.plans.sqlhelp import I, R

KEYS = ["order_key", "line_number", "part_key", "supp_key"]
KEYS_SQL = "order_key, line_number, part_key, supp_key"
EDA_COLS = [
    "mileage", "engine_power", "car_age_years", "annual_mileage", "power_age_ratio", "age_mileage_interaction",
    "mileage_per_power", "luxury_tier", "registration_year", "fuel_encoded", "color_encoded", "car_type_encoded",
]
CATS = ["fuel", "car_type", "paint_color"]
WITH_EDA = f"""{WITH_PROCESSED},
eda AS (SELECT * FROM processed WHERE bucket < {K.EDA_TRAIN_SHARE})"""


def eda_frame(spark, sf_dir):
    return P.processed_rows(spark, sf_dir).where(F.col("bucket") < K.EDA_TRAIN_SHARE)


def _x(c):
    return f"CAST({c} AS DOUBLE)"


def _profile_sql(c):
    x = _x(c)
    return (f"SELECT '{c}' AS column_name, {I(f'count({c})', 'n')}, {R(f'avg({x})', 'mean')}, {R(f'quantile_cont({x}, 0.5)', 'median')}, "
            f"{R(f'stddev_samp({x})', 'std')}, {R(f'min({x})', 'min')}, {R(f'max({x})', 'max')}, {R(f'quantile_cont({x}, 0.25)', 'q1')}, "
            f"{R(f'quantile_cont({x}, 0.75)', 'q3')}, {R(f'quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)', 'iqr')} FROM eda")


@query("a01_distribution_profile", f"""{WITH_EDA}
{' UNION ALL '.join(_profile_sql(c) for c in ['price', 'price_log'])}""")
def a01_distribution_profile(spark, sf_dir):
    """A-01: mean, median, std, min, max, quartiles, IQR of price and log price."""
    return eda.profile(eda_frame(spark, sf_dir), ["price", "price_log"])


SKEW_COLS = ["price", "price_log"] + EDA_COLS


@query("a02_skewness", f"""{WITH_EDA}
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, {R(f'skewness({_x(c)})', 'skewness')} FROM eda" for c in SKEW_COLS)}""")
def a02_skewness(spark, sf_dir):
    """A-02: bias-adjusted skewness per numeric column."""
    return eda.skewness(eda_frame(spark, sf_dir), SKEW_COLS)


SHAPE_COLS = ["price", "price_log", "mileage"]


def _shape_sql(c):
    x = _x(c)
    ratio = f"avg({x}) / nullif(quantile_cont({x}, 0.5), 0)"
    return (f"SELECT '{c}' AS column_name, {R(ratio, 'mean_median_ratio')}, "
            f"CASE WHEN {ratio} > {K.SHAPE_RIGHT} THEN 'right_skewed' WHEN {ratio} < {K.SHAPE_LEFT} THEN 'left_skewed' ELSE 'balanced' END AS shape, "
            f"abs(skewness({x})) < 1 AS near_symmetric FROM eda")


@query("a03_shape_verdict", f"""{WITH_EDA}
{' UNION ALL '.join(_shape_sql(c) for c in SHAPE_COLS)}""")
def a03_shape_verdict(spark, sf_dir):
    """A-03: right / left / balanced by mean-to-median ratio; |skew| < 1."""
    return eda.shape(eda_frame(spark, sf_dir), SHAPE_COLS)


_FENCE_SQL = f"""f AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3,
  quantile_cont(price, 0.25) - {K.IQR_K} * (quantile_cont(price, 0.75) - quantile_cont(price, 0.25)) AS lower_fence,
  quantile_cont(price, 0.75) + {K.IQR_K} * (quantile_cont(price, 0.75) - quantile_cont(price, 0.25)) AS upper_fence FROM eda)"""


@query("a04_iqr_outliers", f"""{WITH_EDA},
{_FENCE_SQL},
c AS (SELECT f.q1, f.q3, f.lower_fence, f.upper_fence, count(CASE WHEN price < lower_fence OR price > upper_fence THEN 1 END) AS n_out, count(*) AS n
      FROM eda CROSS JOIN f GROUP BY f.q1, f.q3, f.lower_fence, f.upper_fence)
SELECT 'price' AS column_name, {R('q1', 'q1')}, {R('q3', 'q3')}, {R('lower_fence', 'lower_fence')}, {R('upper_fence', 'upper_fence')},
  {I('n_out', 'n_outliers')}, {R('n_out * 100.0 / n', 'outlier_pct')},
  CASE WHEN n_out * 100.0 / n < {K.OUTLIER_LOW_PCT} THEN 'low' WHEN n_out * 100.0 / n < {K.OUTLIER_MID_PCT} THEN 'moderate' ELSE 'high' END AS grade
FROM c""")
def a04_iqr_outliers(spark, sf_dir):
    """A-04: price outliers outside the 1.5·IQR fences."""
    return eda.iqr_outliers(eda_frame(spark, sf_dir), "price")


@query("a05_extreme_rows", f"""{WITH_EDA},
{_FENCE_SQL}
SELECT {KEYS_SQL}, {R('price', 'price')}, {R('mileage', 'mileage')}, {R('car_age_years', 'car_age_years')}, series
FROM eda CROSS JOIN f WHERE price > f.upper_fence
ORDER BY price DESC, order_key, line_number, part_key, supp_key LIMIT {K.EXTREME_ROWS}""")
def a05_extreme_rows(spark, sf_dir):
    """A-05: the five largest price outliers (top-k feature)."""
    return eda.extreme_rows(eda_frame(spark, sf_dir), "price", KEYS, ["price", "mileage", "car_age_years", "series"])


_CORR_SQL = f"""c AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, corr(price, {_x(c)}) AS r FROM eda" for c in EDA_COLS)})"""


@query("a06_target_correlation", f"""{WITH_EDA},
{_CORR_SQL}
SELECT column_name, {R('r', 'r')} FROM c""")
def a06_target_correlation(spark, sf_dir):
    """A-06: Pearson correlation of each numeric column with price."""
    return eda.target_correlation(eda_frame(spark, sf_dir), "price", EDA_COLS)


@query("a07_strong_predictors", f"""{WITH_EDA},
{_CORR_SQL},
s AS (SELECT * FROM c WHERE abs(r) > {K.STRONG_CORR}),
n AS (SELECT count(*) AS n_strong FROM s)
SELECT column_name, {R('r', 'r')}, {R('abs(r)', 'abs_r')}, {I('n_strong', 'n_strong')},
  CASE WHEN n_strong >= 3 THEN 'excellent' WHEN n_strong >= 1 THEN 'moderate' ELSE 'weak' END AS grade
FROM s CROSS JOIN n""")
def a07_strong_predictors(spark, sf_dir):
    """A-07: predictors with |r| > 0.3 and the overall grade."""
    return eda.strong_predictors(eda.target_correlation(eda_frame(spark, sf_dir), "price", EDA_COLS))


PAIR_COLS = ["price"] + EDA_COLS
_PAIRS = [(a, b) for i, a in enumerate(PAIR_COLS) for b in PAIR_COLS[i + 1:]]
_PAIRS_SQL = f"""p AS ({' UNION ALL '.join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({_x(a)}, {_x(b)}) AS r FROM eda" for a, b in _PAIRS)})"""


@query("a08_high_pairs", f"""{WITH_EDA},
{_PAIRS_SQL}
SELECT col_a, col_b, {R('r', 'r')} FROM p WHERE abs(r) > {K.HIGH_PAIR_CORR}""")
def a08_high_pairs(spark, sf_dir):
    """A-08: correlation-matrix pairs (upper triangle) with |r| > 0.9."""
    return eda.high_pairs(eda_frame(spark, sf_dir), PAIR_COLS)


TREND_X = ["mileage", "car_age_years"]


@query("a09_linear_trend", f"""{WITH_EDA}
{' UNION ALL '.join(f"SELECT '{x}' AS x_column, {R(f'regr_slope(price, {_x(x)})', 'slope')}, {R(f'regr_intercept(price, {_x(x)})', 'intercept')}, {R(f'regr_r2(price, {_x(x)})', 'r2')} FROM eda" for x in TREND_X)}""")
def a09_linear_trend(spark, sf_dir):
    """A-09: least-squares line of price on mileage and on age."""
    return eda.linear_trend(eda_frame(spark, sf_dir), "price", TREND_X)


def histogram_sql(src: str, col: str, bins: int = K.HIST_BINS) -> str:
    return f"""(WITH mm AS (SELECT min(CAST({col} AS DOUBLE)) AS lo, max(CAST({col} AS DOUBLE)) AS hi, (max(CAST({col} AS DOUBLE)) - min(CAST({col} AS DOUBLE))) / {bins} AS w FROM {src}),
cnt AS (SELECT coalesce(CAST(least(floor((CAST({col} AS DOUBLE) - mm.lo) / nullif(mm.w, 0)), {bins - 1}) AS BIGINT), 0) AS bin, count(*) AS n
        FROM {src} CROSS JOIN mm WHERE {col} IS NOT NULL GROUP BY 1)
SELECT '{col}' AS column_name, {I('g.range', 'bin')}, {R('mm.lo + g.range * mm.w', 'lower')}, {R('mm.lo + (g.range + 1) * mm.w', 'upper')},
  {I('coalesce(cnt.n, 0)', 'n')}
FROM range({bins}) g CROSS JOIN mm LEFT JOIN cnt ON cnt.bin = g.range)"""


@query("a10_histogram", f"""{WITH_EDA}
{histogram_sql('eda', 'price')} UNION ALL {histogram_sql('eda', 'price_log')}""")
def a10_histogram(spark, sf_dir):
    """A-10: 50 equal-width bins of price and of log price (empty bins kept)."""
    e = eda_frame(spark, sf_dir)
    return eda.histogram(e, "price").unionByName(eda.histogram(e, "price_log"))


_QQ_PROBS = [(i + 1) / 100 for i in range(99)]
_QQ_ROWS = ", ".join(f"({i + 1}, {p!r}::DOUBLE, {t!r}::DOUBLE)" for i, (p, t) in enumerate(zip(_QQ_PROBS, normal_quantiles(_QQ_PROBS))))


@query("a11_qq_points", f"""{WITH_EDA},
q AS (SELECT quantile_cont(price_log, [{', '.join(map(repr, _QQ_PROBS))}]) AS l FROM eda)
SELECT {R('t.p', 'p')}, {R('t.th', 'theoretical')}, {R('q.l[t.i]', 'sample')} FROM q CROSS JOIN (VALUES {_QQ_ROWS}) AS t(i, p, th)""")
def a11_qq_points(spark, sf_dir):
    """A-11: normal Q-Q points of log price (99-point probability grid)."""
    return eda.qq_points(eda_frame(spark, sf_dir), "price_log")


BOX_COLS = ["price", "mileage", "car_age_years", "engine_power"]


def _box_sql(c):
    x = _x(c)
    return f"""SELECT '{c}' AS column_name, {R('b.q1', 'q1')}, {R('b.median', 'median')}, {R('b.q3', 'q3')},
  {R(f'min(CASE WHEN {x} >= b.lo AND {x} <= b.hi THEN {x} END)', 'lower_whisker')},
  {R(f'max(CASE WHEN {x} >= b.lo AND {x} <= b.hi THEN {x} END)', 'upper_whisker')},
  {I(f'count(CASE WHEN {x} < b.lo OR {x} > b.hi THEN 1 END)', 'n_outliers')}
FROM eda CROSS JOIN (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median, quantile_cont({x}, 0.75) AS q3,
    quantile_cont({x}, 0.25) - {K.IQR_K} * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)) AS lo,
    quantile_cont({x}, 0.75) + {K.IQR_K} * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)) AS hi FROM eda) b
GROUP BY b.q1, b.median, b.q3"""


@query("a12_box_summary", f"""{WITH_EDA}
{' UNION ALL '.join(_box_sql(c) for c in BOX_COLS)}""")
def a12_box_summary(spark, sf_dir):
    """A-12: box-plot numbers (quartiles, whiskers inside the fences, outliers) per column."""
    return eda.box_summary(eda_frame(spark, sf_dir), BOX_COLS)


def _long_cat_sql(src="eda"):
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, price AS y FROM {src} WHERE {c} IS NOT NULL" for c in CATS)


@query("a13_group_stats", f"""{WITH_EDA},
l AS ({_long_cat_sql()})
SELECT feature, value, {R('avg(y)', 'mean')}, {R('stddev_samp(y)', 'std')}, {I('count(*)', 'n')} FROM l GROUP BY feature, value""")
def a13_group_stats(spark, sf_dir):
    """A-13: mean, std and count of price per fuel / car type / paint colour value."""
    return eda.group_stats(eda_frame(spark, sf_dir), CATS)


_ANOVA_SQL = f"""l AS ({_long_cat_sql()}),
g AS (SELECT feature, value, count(*) AS n, avg(y) AS m, var_samp(y) AS v FROM l GROUP BY feature, value),
t AS (SELECT feature, avg(y) AS grand FROM l GROUP BY feature),
s AS (SELECT g.feature, count(*) AS k, sum(n) AS n_total, sum(n * pow(m - grand, 2)) AS ssb, sum(coalesce((n - 1) * v, 0.0)) AS ssw
      FROM g JOIN t ON t.feature = g.feature GROUP BY g.feature)"""


@query("a14_anova", f"""{WITH_EDA},
{_ANOVA_SQL}
SELECT feature, {I('k', 'k')}, {I('n_total', 'n_total')}, {I('k - 1', 'df_between')}, {I('n_total - k', 'df_within')},
  {R('(ssb / (k - 1)) / nullif(ssw / (n_total - k), 0)', 'f_stat')} FROM s""")
def a14_anova(spark, sf_dir):
    """A-14: one-way ANOVA F of price across the values of each categorical column."""
    return eda.anova(eda_frame(spark, sf_dir), CATS)


@query("a14_anova_pvalue")
def a14_anova_pvalue(spark, sf_dir):
    """A-14: F-test p-value and significance level (pandas UDF on the 3-row result)."""
    return eda.anova_pvalue(eda.anova(eda_frame(spark, sf_dir), CATS))


@query("a15_model_readiness", f"""{WITH_EDA},
{_CORR_SQL},
{_PAIRS_SQL},
n AS (SELECT (SELECT count(*) FROM c WHERE abs(r) > {K.STRONG_CORR}) AS n_strong, (SELECT count(*) FROM p WHERE abs(r) > {K.HIGH_PAIR_CORR}) AS n_high)
SELECT {I('n_strong', 'n_strong')}, {I('n_high', 'n_high_pairs')}, n_strong >= 3 AND n_high = 0 AS ready FROM n""")
def a15_model_readiness(spark, sf_dir):
    """A-15: ready when there are >= 3 strong predictors and no highly correlated pair."""
    e = eda_frame(spark, sf_dir)
    ns = eda.target_correlation(e, "price", EDA_COLS).agg(F.count(F.when(F.abs("r") > K.STRONG_CORR, 1)).alias("n_strong"))
    nh = eda.high_pairs(e, PAIR_COLS).agg(F.count(F.lit(1)).alias("n_high_pairs"))
    j = ns.crossJoin(nh)
    return j.withColumn("ready", (F.col("n_strong") >= 3) & (F.col("n_high_pairs") == 0))


@query("a16_category_quartiles", f"""{WITH_EDA},
l AS ({_long_cat_sql()})
SELECT feature, value, {R('quantile_cont(y, 0.25)', 'q1')}, {R('quantile_cont(y, 0.5)', 'median')}, {R('quantile_cont(y, 0.75)', 'q3')},
  {I('count(*)', 'n')} FROM l GROUP BY feature, value""")
def a16_category_quartiles(spark, sf_dir):
    """A-16: price quartiles per category value."""
    return eda.category_quartiles(eda_frame(spark, sf_dir), CATS)
