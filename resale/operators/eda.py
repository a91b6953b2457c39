"""Exploratory statistics (A-01 ... A-16).

Per-column statistics are one wide aggregate (every column in one pass)
reshaped to long rows.  Quantiles are exact and bounded
(:mod:`resale.operators.quantiles`).  Histograms use
equal-width bins from a broadcast 1-row min/max frame, so the bin of a row
is a row-local expression and the counting is an ordinary grouped
aggregate.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resale.functions import constants as K
from resale.functions.exprs import adjusted_skewness
from resale.functions.stats import f_sf, normal_quantiles
from resale.operators import moments, quantiles


def per_column(df: DataFrame, columns: list[str], stats: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(column_name, stat...) rows from one aggregate over all columns."""
    aggs = [fn(F.col(c).cast("double")).alias(f"{c}__{s}") for c in columns for s, fn in stats.items()]
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{s}").alias(s) for s in stats]) for c in columns
    ])))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """A-01: distribution profile with IQR."""
    stats = {"n": lambda c: F.count(c), "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    s = per_column(df, columns, stats).join(quantiles.quartiles(df, columns), "column_name", "left")
    return s.select("column_name", "n", "mean", "median", "std", "min", "max", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))


def skewness(df: DataFrame, columns: list[str]) -> DataFrame:
    """A-02: bias-adjusted sample skewness per column."""
    return per_column(df, columns, {"skewness": adjusted_skewness})


def shape(df: DataFrame, columns: list[str]) -> DataFrame:
    """A-03: mean/median ratio verdict and |skew| < 1."""
    s = per_column(df, columns, {"mean": F.avg, "skewness": adjusted_skewness})
    s = s.join(quantiles.quartiles(df, columns).select("column_name", "median"), "column_name", "left")
    ratio = F.try_divide(F.col("mean"), F.col("median"))
    verdict = F.when(ratio > K.SHAPE_RIGHT, "right_skewed").when(ratio < K.SHAPE_LEFT, "left_skewed").otherwise("balanced")
    return s.select("column_name", ratio.alias("mean_median_ratio"), verdict.alias("shape"), (F.abs("skewness") < 1).alias("near_symmetric"))


def fences(df: DataFrame, col: str) -> DataFrame:
    """1-row frame: quartiles and the 1.5·IQR fences of ``col``."""
    s = quantiles.wide(df, {"q1": (col, 0.25), "q3": (col, 0.75)})
    iqr = F.col("q3") - F.col("q1")
    return s.select("q1", "q3", (F.col("q1") - K.IQR_K * iqr).alias("lower_fence"), (F.col("q3") + K.IQR_K * iqr).alias("upper_fence"))


def iqr_outliers(df: DataFrame, col: str) -> DataFrame:
    """A-04: outliers outside the fences: count, per cent, grade."""
    d = df.select(col).crossJoin(F.broadcast(fences(df, col)))  # one row
    out = (F.col(col) < F.col("lower_fence")) | (F.col(col) > F.col("upper_fence"))
    s = d.groupBy("q1", "q3", "lower_fence", "upper_fence").agg(F.count(F.when(out, 1)).alias("n_outliers"), F.count(F.lit(1)).alias("_n"))
    pct = F.try_divide(F.col("n_outliers") * 100.0, "_n")
    grade = F.when(pct < K.OUTLIER_LOW_PCT, "low").when(pct < K.OUTLIER_MID_PCT, "moderate").otherwise("high")
    return s.select(F.lit(col).alias("column_name"), "q1", "q3", "lower_fence", "upper_fence", "n_outliers", pct.alias("outlier_pct"), grade.alias("grade"))


def extreme_rows(df: DataFrame, col: str, keys: list[str], show: list[str], k: int = K.EXTREME_ROWS) -> DataFrame:
    """A-05: the k largest values above the upper fence (distributed top-k)."""
    d = df.crossJoin(F.broadcast(fences(df, col).select("upper_fence")))
    return d.where(F.col(col) > F.col("upper_fence")).orderBy(F.desc(col), *keys).limit(k).select(*keys, *show)


def target_correlation(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """A-06: Pearson correlation of every column with the target, pairwise-complete, one scan; null where one does not vary."""
    return moments.matrix(df, [(target, c) for c in columns]).select(F.col("col_b").alias("column_name"), "r")


def strong_predictors(corr: DataFrame) -> DataFrame:
    """A-07: |r| > 0.3, with the count and its grade (>= 3 excellent, >= 1 moderate)."""
    strong = corr.where(F.abs("r") > K.STRONG_CORR)
    n = strong.agg(F.count(F.lit(1)).alias("n_strong"))
    grade = F.when(F.col("n_strong") >= 3, "excellent").when(F.col("n_strong") >= 1, "moderate").otherwise("weak")
    return strong.crossJoin(F.broadcast(n)).select("column_name", "r", F.abs("r").alias("abs_r"), "n_strong", grade.alias("grade"))


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Upper triangle of the correlation matrix (pairwise-complete), one scan."""
    return moments.matrix(df, [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]).select("col_a", "col_b", "r")


def high_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """A-08: pairs with |r| > 0.9."""
    return correlation_pairs(df, columns).where(F.abs("r") > K.HIGH_PAIR_CORR)


def linear_trend(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """A-09: degree-1 least squares of y on each x (slope, intercept, R²)."""
    stats = {}
    aggs = []
    for x in xs:
        yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
        aggs += [F.regr_slope(yy, xx).alias(f"{x}__slope"), F.regr_intercept(yy, xx).alias(f"{x}__intercept"), F.regr_r2(yy, xx).alias(f"{x}__r2")]
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(x).alias("x_column"), F.col(f"{x}__slope").alias("slope"), F.col(f"{x}__intercept").alias("intercept"), F.col(f"{x}__r2").alias("r2"))
        for x in xs
    ])))


def histogram(df: DataFrame, col: str, bins: int = K.HIST_BINS) -> DataFrame:
    """A-10: equal-width histogram between min and max, last bin closed; empty bins kept."""
    spark = df.sparkSession
    mm = df.agg(F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi"))
    mm = mm.withColumn("_w", (F.col("_hi") - F.col("_lo")) / bins)
    d = df.select(col).where(F.col(col).isNotNull()).crossJoin(F.broadcast(mm))  # one row
    b = F.least(F.floor(F.try_divide(F.col(col) - F.col("_lo"), F.col("_w"))), F.lit(bins - 1))
    counts = d.groupBy(F.coalesce(b, F.lit(0)).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(bins).select(F.col("id").alias("bin")).crossJoin(F.broadcast(mm))  # fixed number of bins
    out = grid.join(counts, "bin", "left")
    return out.select(
        F.lit(col).alias("column_name"), "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lower"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("upper"), F.coalesce("n", F.lit(0)).alias("n"),
    )


def qq_points(df: DataFrame, col: str, n_points: int = 99) -> DataFrame:
    """A-11: sample quantiles on a fixed probability grid against standard-normal quantiles."""
    probs = [(i + 1) / (n_points + 1) for i in range(n_points)]
    theo = normal_quantiles(probs)
    grid = df.sparkSession.createDataFrame([(f"p{i}", p, t) for i, (p, t) in enumerate(zip(probs, theo))], "name string, p double, theoretical double")
    found = quantiles.long(df, {f"p{i}": (col, p) for i, p in enumerate(probs)})
    return found.join(F.broadcast(grid), "name").select("p", "theoretical", F.col("value").alias("sample"))  # one row per level


def box_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """A-12: five numbers (whiskers inside the fences) and outlier count per column."""
    quart = quantiles.quartiles(df, columns)
    iqr = F.col("q3") - F.col("q1")
    quart = quart.withColumns({"lo_f": F.col("q1") - K.IQR_K * iqr, "hi_f": F.col("q3") + K.IQR_K * iqr})
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns])))
    j = long.where(F.col("x").isNotNull()).join(F.broadcast(quart), "column_name")  # one row per column
    inside = (F.col("x") >= F.col("lo_f")) & (F.col("x") <= F.col("hi_f"))
    return j.groupBy("column_name", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("x"))).alias("lower_whisker"), F.max(F.when(inside, F.col("x"))).alias("upper_whisker"),
        F.count(F.when(~inside, 1)).alias("n_outliers"),
    )


def long_categories(df: DataFrame, cats: list[str], value: str) -> DataFrame:
    return df.select(F.col(value).alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cats
    ]))).where(F.col("value").isNotNull())


def group_stats(df: DataFrame, cats: list[str], target: str = "price") -> DataFrame:
    """A-13: mean, std, count of the target per category value (three columns in one pass)."""
    return long_categories(df, cats, target).groupBy("feature", "value").agg(
        F.avg("_y").alias("mean"), F.stddev_samp("_y").alias("std"), F.count(F.lit(1)).alias("n"))


def anova(df: DataFrame, cats: list[str], target: str = "price") -> DataFrame:
    """A-14: one-way ANOVA F per categorical column, from per-group n, mean and variance."""
    g = long_categories(df, cats, target).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_y").alias("m"), F.var_samp("_y").alias("v"))
    tot = long_categories(df, cats, target).groupBy("feature").agg(F.avg("_y").alias("grand"))
    j = g.join(F.broadcast(tot), "feature")  # one row per column
    s = j.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n_total"),
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("grand"), 2)).alias("ssb"),
        F.sum(F.coalesce((F.col("n") - 1) * F.col("v"), F.lit(0.0))).alias("ssw"),
    )
    dfb, dfw = F.col("k") - 1, F.col("n_total") - F.col("k")
    f = F.try_divide(F.try_divide("ssb", dfb), F.try_divide("ssw", dfw))
    return s.select("feature", "k", "n_total", dfb.alias("df_between"), dfw.alias("df_within"), f.alias("f_stat"))


@F.pandas_udf(T.DoubleType())
def _f_pvalue(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_sf(a, b, c) for a, b, c in zip(f, d1, d2)], dtype="float64")


def anova_pvalue(an: DataFrame) -> DataFrame:
    """A-14: p-value of F (pandas UDF on the small result, one row per column) and its level."""
    p = _f_pvalue(F.col("f_stat"), F.col("df_between").cast("double"), F.col("df_within").cast("double"))
    out = an.withColumn("p_value", p)
    lvl = F.when(F.col("p_value") < K.ANOVA_STRONG_P, "highly_significant").when(F.col("p_value") < K.ANOVA_WEAK_P, "significant").otherwise("not_significant")
    return out.withColumn("level", lvl)


def category_quartiles(df: DataFrame, cats: list[str], target: str = "price") -> DataFrame:
    """A-16: quartiles of the target per category value."""
    rows = long_categories(df, cats, target)
    n = rows.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumnRenamed("value", "category")
    q = quantiles.wide(rows, {"q1": ("_y", 0.25), "median": ("_y", 0.5), "q3": ("_y", 0.75)}, ["feature", "category"])
    q = q.withColumnRenamed("category", "value")
    return n.join(q, ["feature", "value"], "left").select("feature", "value", "q1", "median", "q3", "n")
