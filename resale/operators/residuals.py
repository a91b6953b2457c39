"""Residual analysis (R-01 ... R-13) on a scored frame with R-01 columns.

Segments are a 4-row dimension (left join keeps empty segments); every
statistic is a grouped aggregate; worst rows are a distributed top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.operators import moments, quantiles


def summary(df: DataFrame) -> DataFrame:
    """R-02: count, actual range, residual mean and population std, median |residual|, mean APE, tail %."""
    median = quantiles.wide(df, {"abs_residual_median": ("abs_residual_euro", 0.5)})
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.min("actual_euro").alias("actual_min"), F.max("actual_euro").alias("actual_max"),
        F.avg("residual_euro").alias("residual_mean"), F.stddev_pop("residual_euro").alias("residual_std"),
        F.avg("ape").alias("ape_mean"),
        (F.avg(F.col("in_tail").cast("double")) * 100).alias("tail_pct"),
    ).crossJoin(median)  # one row each


def tail_vs_normal(df: DataFrame) -> DataFrame:
    """R-03: rows, share and mean APE of tail and normal rows (shares over all rows)."""
    g = df.groupBy("in_tail").agg(F.count(F.lit(1)).alias("n"), F.avg("ape").alias("ape_mean"))
    t = df.agg(F.count(F.lit(1)).alias("_t"))
    return g.crossJoin(F.broadcast(t)).select("in_tail", "n", F.try_divide(F.col("n") * 100.0, "_t").alias("share_pct"), "ape_mean")


def segment_label(col: str = "actual_euro"):
    """R-04: right-closed price segments (0,20k], (20k,35k], (35k,50k], (50k,inf)."""
    c = F.col(col)
    expr = None
    for _, label, lo, hi, _t in K.PRICE_SEGMENTS:
        cond = (c > lo) if hi is None else ((c > lo) & (c <= hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def segment_dim(spark) -> DataFrame:
    rows = [(o, lab, lo, hi, t) for o, lab, lo, hi, t in K.PRICE_SEGMENTS]
    return spark.createDataFrame(rows, "segment_order int, segment string, lower double, upper double, mae_target double")


def segment_stats(df: DataFrame) -> DataFrame:
    """R-05: per segment mean / median / std APE, tail rate (rounded to 2 then x100), count; empty segments kept."""
    d = df.select(segment_label().alias("segment"), "ape", "in_tail")
    medians = quantiles.wide(d, {"ape_median": ("ape", 0.5)}, ["segment"])
    s = d.groupBy("segment").agg(
        F.avg("ape").alias("ape_mean"), F.stddev_samp("ape").alias("ape_std"),
        F.avg(F.col("in_tail").cast("double")).alias("_tail"), F.count(F.lit(1)).alias("n"))
    dim = F.broadcast(segment_dim(df.sparkSession).select("segment_order", "segment"))  # 4 fixed rows
    j = dim.join(s, "segment", "left").join(medians, "segment", "left")
    return j.select(
        "segment_order", "segment",
        F.bround("ape_mean", 2).alias("ape_mean"), F.bround("ape_median", 2).alias("ape_median"), F.bround("ape_std", 2).alias("ape_std"),
        (F.bround("_tail", 2) * 100).alias("tail_rate"), F.coalesce("n", F.lit(0)).alias("n"),
    )


def worst_segment(seg: DataFrame) -> DataFrame:
    """R-06: segment with the highest tail rate; ties -> first in segment order; nulls skipped."""
    s = seg.where(F.col("tail_rate").isNotNull())
    return s.agg(F.max_by(F.struct("segment", "tail_rate"), F.struct(F.col("tail_rate"), -F.col("segment_order"))).alias("w")).select(
        "w.segment", "w.tail_rate")


def category_errors(df: DataFrame, cats: list[str]) -> DataFrame:
    """R-07: mean APE, tail rate and count per category value (three columns in one pass)."""
    long = df.select("ape", "in_tail", F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cats])))
    g = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.avg("ape").alias("ape_mean"), F.avg(F.col("in_tail").cast("double")).alias("_tail"), F.count(F.lit(1)).alias("n"))
    return g.select("feature", "value", F.bround("ape_mean", 2).alias("ape_mean"), (F.bround("_tail", 2) * 100).alias("tail_rate"), "n")


def error_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """R-09: correlation of continuous features with APE."""
    return moments.matrix(df, [(c, "ape") for c in columns]).select(F.col("col_a").alias("column_name"), F.col("r").alias("corr_with_ape"))


def worst(df: DataFrame, keys: list[str], k: int = K.WORST_ROWS) -> DataFrame:
    """R-10: the k rows with the highest APE (distributed top-k, full tie-break)."""
    return df.orderBy(F.desc("ape"), *keys).limit(k)


def heteroscedasticity(df: DataFrame) -> DataFrame:
    """R-11: |corr(predicted, |residual|)| > 0.3."""
    s = df.agg(moments.safe_corr("predicted_euro", "abs_residual_euro").alias("corr_pred_abs_residual"))
    return s.withColumn("heteroscedastic", F.coalesce(F.abs("corr_pred_abs_residual") > K.HETERO_CORR, F.lit(False)))


def recommendations(df: DataFrame) -> DataFrame:
    """R-12: rule rows (heteroscedasticity; worst segment tail > 50; overall tail > 50)."""
    h = heteroscedasticity(df)
    per = df.withColumn("segment", segment_label()).where(F.col("segment").isNotNull()).groupBy("segment")
    w = per.agg((F.avg(F.col("in_tail").cast("double")) * 100).alias("tail")).agg(F.max("tail").alias("_wt"))  # not rounded
    o = df.agg((F.avg(F.col("in_tail").cast("double")) * 100).alias("_ot"))
    j = h.crossJoin(w).crossJoin(o)
    rules = [
        ("heteroscedasticity", F.col("heteroscedastic")),
        ("worst_segment", F.coalesce(F.col("_wt") > K.PROBLEM_TAIL_PCT, F.lit(False))),
        ("overall_tail", F.coalesce(F.col("_ot") > K.PROBLEM_TAIL_PCT, F.lit(False))),
    ]
    return j.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), c.alias("triggered")) for n, c in rules])))
