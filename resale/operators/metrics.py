"""Accuracy and business metrics (M-01 ... M-14).

Every metric is a single-pass aggregate over euro columns, so any grouping
(model, split, segment, month) works the same way and the aggregation is
partial on the map side (a hot group costs one partial row per task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resale.functions import constants as K


def _err(a: Column, p: Column) -> Column:
    return a - p


def mae(a: Column, p: Column) -> Column:
    """M-01."""
    return F.avg(F.abs(_err(a, p)))


def rmse(a: Column, p: Column) -> Column:
    """M-02."""
    return F.sqrt(F.avg(F.pow(_err(a, p), 2)))


def r2(a: Column, p: Column) -> Column:
    """M-03 (on log columns) / M-04 (on euro columns): 1 - SSres/SStot; null when the target is constant."""
    ss_tot = F.var_pop(a) * F.count(a)
    return F.when(ss_tot > 0, 1 - F.sum(F.pow(_err(a, p), 2)) / ss_tot)


def ape(a: Column, p: Column) -> Column:
    return F.abs(F.try_divide(_err(a, p), a)) * 100


def mape(a: Column, p: Column) -> Column:
    """M-05."""
    return F.avg(ape(a, p))


def tail_rate(a: Column, p: Column, limit: float = K.TAIL_APE) -> Column:
    """M-06: per cent of rows with APE above the limit (strict)."""
    return F.avg(F.coalesce(ape(a, p) > limit, F.lit(False)).cast("double")) * 100


def tc_ape(a: Column, p: Column, limit: float = K.TAIL_APE) -> Column:
    """M-07: mean APE among tail rows, 0 when there is none."""
    e = ape(a, p)
    return F.coalesce(F.avg(F.when(e > limit, e)), F.lit(0.0))


def tail_count(a: Column, p: Column, limit: float = K.TAIL_APE) -> Column:
    return F.count(F.when(ape(a, p) > limit, 1))


def all_metrics(
    df: DataFrame,
    group: list[str],
    actual_euro: str = "actual_euro",
    predicted_euro: str = "predicted_euro",
    actual_log: str = "price_log",
    predicted_log: str = "predicted_log",
) -> DataFrame:
    """M-08: the eight values in one aggregate, per group."""
    a, p = F.col(actual_euro), F.col(predicted_euro)
    al, pl = F.col(actual_log), F.col(predicted_log)
    return df.groupBy(*group).agg(
        mae(a, p).alias("mae"),
        rmse(a, p).alias("rmse"),
        r2(al, pl).alias("r2"),
        r2(a, p).alias("r2_price"),
        mape(a, p).alias("mape"),
        tail_rate(a, p).alias("tail_rate"),
        tc_ape(a, p).alias("tc_ape"),
        F.count(F.lit(1)).alias("total_samples"),
        tail_count(a, p).alias("tail_samples"),
    )


def metric_sums(df: DataFrame, group: list[str], actual_log: str = "price_log", predicted_log: str = "predicted_log") -> DataFrame:
    """Sums of which every metric of M-08 and M-10 is a function; sums of parts add up to the sums of the whole.

    Sums of squares are taken around fixed values near the data (``K.SUM_CENTER_LOG``,
    ``K.SUM_CENTER_EURO``), so that the variance does not lose its digits.
    """
    a, p, al, pl = F.col("actual_euro"), F.col("predicted_euro"), F.col(actual_log), F.col(predicted_log)
    e = ape(a, p)
    tail = F.coalesce(e > K.TAIL_APE, F.lit(False))
    ca, cl = a - K.SUM_CENTER_EURO, al - K.SUM_CENTER_LOG
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.abs(a - p)).alias("s_abs"), F.sum(F.pow(a - p, 2)).alias("s_sq"),
        F.sum(F.pow(al - pl, 2)).alias("s_sq_log"), F.sum(ca).alias("s_a"), F.sum(ca * ca).alias("s_aa"), F.sum(cl).alias("s_l"), F.sum(cl * cl).alias("s_ll"),
        F.count(e).alias("n_ape"), F.sum(e).alias("s_ape"), F.count(F.when(tail, 1)).alias("tail_samples"), F.sum(F.when(tail, e)).alias("s_tail"),
        F.count(F.when(p < a * K.UNDER_PRICED_RATIO, 1)).alias("under_priced"), F.count(F.when(p > a * K.OVER_PRICED_RATIO, 1)).alias("over_priced"),
    )


def from_sums(sums: DataFrame, group: list[str]) -> DataFrame:
    """M-08 and M-10 per group from any number of partial :func:`metric_sums` rows."""
    parts = [c for c in sums.columns if c not in group]
    t = sums.select(*group, *parts).groupBy(*group).agg(*[F.sum(c).alias(c) for c in parts if c not in ("batch_id",)])
    n = F.col("n")

    def r2_of(ss_res: str, total: str, squares: str) -> Column:
        ss_tot = F.col(squares) - F.col(total) * F.col(total) / n
        return F.when(ss_tot > 0, 1 - F.col(ss_res) / ss_tot)

    under, over = F.col("under_priced") * K.UNDER_PRICED_COST, F.col("over_priced") * (K.OVER_PRICED_DAYS * K.OVER_PRICED_COST_PER_DAY)
    return t.select(
        *group, (F.col("s_abs") / n).alias("mae"), F.sqrt(F.col("s_sq") / n).alias("rmse"),
        r2_of("s_sq_log", "s_l", "s_ll").alias("r2"), r2_of("s_sq", "s_a", "s_aa").alias("r2_price"),
        F.try_divide("s_ape", "n_ape").alias("mape"), (F.col("tail_samples") / n * 100).alias("tail_rate"),
        F.coalesce(F.try_divide("s_tail", "tail_samples"), F.lit(0.0)).alias("tc_ape"), n.alias("total_samples"), "tail_samples",
        "under_priced", "over_priced", under.cast("double").alias("under_cost"), over.cast("double").alias("over_cost"), (under + over).cast("double").alias("total_cost"),
    )


def targets_met(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """M-09: the six strict business-target checks and the all-met flag."""
    ops = {"<": lambda c, v: c < v, ">": lambda c, v: c > v}
    checks = {f"{m}_ok": F.coalesce(ops[op](F.col(m), F.lit(v)), F.lit(False)) for m, v, op in K.BUSINESS_TARGETS}
    out = metrics.select(*keys, *[c.alias(n) for n, c in checks.items()])
    all_ok = None
    for n in checks:
        all_ok = F.col(n) if all_ok is None else all_ok & F.col(n)
    return out.withColumn("all_targets_met", all_ok)


def mispricing(df: DataFrame, group: list[str], actual: str = "actual_euro", predicted: str = "predicted_euro") -> DataFrame:
    """M-10: under-priced (< 95 % of actual) and over-priced (> 105 %) cars and their cost."""
    a, p = F.col(actual), F.col(predicted)
    under = F.coalesce(p < a * K.UNDER_PRICED_RATIO, F.lit(False))
    over = F.coalesce(p > a * K.OVER_PRICED_RATIO, F.lit(False))
    over_cost = K.OVER_PRICED_DAYS * K.OVER_PRICED_COST_PER_DAY
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("cars"),
        F.count(F.when(under, 1)).alias("under_priced"),
        F.count(F.when(over, 1)).alias("over_priced"),
        (F.count(F.when(under, 1)) * K.UNDER_PRICED_COST).cast("double").alias("under_cost"),
        (F.count(F.when(over, 1)) * over_cost).cast("double").alias("over_cost"),
        (F.count(F.when(under, 1)) * K.UNDER_PRICED_COST + F.count(F.when(over, 1)) * over_cost).cast("double").alias("total_cost"),
    )


def interval(df: DataFrame, rmse_value: Column, predicted: str = "predicted_euro") -> DataFrame:
    """M-14: predicted euro ± z·RMSE, lower bound cut at 0, as a struct."""
    p = F.col(predicted)
    half = rmse_value * K.INTERVAL_Z
    return df.withColumn(
        "price_interval",
        F.struct(F.greatest(F.lit(0.0), p - half).alias("lower"), (p + half).alias("upper")),
    )
