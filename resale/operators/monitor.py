"""Drift monitoring (D-01 ... D-05) and the health tier (M-13).

A profile holds, per period, bin and segment, counts, sums and squares; it is
written once and adds up with the profiles of other periods.  Alarms read
profiles, never rows.  Bin edges are fixed by the baseline (a 1-row frame) and
the bins are a fixed grid, so both histograms line up without a full outer join
of unbounded keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resale.functions import constants as K


def mean_shift(base: DataFrame, cur: DataFrame, metrics: list[tuple[str, str, float]]) -> DataFrame:
    """D-01: per metric (name, column, limit) the baseline and current means, shift % and alarm."""
    b = base.agg(*[F.avg(c).alias(n) for n, c, _ in metrics])
    c = cur.agg(*[F.avg(col).alias(n) for n, col, _ in metrics])
    bl = b.unpivot([], [n for n, _, _ in metrics], "metric", "baseline")
    cl = c.unpivot([], [n for n, _, _ in metrics], "metric", "current")
    spark = base.sparkSession
    lim = spark.createDataFrame([(n, float(v) * 100) for n, _, v in metrics], "metric string, limit_pct double")
    j = bl.join(cl, "metric").join(F.broadcast(lim), "metric")
    shift = F.try_divide(F.col("current") - F.col("baseline"), "baseline") * 100
    return j.select("metric", "baseline", "current", shift.alias("shift_pct"), "limit_pct", (F.abs(shift) > F.col("limit_pct")).alias("alarm"))


PROFILE_KEYS = ["period", "bin", "segment"]


def bin_edges(df: DataFrame, col: str, bins: int = K.HIST_BINS) -> DataFrame:
    """1-row frame with the lowest and highest value and the width of equal bins between them."""
    mm = df.agg(F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi"))
    return mm.withColumn("_w", (F.col("_hi") - F.col("_lo")) / bins)


def profile(df: DataFrame, period: str, edges: DataFrame, col: str, values: dict[str, str], flags: dict[str, str], segment=None, dates: dict[str, str] | None = None, bins: int = K.HIST_BINS) -> DataFrame:
    """A mergeable drift profile: per period, bin of ``col`` and segment, the rows, the numbers, sums and squares of
    ``values`` (name -> column), the rows of ``flags`` that are true and the latest of ``dates``.

    One scan with partial sums per task; the table has at most periods x (bins + 1) x segments rows.  Profiles of
    parts, or of further periods over the same edges, are added up by :func:`merge_profiles`; every alarm reads them.
    """
    raw = F.floor(F.try_divide(F.col(col) - F.col("_lo"), F.col("_w")))
    number = F.when(F.col(col).isNotNull(), F.greatest(F.lit(0), F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1))).cast("long"))
    rows = df.crossJoin(F.broadcast(edges))  # one row
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, c in values.items():
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{name}__n"), F.sum(x).alias(f"{name}__sum"), F.sum(x * x).alias(f"{name}__squares")]
    aggs += [F.count(F.when(F.col(c), 1)).alias(f"{name}__true") for name, c in flags.items()]
    aggs += [F.max(F.to_date(c)).alias(f"{name}__last") for name, c in (dates or {}).items()]
    return rows.groupBy(F.col(period).alias("period"), number.alias("bin"), (F.lit(None).cast("string") if segment is None else segment).alias("segment")).agg(*aggs)


def merge_profiles(profiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Profiles added up over everything but ``by`` (default: the keys of a profile)."""
    by = PROFILE_KEYS if by is None else by
    parts = [c for c in profiles.columns if c not in PROFILE_KEYS]
    return profiles.groupBy(*by).agg(*[(F.max(c) if c.endswith("__last") else F.sum(c)).alias(c) for c in parts])


def period_rows(profiles: DataFrame, baseline: str, current: str) -> DataFrame:
    return profiles.where(F.col("period").isin(baseline, current))


def mean_of(name: str):
    """Mean of a profiled value (an expression over merged profiles)."""
    return F.try_divide(F.col(f"{name}__sum"), F.col(f"{name}__n"))


def profile_shift(profiles: DataFrame, baseline: str, current: str, limits: dict[str, float]) -> DataFrame:
    """D-01 from profiles: baseline and current mean, shift % and alarm per value."""
    rows = merge_profiles(period_rows(profiles, baseline, current), ["period"])
    wide = rows.agg(*[F.max(F.when(F.col("period") == p, mean_of(n))).alias(f"{n}__{k}") for n in limits for k, p in (("b", baseline), ("c", current))])
    long = wide.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"{n}__b").alias("baseline"), F.col(f"{n}__c").alias("current"), F.lit(v * 100).alias("limit_pct")) for n, v in limits.items()])))
    shift = F.try_divide(F.col("current") - F.col("baseline"), "baseline") * 100
    return long.select("metric", "baseline", "current", shift.alias("shift_pct"), "limit_pct", (F.abs(shift) > F.col("limit_pct")).alias("alarm"))


def profile_kl(profiles: DataFrame, baseline: str, current: str, bins: int = K.HIST_BINS, eps: float = K.KL_EPS) -> DataFrame:
    """D-02 from profiles: KL(baseline || current) over the profile's bins with epsilon smoothing."""
    rows = merge_profiles(period_rows(profiles, baseline, current).where(F.col("bin").isNotNull()), ["period", "bin"])
    counts = rows.groupBy("bin").agg(F.sum(F.when(F.col("period") == baseline, F.col("n"))).alias("_b"), F.sum(F.when(F.col("period") == current, F.col("n"))).alias("_c"))
    totals = counts.agg(F.sum("_b").alias("_tb"), F.sum("_c").alias("_tc"))
    grid = profiles.sparkSession.range(bins).select(F.col("id").alias("bin"))  # fixed number of bins
    j = grid.join(counts, "bin", "left").crossJoin(F.broadcast(totals))
    p = F.coalesce(F.try_divide("_b", "_tb"), F.lit(0.0)) + eps
    q = F.coalesce(F.try_divide("_c", "_tc"), F.lit(0.0)) + eps
    s = j.agg(F.sum(p * F.log(p / q)).alias("kl"))
    lvl = F.when(F.col("kl") < K.KL_OK, "ok").when(F.col("kl") <= K.KL_RETRAIN, "watch").otherwise("retrain")
    return s.select("kl", lvl.alias("level"))


def kl_divergence(base: DataFrame, cur: DataFrame, col: str, bins: int = K.HIST_BINS, eps: float = K.KL_EPS) -> DataFrame:
    """D-02 of two tables: their profiles over the baseline's bins, then :func:`profile_kl`."""
    edges = bin_edges(base, col, bins)
    both = base.select(col).withColumn("_period", F.lit("b")).unionByName(cur.select(col).withColumn("_period", F.lit("c")))
    return profile_kl(profile(both, "_period", edges, col, {}, {}, bins=bins), "b", "c", bins, eps)


def weekly_drift(events: DataFrame, ts: str = "ts", value: str = "value", by: str = "event_type") -> DataFrame:
    """D-04: weekly (7-day tumbling window) mean per group against the group's overall mean."""
    w = events.groupBy(by, F.window(ts, "7 days").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"))
    base = events.groupBy(by).agg(F.avg(value).alias("_base"))
    j = w.join(base, by)  # one row per group
    shift = F.try_divide(F.col("mean_value") - F.col("_base"), "_base") * 100
    lvl = F.when(F.abs(shift) < K.WEEKLY_SHIFT_WARN, "stable").when(F.abs(shift) < K.WEEKLY_SHIFT_ALERT, "warning").otherwise("alert")
    return j.select(
        by, F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n", "mean_value",
        F.col("_base").alias("baseline_mean"), shift.alias("shift_pct"), lvl.alias("level"),
    )


def level_of(value, healthy, attention, higher_is_better=False):
    """0 healthy / 1 attention / 2 immediate for a value against two limits."""
    if higher_is_better:
        return F.when(value > healthy, 0).when(value >= attention, 1).otherwise(2)
    return F.when(value < healthy, 0).when(value <= attention, 1).otherwise(2)
