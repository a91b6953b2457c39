"""Queries: drift monitoring (D-*) and health tier (M-13).

Baseline = train split, current = test split, model = default baseline model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.operators import metrics as M
from resale.operators import monitor as MON
from resale.plans import prepared as P
from resale.plans.oracle_base import WITH_SCORED
from resale.plans.q_metrics import SEGMENT_DIM_SQL, SEGMENT_SQL, segment_dim, segment_label
from resale.plans.registry import query
from resale.plans.sqlhelp import I, R
from resale.sources.tables import table

SHIFTS = [("mileage", "mileage", K.MILEAGE_SHIFT), ("actual_price", "actual_euro", K.PRICE_SHIFT), ("prediction", "predicted_euro", K.PREDICTION_SHIFT)]
WITH_MON = f"""{WITH_SCORED},
mon AS (SELECT * FROM scored WHERE model_id = '{K.DEFAULT_MODEL}')"""


def mon_frame(spark, sf_dir):
    return P.scored(spark, sf_dir, models=[K.DEFAULT_MODEL])


PERIOD = {"baseline": "train", "current": "test"}


def drift_profile(spark, sf_dir):
    """The profile of every split, written once from one scan of the scored rows; the bins lie between the price
    floor and cap, which are the lowest and highest price of the train rows (they are clipped to them)."""
    def build():
        edges = P.learned_params(spark, sf_dir).select(F.col("price_floor").alias("_lo"), F.col("price_cap").alias("_hi"), ((F.col("price_cap") - F.col("price_floor")) / K.HIST_BINS).alias("_w"))
        rows = mon_frame(spark, sf_dir)
        values = {**{n: c for n, c, _ in SHIFTS}, "abs_residual": "abs_residual_euro"}
        return MON.profile(rows, "data_split", edges, "price", values, {"tail": "in_tail"}, segment_label("actual_euro"), {"sale": "sold_at"}).coalesce(1)

    return P.materialize(spark, "drift-profile", sf_dir, build)


def _per_period(profiles):
    """One row: model age, MAE, safe-zone share and rows of the splits."""
    t = MON.merge_profiles(profiles, ["period"])
    safe = 100 - F.try_divide(F.col("tail__true") * 100.0, "n")
    of = lambda split, c: F.max(F.when(F.col("period") == split, c))
    return t.agg(
        F.datediff(of("test", F.col("sale__last")), of("train", F.col("sale__last"))).alias("age"),
        of("val", MON.mean_of("abs_residual")).alias("val_mae"), of("test", MON.mean_of("abs_residual")).alias("test_mae"),
        F.try_divide(of("test", F.col("n")), of("train", F.col("n"))).alias("new_share"), of("val", safe).alias("val_safe"), of("test", safe).alias("test_safe"),
    )


def _shift_sql():
    parts = []
    for n, c, lim in SHIFTS:
        parts.append(f"""SELECT '{n}' AS metric, avg(CASE WHEN data_split = 'train' THEN {c} END) AS baseline,
  avg(CASE WHEN data_split = 'test' THEN {c} END) AS current, {lim * 100} AS limit_pct FROM mon""")
    return " UNION ALL ".join(parts)


_SHIFT_CTE = f"""sh AS ({_shift_sql()}),
shift AS (SELECT metric, baseline, current, (current - baseline) / baseline * 100 AS shift_pct, limit_pct,
            abs((current - baseline) / baseline * 100) > limit_pct AS alarm FROM sh)"""


@query("d01_mean_shift", f"""{WITH_MON},
{_SHIFT_CTE}
SELECT metric, {R('baseline', 'baseline')}, {R('current', 'current')}, {R('shift_pct', 'shift_pct')}, {R('limit_pct', 'limit_pct')}, alarm FROM shift""")
def d01_mean_shift(spark, sf_dir):
    """D-01: mean shift of mileage (±30 %), actual price and prediction (±20 %) against the baseline."""
    return MON.profile_shift(drift_profile(spark, sf_dir), *PERIOD.values(), {n: v for n, _, v in SHIFTS})


_KL_CTE = f"""mm AS (SELECT min(price) AS lo, max(price) AS hi, (max(price) - min(price)) / {K.HIST_BINS} AS w FROM mon WHERE data_split = 'train'),
binned AS (SELECT data_split, CAST(greatest(0, least(coalesce(floor((price - mm.lo) / nullif(mm.w, 0)), 0), {K.HIST_BINS - 1})) AS BIGINT) AS bin
           FROM mon CROSS JOIN mm WHERE data_split IN ('train', 'test') AND price IS NOT NULL),
cnt AS (SELECT bin, count(CASE WHEN data_split = 'train' THEN 1 END) AS nb, count(CASE WHEN data_split = 'test' THEN 1 END) AS nc FROM binned GROUP BY bin),
tot AS (SELECT sum(nb) AS tb, sum(nc) AS tc FROM cnt),
kl AS (SELECT sum((coalesce(cnt.nb * 1.0 / tot.tb, 0.0) + {K.KL_EPS}) * ln((coalesce(cnt.nb * 1.0 / tot.tb, 0.0) + {K.KL_EPS}) / (coalesce(cnt.nc * 1.0 / tot.tc, 0.0) + {K.KL_EPS}))) AS kl
       FROM range({K.HIST_BINS}) g LEFT JOIN cnt ON cnt.bin = g.range CROSS JOIN tot)"""


@query("d02_kl_divergence", f"""{WITH_MON},
{_KL_CTE}
SELECT {R('kl', 'kl')}, CASE WHEN kl < {K.KL_OK} THEN 'ok' WHEN kl <= {K.KL_RETRAIN} THEN 'watch' ELSE 'retrain' END AS level FROM kl""")
def d02_kl_divergence(spark, sf_dir):
    """D-02: KL divergence of the price histogram, test against train bins."""
    return MON.profile_kl(drift_profile(spark, sf_dir), *PERIOD.values())


@query("d03_unknown_key_alarm", f"""{WITH_SCORED},
seen AS (SELECT DISTINCT model_key FROM processed WHERE data_split = 'train' AND model_key IS NOT NULL),
cur AS (SELECT s.model_key IS NULL AS unknown FROM processed p LEFT JOIN seen s ON s.model_key = p.model_key WHERE p.data_split = 'test')
SELECT {R('count(CASE WHEN unknown THEN 1 END) * 100.0 / count(*)', 'unknown_pct')},
  count(CASE WHEN unknown THEN 1 END) * 100.0 / count(*) > {K.UNKNOWN_KEY_ALERT} AS alarm FROM cur""")
def d03_unknown_key_alarm(spark, sf_dir):
    """D-03: share of test rows with a model key unseen in train; alarm above 10 %."""
    from resale.operators.encoders import unknown_key_share

    p = P.processed_rows(spark, sf_dir)
    u = unknown_key_share(p.where(F.col("data_split") == "test"), p.where(F.col("data_split") == "train"))
    return u.select("unknown_pct", (F.col("unknown_pct") > K.UNKNOWN_KEY_ALERT).alias("alarm"))


@query("d04_weekly_drift", f"""WITH w AS (
  SELECT event_type, time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS ws, count(*) AS n, avg(value) AS mean_value
  FROM events GROUP BY 1, 2),
b AS (SELECT event_type, avg(value) AS base FROM events GROUP BY 1)
SELECT w.event_type, strftime(w.ws, '%Y-%m-%d %H:%M:%S') AS window_start, {I('w.n', 'n')}, {R('w.mean_value', 'mean_value')},
  {R('b.base', 'baseline_mean')}, {R('(w.mean_value - b.base) / b.base * 100', 'shift_pct')},
  CASE WHEN abs((w.mean_value - b.base) / b.base * 100) < {K.WEEKLY_SHIFT_WARN} THEN 'stable'
       WHEN abs((w.mean_value - b.base) / b.base * 100) < {K.WEEKLY_SHIFT_ALERT} THEN 'warning' ELSE 'alert' END AS level
FROM w JOIN b ON b.event_type = w.event_type""")
def d04_weekly_drift(spark, sf_dir):
    """D-04: weekly mean of the event value per event type against its overall mean (7-day tumbling windows)."""
    ev = table(spark, sf_dir, "events", ["ts", "event_type", "value"])
    return MON.weekly_drift(ev)


def _retrain_sql():
    return f"""{WITH_MON},
{_SHIFT_CTE},
{_KL_CTE},
s AS (SELECT
  datediff('day', max(CASE WHEN data_split = 'train' THEN CAST(sold_at AS DATE) END), max(CASE WHEN data_split = 'test' THEN CAST(sold_at AS DATE) END)) AS model_age_days,
  avg(CASE WHEN data_split = 'val' THEN abs_residual_euro END) AS val_mae, avg(CASE WHEN data_split = 'test' THEN abs_residual_euro END) AS test_mae,
  count(CASE WHEN data_split = 'test' THEN 1 END) * 1.0 / count(CASE WHEN data_split = 'train' THEN 1 END) AS new_share,
  100 - avg(CASE WHEN data_split = 'val' THEN CAST(in_tail AS DOUBLE) END) * 100 AS val_safe,
  100 - avg(CASE WHEN data_split = 'test' THEN CAST(in_tail AS DOUBLE) END) * 100 AS test_safe
  FROM mon),
f AS (SELECT s.model_age_days > {K.MODEL_AGE_DAYS} AS old_model,
  (s.test_mae - s.val_mae) / s.val_mae > {K.MAE_DEGRADE} AS mae_degraded,
  kl.kl > {K.KL_RETRAIN} AS distribution_shift,
  (SELECT abs(shift_pct) FROM shift WHERE metric = 'prediction') > {K.PREDICTION_SHIFT * 100} AS prediction_shift,
  s.new_share > {K.NEW_DATA_SHARE} AS enough_new_data,
  s.val_safe - s.test_safe >= {K.SAFE_ZONE_DROP} AS safe_zone_drop
  FROM s CROSS JOIN kl)
SELECT old_model, mae_degraded, distribution_shift, prediction_shift, enough_new_data, safe_zone_drop,
  {I('CAST(old_model AS INT) + CAST(mae_degraded AS INT) + CAST(distribution_shift AS INT) + CAST(prediction_shift AS INT) + CAST(enough_new_data AS INT) + CAST(safe_zone_drop AS INT)', 'n_triggered')},
  CAST(old_model AS INT) + CAST(mae_degraded AS INT) + CAST(distribution_shift AS INT) + CAST(prediction_shift AS INT) + CAST(enough_new_data AS INT) + CAST(safe_zone_drop AS INT) >= 2 AS retrain
FROM f"""


@query("d05_retrain_decision", _retrain_sql())
def d05_retrain_decision(spark, sf_dir):
    """D-05: retrain when at least 2 of 6 triggers fire (age, MAE, KL, prediction shift, new data, safe zone)."""
    prof = drift_profile(spark, sf_dir)
    s = _per_period(prof)
    kl = MON.profile_kl(prof, *PERIOD.values()).select("kl")
    shift = MON.profile_shift(prof, *PERIOD.values(), {n: v for n, _, v in SHIFTS}).where(F.col("metric") == "prediction").select(F.abs("shift_pct").alias("_ps"))
    j = s.crossJoin(kl).crossJoin(shift)  # all one-row frames
    flags = {
        "old_model": F.col("age") > K.MODEL_AGE_DAYS,
        "mae_degraded": F.try_divide(F.col("test_mae") - F.col("val_mae"), "val_mae") > K.MAE_DEGRADE,
        "distribution_shift": F.col("kl") > K.KL_RETRAIN,
        "prediction_shift": F.col("_ps") > K.PREDICTION_SHIFT * 100,
        "enough_new_data": F.col("new_share") > K.NEW_DATA_SHARE,
        "safe_zone_drop": F.col("val_safe") - F.col("test_safe") >= K.SAFE_ZONE_DROP,
    }
    out = j.select(*[c.alias(n) for n, c in flags.items()])
    n = sum(F.col(c).cast("int") for c in flags)
    return out.withColumn("n_triggered", n).withColumn("retrain", F.col("n_triggered") >= 2)


def _health_sql():
    return f"""{WITH_MON},
{_KL_CTE},
t AS (SELECT avg(abs_residual_euro) AS mae, 100 - avg(CAST(in_tail AS DOUBLE)) * 100 AS safe_zone FROM mon WHERE data_split = 'test'),
g AS (SELECT {SEGMENT_SQL} AS segment, avg(abs_residual_euro) AS mae FROM mon WHERE data_split = 'test' GROUP BY 1),
so AS (SELECT max((g.mae - sd.mae_target) / sd.mae_target * 100) AS seg_over FROM g JOIN {SEGMENT_DIM_SQL} ON sd.segment = g.segment),
lv AS (SELECT t.mae, t.safe_zone, so.seg_over, kl.kl,
  CASE WHEN t.mae < {K.HEALTH_MAE[0]} THEN 0 WHEN t.mae <= {K.HEALTH_MAE[1]} THEN 1 ELSE 2 END AS mae_level,
  CASE WHEN t.safe_zone > {K.HEALTH_SAFE_ZONE[0]} THEN 0 WHEN t.safe_zone >= {K.HEALTH_SAFE_ZONE[1]} THEN 1 ELSE 2 END AS safe_zone_level,
  CASE WHEN so.seg_over < {K.HEALTH_SEGMENT_OVER[0]} THEN 0 WHEN so.seg_over <= {K.HEALTH_SEGMENT_OVER[1]} THEN 1 ELSE 2 END AS segment_level,
  CASE WHEN kl.kl < {K.HEALTH_KL[0]} THEN 0 WHEN kl.kl <= {K.HEALTH_KL[1]} THEN 1 ELSE 2 END AS kl_level
  FROM t CROSS JOIN so CROSS JOIN kl)
SELECT {R('mae', 'mae')}, {R('safe_zone', 'safe_zone')}, {R('seg_over', 'worst_segment_over_pct')}, {R('kl', 'kl')},
  {I('mae_level', 'mae_level')}, {I('safe_zone_level', 'safe_zone_level')}, {I('segment_level', 'segment_level')}, {I('kl_level', 'kl_level')},
  CASE greatest(mae_level, safe_zone_level, segment_level, kl_level) WHEN 0 THEN 'healthy' WHEN 1 THEN 'attention' ELSE 'immediate_action' END AS tier
FROM lv"""


@query("m13_health_tier", _health_sql())
def m13_health_tier(spark, sf_dir):
    """M-13: health tier from MAE, safe zone, worst segment over target and KL; the worst level wins."""
    prof = drift_profile(spark, sf_dir)
    t = _per_period(prof).select(F.col("test_mae").alias("mae"), F.col("test_safe").alias("safe_zone"))
    g = MON.merge_profiles(prof.where(F.col("period") == "test"), ["segment"]).select("segment", MON.mean_of("abs_residual").alias("_m"))
    so = g.join(F.broadcast(segment_dim(spark).select("segment", "mae_target")), "segment").agg(
        F.max(F.try_divide(F.col("_m") - F.col("mae_target"), "mae_target") * 100).alias("worst_segment_over_pct"))
    kl = MON.profile_kl(prof, *PERIOD.values()).select("kl")
    j = t.crossJoin(so).crossJoin(kl)
    lv = {
        "mae_level": MON.level_of(F.col("mae"), *K.HEALTH_MAE),
        "safe_zone_level": MON.level_of(F.col("safe_zone"), *K.HEALTH_SAFE_ZONE, higher_is_better=True),
        "segment_level": MON.level_of(F.col("worst_segment_over_pct"), *K.HEALTH_SEGMENT_OVER),
        "kl_level": MON.level_of(F.col("kl"), *K.HEALTH_KL),
    }
    out = j.select("mae", "safe_zone", "worst_segment_over_pct", "kl", *[c.alias(n) for n, c in lv.items()])
    worst = F.greatest(*[F.col(n) for n in lv])
    return out.withColumn("tier", F.when(worst == 0, "healthy").when(worst == 1, "attention").otherwise("immediate_action"))
