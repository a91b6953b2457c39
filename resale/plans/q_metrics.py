"""Queries: accuracy and business metrics (M-*), on the baseline predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.operators import metrics as M
from resale.plans import prepared as P
from resale.plans.oracle_base import WITH_SCORED
from resale.plans.registry import query
from resale.plans.sqlhelp import I, R

GROUP = ["model_id", "data_split"]

_METRICS_SQL = f"""{WITH_SCORED},
m AS (
  SELECT model_id, data_split,
    avg(abs(actual_euro - predicted_euro)) AS mae,
    sqrt(avg(pow(actual_euro - predicted_euro, 2))) AS rmse,
    CASE WHEN var_pop(price_log) * count(price_log) > 0 THEN 1 - sum(pow(price_log - predicted_log, 2)) / (var_pop(price_log) * count(price_log)) END AS r2,
    CASE WHEN var_pop(actual_euro) * count(actual_euro) > 0 THEN 1 - sum(pow(actual_euro - predicted_euro, 2)) / (var_pop(actual_euro) * count(actual_euro)) END AS r2_price,
    avg(ape) AS mape,
    avg(CAST(coalesce(ape > 5.0, false) AS DOUBLE)) * 100 AS tail_rate,
    coalesce(avg(CASE WHEN ape > 5.0 THEN ape END), 0.0) AS tc_ape,
    count(*) AS total_samples,
    count(CASE WHEN ape > 5.0 THEN 1 END) AS tail_samples
  FROM scored GROUP BY model_id, data_split
)"""


def metrics_frame(spark, sf_dir):
    return M.all_metrics(P.scored(spark, sf_dir), GROUP)


@query("m08_all_metrics", f"""{_METRICS_SQL}
SELECT model_id, data_split, {R('mae', 'mae')}, {R('rmse', 'rmse')}, {R('r2', 'r2')}, {R('r2_price', 'r2_price')},
  {R('mape', 'mape')}, {R('tail_rate', 'tail_rate')}, {R('tc_ape', 'tc_ape')}, {I('total_samples', 'total_samples')},
  {I('tail_samples', 'tail_samples')}
FROM m""")
def m08_all_metrics(spark, sf_dir):
    """M-08: all eight metrics per model and split in one aggregate."""
    return metrics_frame(spark, sf_dir)


def _single(name, col_expr_spark, sql_expr):
    def q(spark, sf_dir):
        a, p = F.col("actual_euro"), F.col("predicted_euro")
        return P.scored(spark, sf_dir).groupBy(*GROUP).agg(col_expr_spark(a, p).alias("value"))

    q.__doc__ = f"{name[:3].upper().replace('M', 'M-')}: {name[4:]} per model and split."
    return query(name, f"""{WITH_SCORED}
SELECT model_id, data_split, {R(sql_expr, 'value')} FROM scored GROUP BY model_id, data_split""")(q)


_single("m01_mae", M.mae, "avg(abs(actual_euro - predicted_euro))")
_single("m02_rmse", M.rmse, "sqrt(avg(pow(actual_euro - predicted_euro, 2)))")
_single(
    "m04_r2_price", M.r2,
    "CASE WHEN var_pop(actual_euro) * count(actual_euro) > 0 THEN 1 - sum(pow(actual_euro - predicted_euro, 2)) / (var_pop(actual_euro) * count(actual_euro)) END",
)
_single("m05_mape", M.mape, "avg(ape)")
_single("m06_tail_rate", M.tail_rate, "avg(CAST(coalesce(ape > 5.0, false) AS DOUBLE)) * 100")


@query("m03_r2_log", f"""{WITH_SCORED}
SELECT model_id, data_split,
  {R('CASE WHEN var_pop(price_log) * count(price_log) > 0 THEN 1 - sum(pow(price_log - predicted_log, 2)) / (var_pop(price_log) * count(price_log)) END', 'value')}
FROM scored GROUP BY model_id, data_split""")
def m03_r2_log(spark, sf_dir):
    """M-03: R² on the log scale."""
    return P.scored(spark, sf_dir).groupBy(*GROUP).agg(M.r2(F.col("price_log"), F.col("predicted_log")).alias("value"))


@query("m07_tc_ape", f"""{WITH_SCORED}
SELECT model_id, data_split, {R('coalesce(avg(CASE WHEN ape > 5.0 THEN ape END), 0.0)', 'tc_ape')},
  {I('count(*)', 'total_samples')}, {I('count(CASE WHEN ape > 5.0 THEN 1 END)', 'tail_samples')}
FROM scored GROUP BY model_id, data_split""")
def m07_tc_ape(spark, sf_dir):
    """M-07: tail-conditional APE with total and tail counts."""
    a, p = F.col("actual_euro"), F.col("predicted_euro")
    return P.scored(spark, sf_dir).groupBy(*GROUP).agg(
        M.tc_ape(a, p).alias("tc_ape"), F.count(F.lit(1)).alias("total_samples"), M.tail_count(a, p).alias("tail_samples")
    )


_TARGET_SQL = ", ".join(
    f"coalesce({m} {op} {v}, false) AS {m}_ok" for m, v, op in K.BUSINESS_TARGETS
)
_ALL_OK_SQL = " AND ".join(f"coalesce({m} {op} {v}, false)" for m, v, op in K.BUSINESS_TARGETS)


@query("m09_targets_met", f"""{_METRICS_SQL}
SELECT model_id, data_split, {_TARGET_SQL}, ({_ALL_OK_SQL}) AS all_targets_met FROM m""")
def m09_targets_met(spark, sf_dir):
    """M-09: strict business-target checks per model and split."""
    return M.targets_met(metrics_frame(spark, sf_dir), GROUP)


@query("m10_mispricing_cost", f"""{WITH_SCORED},
c AS (
  SELECT model_id, year(CAST(sold_at AS DATE)) AS sale_year, month(CAST(sold_at AS DATE)) AS sale_month,
    count(*) AS cars,
    count(CASE WHEN predicted_euro < actual_euro * 0.95 THEN 1 END) AS under_priced,
    count(CASE WHEN predicted_euro > actual_euro * 1.05 THEN 1 END) AS over_priced
  FROM scored WHERE data_split = 'test'
  GROUP BY ROLLUP (model_id, year(CAST(sold_at AS DATE)), month(CAST(sold_at AS DATE)))
)
SELECT model_id, CASE WHEN sale_year IS NULL THEN 'model' WHEN sale_month IS NULL THEN 'year' ELSE 'month' END AS level,
  {I('coalesce(sale_year, 0)', 'sale_year')}, {I('coalesce(sale_month, 0)', 'sale_month')}, {I('cars', 'cars')},
  {I('under_priced', 'under_priced')}, {I('over_priced', 'over_priced')},
  {R('under_priced * 2000.0', 'under_cost')}, {R('over_priced * 900.0', 'over_cost')},
  {R('under_priced * 2000.0 + over_priced * 900.0', 'total_cost')}
FROM c WHERE model_id IS NOT NULL""")
def m10_mispricing_cost(spark, sf_dir):
    """M-10: mispricing cost per model, sale year and month, with year and model totals (rollup)."""
    s = P.scored(spark, sf_dir).where(F.col("data_split") == "test")
    s = s.withColumn("sale_year", F.year(F.to_date("sold_at"))).withColumn("sale_month", F.month(F.to_date("sold_at")))
    a, p = F.col("actual_euro"), F.col("predicted_euro")
    under = F.coalesce(p < a * K.UNDER_PRICED_RATIO, F.lit(False))
    over = F.coalesce(p > a * K.OVER_PRICED_RATIO, F.lit(False))
    over_cost = K.OVER_PRICED_DAYS * K.OVER_PRICED_COST_PER_DAY
    out = s.rollup("model_id", "sale_year", "sale_month").agg(
        F.count(F.lit(1)).alias("cars"),
        F.count(F.when(under, 1)).alias("under_priced"),
        F.count(F.when(over, 1)).alias("over_priced"),
    )
    level = F.when(F.col("sale_year").isNull(), "model").when(F.col("sale_month").isNull(), "year").otherwise("month")
    return out.where(F.col("model_id").isNotNull()).select(
        "model_id", level.alias("level"), F.coalesce("sale_year", F.lit(0)).alias("sale_year"),
        F.coalesce("sale_month", F.lit(0)).alias("sale_month"), "cars", "under_priced", "over_priced",
        (F.col("under_priced") * K.UNDER_PRICED_COST).alias("under_cost"),
        (F.col("over_priced") * over_cost).alias("over_cost"),
        (F.col("under_priced") * K.UNDER_PRICED_COST + F.col("over_priced") * over_cost).alias("total_cost"),
    )


@query("m11_safe_zone", f"""{_METRICS_SQL}
SELECT model_id, data_split, {R('100 - tail_rate', 'safe_zone_rate')} FROM m""")
def m11_safe_zone(spark, sf_dir):
    """M-11: safe-zone rate = 100 - tail rate."""
    return metrics_frame(spark, sf_dir).select(*GROUP, (100 - F.col("tail_rate")).alias("safe_zone_rate"))


def segment_label(col):
    c = F.col(col)
    expr = None
    for _, label, lo, hi, _t in K.PRICE_SEGMENTS:
        cond = (c > lo) if hi is None else ((c > lo) & (c <= hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def segment_dim(spark):
    """Segment dimension (4 fixed rows): order, label, bounds, MAE target."""
    rows = [(o, lab, lo, hi, t) for o, lab, lo, hi, t in K.PRICE_SEGMENTS]
    return spark.createDataFrame(rows, "segment_order int, segment string, lower double, upper double, mae_target double")


SEGMENT_SQL = "CASE " + " ".join(
    f"WHEN actual_euro > {lo} " + (f"AND actual_euro <= {hi} " if hi is not None else "") + f"THEN '{lab}'"
    for _, lab, lo, hi, _t in K.PRICE_SEGMENTS
) + " END"
SEGMENT_DIM_SQL = "(VALUES " + ", ".join(
    f"({o}, '{lab}', {lo}, {hi if hi is not None else 'NULL'}, {t})" for o, lab, lo, hi, t in K.PRICE_SEGMENTS
) + ") AS sd(segment_order, segment, lower_bound, upper_bound, mae_target)"


@query("m12_segment_mae", f"""{WITH_SCORED},
g AS (SELECT model_id, {SEGMENT_SQL} AS segment, avg(abs_residual_euro) AS mae, count(*) AS n
      FROM scored WHERE data_split = 'val' GROUP BY model_id, {SEGMENT_SQL})
SELECT g.model_id, g.segment, {I('sd.segment_order', 'segment_order')}, {R('g.mae', 'mae')}, {R('sd.mae_target', 'mae_target')},
  {I('g.n', 'n')}, {R('(g.mae - sd.mae_target) / sd.mae_target * 100', 'over_target_pct')},
  (g.mae - sd.mae_target) / sd.mae_target * 100 > 20 AS failing
FROM g JOIN {SEGMENT_DIM_SQL} ON sd.segment = g.segment""")
def m12_segment_mae(spark, sf_dir):
    """M-12 / J-04: MAE per price segment against its target; more than 20 % over is a failure."""
    s = P.scored(spark, sf_dir).where(F.col("data_split") == "val").withColumn("segment", segment_label("actual_euro"))
    g = s.groupBy("model_id", "segment").agg(F.avg("abs_residual_euro").alias("mae"), F.count(F.lit(1)).alias("n"))
    d = F.broadcast(segment_dim(spark).select("segment", "segment_order", "mae_target"))  # 4 fixed rows
    over = (F.col("mae") - F.col("mae_target")) / F.col("mae_target") * 100
    return g.join(d, "segment").select(
        "model_id", "segment", "segment_order", "mae", "mae_target", "n", over.alias("over_target_pct"), (over > 20).alias("failing")
    )


@query("m14_interval", f"""{WITH_SCORED},
r AS (SELECT model_id, sqrt(avg(pow(residual_euro, 2))) AS rmse FROM scored WHERE data_split = 'train' GROUP BY model_id)
SELECT s.model_id, s.order_key, s.line_number, s.part_key, s.supp_key, {R('s.predicted_euro', 'predicted_euro')},
  {R('greatest(0.0, s.predicted_euro - 1.96 * r.rmse)', 'lower')}, {R('s.predicted_euro + 1.96 * r.rmse', 'upper')}
FROM scored s JOIN r ON r.model_id = s.model_id WHERE s.data_split = 'test'""")
def m14_interval(spark, sf_dir):
    """M-14: prediction interval from the train RMSE of each model (broadcast, one row per model)."""
    s = P.scored(spark, sf_dir)
    r = s.where(F.col("data_split") == "train").groupBy("model_id").agg(F.sqrt(F.avg(F.pow("residual_euro", 2))).alias("_rmse"))
    t = s.where(F.col("data_split") == "test").join(F.broadcast(r), "model_id")  # one row per model id
    t = M.interval(t, F.col("_rmse"))
    return t.select(
        "model_id", "order_key", "line_number", "part_key", "supp_key", "predicted_euro",
        F.col("price_interval.lower").alias("lower"), F.col("price_interval.upper").alias("upper"),
    )
