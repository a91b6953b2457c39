"""Queries: model selection, comparison and the gate (T1-09/11/12/15, C-*, G-*), on the baseline models.

Everything runs over the long scored table; model metrics are one grouped
aggregate (M-08 per model and split), and the comparisons are joins of
those small metric rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.operators import metrics as M
from resale.operators import selection as SEL
from resale.plans import prepared as P
from resale.plans.oracle_base import WITH_PROCESSED, WITH_SCORED
from resale.plans.q_metrics import _METRICS_SQL
from resale.plans.q_sources import GOLDEN_SQL, golden_set
from resale.plans.registry import query
from resale.plans.sqlhelp import I, R

MODEL_A, MODEL_B = "baseline_series", "baseline_series_fuel"


def metric_rows(spark, sf_dir):
    return M.all_metrics(P.scored(spark, sf_dir), ["model_id", "data_split"])


@query("t15_baseline_fit", f"""{WITH_PROCESSED},
{'bfit AS (SELECT series, fuel, sum(price_log) AS sum_log, count(*) AS n FROM processed WHERE data_split = ' + "'train'" + ' GROUP BY series, fuel)'}
SELECT 'series_fuel' AS grain, series, fuel, {R('sum_log / n', 'mean_log')}, {I('n', 'n')} FROM bfit
UNION ALL SELECT 'series', series, 'ALL', {R('sum(sum_log) / sum(n)', 'mean_log')}, {I('sum(n)', 'n')} FROM bfit GROUP BY series
UNION ALL SELECT 'global', 'ALL', 'ALL', {R('sum(sum_log) / sum(n)', 'mean_log')}, {I('sum(n)', 'n')} FROM bfit""")
def t15_baseline_fit(spark, sf_dir):
    """T1-15: baseline models: train mean of log price per (series, fuel), per series, global."""
    return SEL.baseline_table(P.baseline_fit(spark, sf_dir))


@query("t09_overfit_gap", f"""{_METRICS_SQL}
SELECT model_id, {R("max(CASE WHEN data_split = 'train' THEN mae END)", 'train_mae')}, {R("max(CASE WHEN data_split = 'val' THEN mae END)", 'val_mae')},
  {R("max(CASE WHEN data_split = 'val' THEN mae END) - max(CASE WHEN data_split = 'train' THEN mae END)", 'gap')},
  abs(max(CASE WHEN data_split = 'val' THEN mae END) - max(CASE WHEN data_split = 'train' THEN mae END)) < {K.OVERFIT_GAP_OK} AS healthy
FROM m GROUP BY model_id""")
def t09_overfit_gap(spark, sf_dir):
    """T1-09: validation MAE - train MAE per model; healthy when its absolute value is below 500."""
    return SEL.overfit_gap(metric_rows(spark, sf_dir))


@query("t11_metric_pivot", f"""{_METRICS_SQL}
SELECT model_id, {R("max(CASE WHEN data_split = 'train' THEN mae END)", 'train')}, {R("max(CASE WHEN data_split = 'val' THEN mae END)", 'val')},
  {R("max(CASE WHEN data_split = 'test' THEN mae END)", 'test')} FROM m GROUP BY model_id""")
def t11_metric_pivot(spark, sf_dir):
    """T1-11: pivot of results: MAE with models as rows and splits as columns."""
    return metric_rows(spark, sf_dir).groupBy("model_id").pivot("data_split", ["train", "val", "test"]).agg(F.first("mae"))


@query("t12_constrained_selection", f"""{_METRICS_SQL},
g AS (SELECT model_id, max(CASE WHEN data_split = 'val' THEN mae END) AS val_mae,
        max(CASE WHEN data_split = 'val' THEN mae END) - max(CASE WHEN data_split = 'train' THEN mae END) AS gap FROM m GROUP BY model_id)
SELECT model_id, {R('val_mae', 'val_mae')}, {R('gap', 'gap')} FROM g WHERE gap < {K.OVERFIT_GAP_OK} ORDER BY val_mae, gap, model_id LIMIT 1""")
def t12_constrained_selection(spark, sf_dir):
    """T1-12: among models with gap < 500, the lowest validation MAE (then gap)."""
    return SEL.constrained_selection(SEL.overfit_gap(metric_rows(spark, sf_dir)))


_VAL_AB = f"""{_METRICS_SQL},
a AS (SELECT * FROM m WHERE model_id = '{MODEL_A}' AND data_split = 'val'),
b AS (SELECT * FROM m WHERE model_id = '{MODEL_B}' AND data_split = 'val')"""


@query("c01_model_comparison", f"""{_VAL_AB}
SELECT '{MODEL_A}' AS model_a, '{MODEL_B}' AS model_b, {R('a.mae', 'mae_a')}, {R('b.mae', 'mae_b')},
  {R('(a.mae - b.mae) / a.mae * 100', 'mae_improvement_pct')}, {R('(b.r2 - a.r2) / a.r2 * 100', 'r2_improvement_pct')},
  {R('(a.tail_rate - b.tail_rate) / a.tail_rate * 100', 'tail_improvement_pct')}, {R('b.rmse - a.rmse', 'rmse_difference')}
FROM a CROSS JOIN b""")
def c01_model_comparison(spark, sf_dir):
    """C-01: comparison of two models on validation: % change of MAE, R², tail rate."""
    return SEL.compare(metric_rows(spark, sf_dir).where(F.col("data_split") == "val"), MODEL_A, MODEL_B)


def _vote_sql():
    terms_b, terms_a = [], []
    for m, w, higher in K.VOTE_WEIGHTS:
        better = f"b.{m} > a.{m}" if higher else f"b.{m} < a.{m}"
        terms_b.append(f"CASE WHEN {better} THEN {w} ELSE 0 END")
        terms_a.append(f"CASE WHEN {better} THEN 0 ELSE {w} END")
    sa, sb = " + ".join(terms_a), " + ".join(terms_b)
    return f"""{_VAL_AB}
SELECT {I(sa, 'score_a')}, {I(sb, 'score_b')},
  CASE WHEN ({sb}) > ({sa}) THEN '{MODEL_B}' WHEN ({sa}) > ({sb}) THEN '{MODEL_A}' ELSE 'tie' END AS winner
FROM a CROSS JOIN b"""


@query("c02_weighted_vote", _vote_sql())
def c02_weighted_vote(spark, sf_dir):
    """C-02: weighted vote (MAE 2, R² 2, tail rate 3, MAPE 1); equality counts for the first model."""
    return SEL.weighted_vote(metric_rows(spark, sf_dir).where(F.col("data_split") == "val"), MODEL_A, MODEL_B)


_GOLDEN_METRICS_SQL = f"""{WITH_SCORED},
{GOLDEN_SQL.replace('FROM processed', 'FROM processed')},
gs AS (SELECT s.* FROM scored s JOIN golden g USING (order_key, line_number, part_key, supp_key)),
gm AS (SELECT model_id, avg(abs(actual_euro - predicted_euro)) AS mae, sqrt(avg(pow(actual_euro - predicted_euro, 2))) AS rmse,
         CASE WHEN var_pop(actual_euro) * count(*) > 0 THEN 1 - sum(pow(actual_euro - predicted_euro, 2)) / (var_pop(actual_euro) * count(*)) END AS r2,
         avg(ape) AS mape, avg(CAST(in_tail AS DOUBLE)) * 100 AS tail_rate, count(*) AS n
       FROM gs GROUP BY model_id)"""


@query("g01_golden_scoring", f"""{_GOLDEN_METRICS_SQL}
SELECT model_id, {R('mae', 'mae')}, {R('rmse', 'rmse')}, {R('r2', 'r2')}, {R('mape', 'mape')}, {R('tail_rate', 'tail_rate')}, {I('n', 'n')} FROM gm""")
def g01_golden_scoring(spark, sf_dir):
    """G-01: score the golden set with each model: MAE, RMSE, R² (price), MAPE, tail rate."""
    return SEL.golden_metrics(spark, sf_dir, golden_set(spark, sf_dir))


def _gate_sql():
    rows = ", ".join(f"('{m}', {v}, {'true' if hib else 'false'})" for m, v, hib in K.GATE_THRESHOLDS)
    return f"""{_GOLDEN_METRICS_SQL},
thr AS (SELECT * FROM (VALUES {rows}) AS t(metric, limit_value, higher_is_better)),
lm AS (SELECT model_id, 'mae' AS metric, mae AS value FROM gm UNION ALL SELECT model_id, 'rmse', rmse FROM gm
       UNION ALL SELECT model_id, 'r2', r2 FROM gm UNION ALL SELECT model_id, 'mape', mape FROM gm
       UNION ALL SELECT model_id, 'tail_rate', tail_rate FROM gm UNION ALL SELECT model_id, 'n', CAST(n AS DOUBLE) FROM gm),
chk AS (SELECT lm.model_id, lm.metric, lm.value, thr.limit_value,
          coalesce(CASE WHEN thr.higher_is_better THEN lm.value >= thr.limit_value ELSE lm.value <= thr.limit_value END, false) AS passed
        FROM lm JOIN thr ON thr.metric = lm.metric)
SELECT model_id, metric, {R('value', 'value')}, {R('limit_value', 'limit_value')}, passed,
  bool_and(passed) OVER (PARTITION BY model_id) AS gate_passed FROM chk"""


@query("g02_threshold_gate", _gate_sql())
def g02_threshold_gate(spark, sf_dir):
    """G-02 / J-03: metrics joined with thresholds (metrics without one skipped); all must pass."""
    gm = SEL.golden_metrics(spark, sf_dir, golden_set(spark, sf_dir))
    return SEL.gate(gm, K.GATE_THRESHOLDS)
