"""Queries: residual analysis (R-*) of the default baseline model on the validation split."""

from __future__ import annotations

from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.functions.exprs import hash_bucket
from resale.operators import residuals as RS
from resale.plans import prepared as P
from resale.plans.oracle_base import WITH_SCORED, md5_bucket
from resale.plans.q_eda import histogram_sql
from resale.plans.q_metrics import SEGMENT_DIM_SQL, SEGMENT_SQL
from resale.plans.registry import query
from resale.plans.sqlhelp import I, R

KEYS = ["order_key", "line_number", "part_key", "supp_key"]
KEYS_SQL = "order_key, line_number, part_key, supp_key"
CATS = ["fuel", "car_type", "paint_color"]
CONT = ["mileage", "car_age_years", "engine_power", "annual_mileage"]
WITH_RES = f"""{WITH_SCORED},
res AS (SELECT * FROM scored WHERE model_id = '{K.DEFAULT_MODEL}' AND data_split = 'val')"""


def res_frame(spark, sf_dir):
    s = P.scored(spark, sf_dir, models=[K.DEFAULT_MODEL])
    return s.where(F.col("data_split") == "val")


@query("r01_residual_columns", f"""{WITH_RES}
SELECT {KEYS_SQL}, {R('actual_euro', 'actual_euro')}, {R('predicted_euro', 'predicted_euro')}, {R('residual_euro', 'residual_euro')},
  {R('abs_residual_euro', 'abs_residual_euro')}, {R('ape', 'ape')}, in_tail FROM res""")
def r01_residual_columns(spark, sf_dir):
    """R-01: actual, predicted, residual, |residual|, APE and tail flag per row."""
    return res_frame(spark, sf_dir).select(*KEYS, "actual_euro", "predicted_euro", "residual_euro", "abs_residual_euro", "ape", "in_tail")


@query("r02_residual_summary", f"""{WITH_RES}
SELECT {I('count(*)', 'n')}, {R('min(actual_euro)', 'actual_min')}, {R('max(actual_euro)', 'actual_max')}, {R('avg(residual_euro)', 'residual_mean')},
  {R('stddev_pop(residual_euro)', 'residual_std')}, {R('quantile_cont(abs_residual_euro, 0.5)', 'abs_residual_median')},
  {R('avg(ape)', 'ape_mean')}, {R('avg(CAST(in_tail AS DOUBLE)) * 100', 'tail_pct')} FROM res""")
def r02_residual_summary(spark, sf_dir):
    """R-02: residual summary (population std, as the reference computes it on arrays)."""
    return RS.summary(res_frame(spark, sf_dir))


@query("r03_tail_vs_normal", f"""{WITH_RES}
SELECT in_tail, {I('count(*)', 'n')}, {R('count(*) * 100.0 / (SELECT count(*) FROM res)', 'share_pct')}, {R('avg(ape)', 'ape_mean')}
FROM res GROUP BY in_tail""")
def r03_tail_vs_normal(spark, sf_dir):
    """R-03: tail vs normal rows (shares over all rows)."""
    return RS.tail_vs_normal(res_frame(spark, sf_dir))


@query("r04_price_segments", f"""{WITH_RES}
SELECT {KEYS_SQL}, {SEGMENT_SQL} AS segment FROM res""")
def r04_price_segments(spark, sf_dir):
    """R-04: right-closed price segment per row."""
    return res_frame(spark, sf_dir).select(*KEYS, RS.segment_label().alias("segment"))


_SEGSTATS_SQL = f"""s AS (SELECT {SEGMENT_SQL} AS segment, avg(ape) AS ape_mean, quantile_cont(ape, 0.5) AS ape_median, stddev_samp(ape) AS ape_std,
        avg(CAST(in_tail AS DOUBLE)) AS tail, count(*) AS n FROM res GROUP BY 1),
ss AS (SELECT sd.segment_order, sd.segment, round_even(s.ape_mean, 2) AS ape_mean, round_even(s.ape_median, 2) AS ape_median,
        round_even(s.ape_std, 2) AS ape_std, round_even(s.tail, 2) * 100 AS tail_rate, coalesce(s.n, 0) AS n
      FROM {SEGMENT_DIM_SQL} LEFT JOIN s ON s.segment = sd.segment)"""


@query("r05_segment_stats", f"""{WITH_RES},
{_SEGSTATS_SQL}
SELECT {I('segment_order', 'segment_order')}, segment, {R('ape_mean', 'ape_mean')}, {R('ape_median', 'ape_median')}, {R('ape_std', 'ape_std')},
  {R('tail_rate', 'tail_rate')}, {I('n', 'n')} FROM ss""")
def r05_segment_stats(spark, sf_dir):
    """R-05: APE statistics and tail rate per price segment; empty segments kept."""
    return RS.segment_stats(res_frame(spark, sf_dir))


@query("r06_worst_segment", f"""{WITH_RES},
{_SEGSTATS_SQL}
SELECT segment, {R('tail_rate', 'tail_rate')} FROM ss WHERE tail_rate IS NOT NULL ORDER BY tail_rate DESC, segment_order LIMIT 1""")
def r06_worst_segment(spark, sf_dir):
    """R-06: segment with the highest tail rate (first in order on ties)."""
    return RS.worst_segment(RS.segment_stats(res_frame(spark, sf_dir)))


_CATERR_SQL = f"""l AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, ape, in_tail FROM res WHERE {c} IS NOT NULL" for c in CATS)}),
ce AS (SELECT feature, value, round_even(avg(ape), 2) AS ape_mean, round_even(avg(CAST(in_tail AS DOUBLE)), 2) * 100 AS tail_rate, count(*) AS n
       FROM l GROUP BY feature, value)"""


@query("r07_category_errors", f"""{WITH_RES},
{_CATERR_SQL}
SELECT feature, value, {R('ape_mean', 'ape_mean')}, {R('tail_rate', 'tail_rate')}, {I('n', 'n')} FROM ce""")
def r07_category_errors(spark, sf_dir):
    """R-07: mean APE, tail rate and count per fuel / car type / paint colour value."""
    return RS.category_errors(res_frame(spark, sf_dir), CATS)


@query("r08_problem_categories", f"""{WITH_RES},
{_CATERR_SQL}
SELECT feature, value, {R('ape_mean', 'ape_mean')}, {R('tail_rate', 'tail_rate')}, {I('n', 'n')} FROM ce WHERE tail_rate > {K.PROBLEM_TAIL_PCT}""")
def r08_problem_categories(spark, sf_dir):
    """R-08: categories whose tail rate exceeds 50 %."""
    return RS.category_errors(res_frame(spark, sf_dir), CATS).where(F.col("tail_rate") > K.PROBLEM_TAIL_PCT)


@query("r09_error_correlations", f"""{WITH_RES}
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, {R(f'corr(CAST({c} AS DOUBLE), ape)', 'corr_with_ape')} FROM res" for c in CONT)}""")
def r09_error_correlations(spark, sf_dir):
    """R-09: correlation of mileage, age, power and annual mileage with APE."""
    return RS.error_correlations(res_frame(spark, sf_dir), CONT)


@query("r10_worst_predictions", f"""{WITH_RES}
SELECT {KEYS_SQL}, {R('actual_euro', 'actual_euro')}, {R('predicted_euro', 'predicted_euro')}, {R('ape', 'ape')}, series, fuel
FROM res ORDER BY ape DESC, order_key, line_number, part_key, supp_key LIMIT {K.WORST_ROWS}""")
def r10_worst_predictions(spark, sf_dir):
    """R-10: the 100 worst predictions by APE (top-k report)."""
    return RS.worst(res_frame(spark, sf_dir), KEYS).select(*KEYS, "actual_euro", "predicted_euro", "ape", "series", "fuel")


@query("r11_heteroscedasticity", f"""{WITH_RES}
SELECT {R('corr(predicted_euro, abs_residual_euro)', 'corr_pred_abs_residual')},
  coalesce(abs(corr(predicted_euro, abs_residual_euro)) > {K.HETERO_CORR}, false) AS heteroscedastic FROM res""")
def r11_heteroscedasticity(spark, sf_dir):
    """R-11: heteroscedasticity flag."""
    return RS.heteroscedasticity(res_frame(spark, sf_dir))


@query("r12_recommendations", f"""{WITH_RES},
w AS (SELECT max(t) AS tail_rate FROM (
  SELECT avg(CAST(in_tail AS DOUBLE)) * 100 AS t FROM res WHERE actual_euro > 0
  GROUP BY CASE WHEN actual_euro <= 20000 THEN 0 WHEN actual_euro <= 35000 THEN 1 WHEN actual_euro <= 50000 THEN 2 ELSE 3 END)),
h AS (SELECT coalesce(abs(corr(predicted_euro, abs_residual_euro)) > {K.HETERO_CORR}, false) AS het, avg(CAST(in_tail AS DOUBLE)) * 100 AS ot FROM res)
SELECT 'heteroscedasticity' AS rule, het AS triggered FROM h
UNION ALL SELECT 'worst_segment', coalesce((SELECT tail_rate FROM w) > {K.PROBLEM_TAIL_PCT}, false)
UNION ALL SELECT 'overall_tail', coalesce(ot > {K.PROBLEM_TAIL_PCT}, false) FROM h""")
def r12_recommendations(spark, sf_dir):
    """R-12: recommendation rules and whether each is triggered."""
    return RS.recommendations(res_frame(spark, sf_dir))


@query("r13_residual_histograms", f"""{WITH_RES}
{histogram_sql('res', 'residual_euro')} UNION ALL {histogram_sql('res', 'ape')}""")
def r13_residual_histograms(spark, sf_dir):
    """R-13: plot data: 50-bin histograms of the residual and of APE."""
    from resale.operators.eda import histogram

    r = res_frame(spark, sf_dir)
    return histogram(r, "residual_euro").unionByName(histogram(r, "ape"))


SAMPLE_PER_MILLE = 50


@query("r13_residual_sample", f"""{WITH_RES}
SELECT {KEYS_SQL}, {R('predicted_euro', 'predicted_euro')}, {R('residual_euro', 'residual_euro')} FROM res
WHERE {md5_bucket("concat_ws('-', order_key, line_number, part_key, supp_key)", '|sample', 1000)} < {SAMPLE_PER_MILLE}""")
def r13_residual_sample(spark, sf_dir):
    """R-13: plot data: hash sample of (predicted, residual) points, ``SAMPLE_PER_MILLE`` rows of 1000, the same at any partitioning."""
    key = F.concat_ws("-", *[F.col(k).cast("string") for k in KEYS])
    sampled = res_frame(spark, sf_dir).where(hash_bucket(key, "|sample", 1000) < SAMPLE_PER_MILLE)
    return sampled.select(*KEYS, "predicted_euro", "residual_euro")
