"""Queries: learned parameters and encoders (E-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from resale.operators import encoders, features
from resale.plans import prepared as P
from resale.plans.oracle_base import WITH_BASE, WITH_PARAMS, WITH_PROCESSED
from resale.plans.registry import query
from resale.plans.sqlhelp import I, R

KEYS = ["order_key", "line_number", "part_key", "supp_key"]
KEYS_SQL = "order_key, line_number, part_key, supp_key"
LABEL_COLUMNS = features.STRING_FEATURES


@query("e01_target_encoding_fit", f"""{WITH_PARAMS}
SELECT feature, category, {R('encoded', 'encoded')} FROM enc""")
def e01_target_encoding_fit(spark, sf_dir):
    """E-01: mean train price per category of fuel / paint colour / car type (one pass)."""
    fit = P.encoding_fit(spark, sf_dir)
    return fit.where(F.col("encoded").isNotNull()).select("feature", "category", "encoded")


@query("e02_target_encoding_apply", f"""{WITH_PROCESSED}
SELECT {KEYS_SQL}, data_split, {R('fuel_encoded', 'fuel_encoded')}, {R('color_encoded', 'color_encoded')},
  {R('car_type_encoded', 'car_type_encoded')} FROM processed""")
def e02_target_encoding_apply(spark, sf_dir):
    """E-02: encodings looked up; unseen -> mean of the encoded column within the split."""
    return P.processed_rows(spark, sf_dir).select(*KEYS, "data_split", "fuel_encoded", "color_encoded", "car_type_encoded")


@query("e03_serving_encoding", f"""{WITH_PARAMS},
fill AS (SELECT feature, avg(encoded) AS f FROM enc GROUP BY feature)
SELECT {KEYS_SQL},
  {R("coalesce(ef.encoded, (SELECT f FROM fill WHERE feature = 'fuel'))", 'fuel_encoded')},
  {R("coalesce(ec.encoded, (SELECT f FROM fill WHERE feature = 'color'))", 'color_encoded')},
  {R("coalesce(et.encoded, (SELECT f FROM fill WHERE feature = 'car_type'))", 'car_type_encoded')}
FROM base b
LEFT JOIN enc ef ON ef.feature = 'fuel' AND ef.category = b.fuel
LEFT JOIN enc ec ON ec.feature = 'color' AND ec.category = b.paint_color
LEFT JOIN enc et ON et.feature = 'car_type' AND et.category = b.car_type
WHERE b.data_split = 'test'""")
def e03_serving_encoding(spark, sf_dir):
    """E-03: serving rule on the raw strings: unseen -> unweighted mean of the category means."""
    fit = P.encoding_fit(spark, sf_dir)
    test = P.base(spark, sf_dir).where(F.col("data_split") == "test").drop("data_split")
    out = encoders.apply_target_encoding(test, fit, encoders.serving_fill(fit), by_split=False)
    return out.select(*KEYS, "fuel_encoded", "color_encoded", "car_type_encoded")


@query("e04_learned_params", f"""{WITH_PARAMS}
SELECT {R('mileage_cap', 'mileage_cap')}, {R('price_floor', 'price_floor')}, {R('price_cap', 'price_cap')},
  {R('median_mileage', 'median_mileage')}, {R('median_engine_power', 'median_engine_power')}, {R('median_age', 'median_age')}
FROM params""")
def e04_learned_params(spark, sf_dir):
    """E-04: winsor caps and imputation medians from the train rows (exact percentiles)."""
    return P.learned_params(spark, sf_dir)


def _label_fit_sql():
    parts = [
        f"SELECT DISTINCT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'nan') AS category FROM processed WHERE data_split = 'train'"
        for c in LABEL_COLUMNS
    ]
    return " UNION ALL ".join(parts)


@query("e05_label_encoder_fit", f"""{WITH_PROCESSED},
d AS ({_label_fit_sql()})
SELECT feature, category, {I('dense_rank() OVER (PARTITION BY feature ORDER BY category) - 1', 'code')} FROM d""")
def e05_label_encoder_fit(spark, sf_dir):
    """E-05: sorted distinct text per string column -> 0..n-1 (null reads 'nan')."""
    return P.label_codes(spark, sf_dir)


def _label_apply_sql():
    joins, cols = [], []
    for i, c in enumerate(LABEL_COLUMNS):
        joins.append(f"LEFT JOIN codes c{i} ON c{i}.feature = '{c}' AND c{i}.category = coalesce(CAST(t.{c} AS VARCHAR), 'nan')")
        cols.append(I(f"coalesce(c{i}.code, -1)", f"{c}_code"))
    return joins, cols


_J, _C = _label_apply_sql()


@query("e06_label_encoder_apply", f"""{WITH_PROCESSED},
d AS ({_label_fit_sql()}),
codes AS (SELECT feature, category, dense_rank() OVER (PARTITION BY feature ORDER BY category) - 1 AS code FROM d)
SELECT t.order_key, t.line_number, t.part_key, t.supp_key, {', '.join(_C)}
FROM processed t {' '.join(_J)} WHERE t.data_split = 'test'""")
def e06_label_encoder_apply(spark, sf_dir):
    """E-06: label codes on the test rows; text unseen in train -> -1."""
    p = P.processed_rows(spark, sf_dir)
    out = encoders.apply_label_encoder(p.where(F.col("data_split") == "test"), P.label_codes(spark, sf_dir), LABEL_COLUMNS)
    return out.select(*KEYS, *[f"{c}_code" for c in LABEL_COLUMNS])


@query("e06_label_encoder_all_splits", f"""{WITH_PROCESSED},
d AS ({_label_fit_sql()}),
codes AS (SELECT feature, category, dense_rank() OVER (PARTITION BY feature ORDER BY category) - 1 AS code FROM d)
SELECT t.order_key, t.line_number, t.part_key, t.supp_key, t.data_split, {', '.join(_C)}
FROM processed t {' '.join(_J)}""")
def e06_label_encoder_all_splits(spark, sf_dir):
    """E-06: label codes of the train rows on the rows of all splits; text unseen in train -> -1."""
    p = P.processed_rows(spark, sf_dir)
    out = encoders.apply_label_encoder(p, P.label_codes(spark, sf_dir), LABEL_COLUMNS)
    return out.select(*KEYS, "data_split", *[f"{c}_code" for c in LABEL_COLUMNS])


@query("e07_unknown_key_share", f"""{WITH_BASE},
seen AS (SELECT DISTINCT model_key FROM base WHERE data_split = 'train' AND model_key IS NOT NULL),
cur AS (SELECT b.data_split, s.model_key IS NULL AS unknown FROM base b LEFT JOIN seen s ON s.model_key = b.model_key WHERE b.data_split <> 'train')
SELECT data_split, {I('count(*)', 'n_rows')}, {I('count(CASE WHEN unknown THEN 1 END)', 'n_unknown')},
  {R('count(CASE WHEN unknown THEN 1 END) * 100.0 / count(*)', 'unknown_pct')}
FROM cur GROUP BY data_split""")
def e07_unknown_key_share(spark, sf_dir):
    """E-07 / J-06: share of val and test rows whose model key never occurs in train (anti join)."""
    b = P.base(spark, sf_dir)
    train = b.where(F.col("data_split") == "train")
    seen = train.select("model_key").where(F.col("model_key").isNotNull()).distinct()
    # rows are counted per key first, so only the small counts meet the keys of train
    cur = b.where(F.col("data_split") != "train").groupBy("data_split", "model_key").agg(F.count(F.lit(1)).alias("n"))
    unseen = cur.join(seen, "model_key", "left_anti").groupBy("data_split").agg(F.sum("n").alias("n_unknown"))
    tot = cur.groupBy("data_split").agg(F.sum("n").alias("n_rows"))
    j = tot.join(unseen, "data_split", "left").withColumn("n_unknown", F.coalesce("n_unknown", F.lit(0)))
    return j.select("data_split", "n_rows", "n_unknown", F.try_divide(F.col("n_unknown") * 100.0, "n_rows").alias("unknown_pct"))
