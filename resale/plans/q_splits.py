"""Queries: split operators (L-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.operators import moments, splits
from resale.plans import prepared as P
from resale.plans.oracle_base import WITH_BASE, WITH_LISTINGS, WITH_PROCESSED, md5_bucket
from resale.plans.registry import query
from resale.plans.sqlhelp import I, R
from resale.sources.tables import listings

KEYS = ["order_key", "line_number", "part_key", "supp_key"]
KEYS_SQL = "order_key, line_number, part_key, supp_key"


@query("l01_split", f"""{WITH_BASE}
SELECT {KEYS_SQL}, {I('bucket', 'bucket')}, data_split FROM base""")
def l01_split(spark, sf_dir):
    """L-01: seeded 60/20/20 split by md5 bucket of the order key."""
    return splits.assign_split(listings(spark, sf_dir)).select(*KEYS, "bucket", "data_split")


@query("l02_eda_split", f"""{WITH_LISTINGS}
SELECT CASE WHEN bucket < 80 THEN 'train' ELSE 'holdout' END AS eda_part, {I('count(*)', 'n_rows')},
  {R('avg(price)', 'mean_price')}
FROM listings GROUP BY 1""")
def l02_eda_split(spark, sf_dir):
    """L-02: 80/20 split for exploratory analysis, rows and mean price per part."""
    d = splits.eda_split(listings(spark, sf_dir))
    return d.groupBy("eda_part").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("price").alias("mean_price"))


@query("l03_inner_validation", f"""{WITH_LISTINGS}
SELECT {KEYS_SQL}, CASE WHEN {md5_bucket('order_key', 'val')} < 20 THEN 'val' ELSE 'fit' END AS fit_role
FROM listings WHERE bucket < 60""")
def l03_inner_validation(spark, sf_dir):
    """L-03: validation = a fixed 20 % of the train rows (second-level bucket)."""
    d = splits.inner_validation(splits.assign_split(listings(spark, sf_dir)))
    return d.where(F.col("data_split") == "train").select(*KEYS, "fit_role")


@query("l05_fold_sizes", f"""{WITH_LISTINGS}
SELECT {I(md5_bucket('order_key', 'fold', 3), 'fold')}, {I('count(*)', 'n_rows')}
FROM listings WHERE bucket < 60 GROUP BY 1""")
def l05_fold_sizes(spark, sf_dir):
    """L-05: k-fold assignment (k=3) inside train; rows per fold."""
    d = splits.assign_split(listings(spark, sf_dir)).where(F.col("data_split") == "train")
    return d.groupBy(splits.fold_of().alias("fold")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("l06_time_split", f"""{WITH_LISTINGS},
d AS (SELECT *, datediff('day', DATE '1970-01-01', CAST(sold_at AS DATE)) AS _day FROM listings),
c AS (SELECT quantile_cont(_day, 0.6) AS c1, quantile_cont(_day, 0.8) AS c2 FROM d)
SELECT {KEYS_SQL}, CASE WHEN _day <= c1 THEN 'train' WHEN _day <= c2 THEN 'val' ELSE 'test' END AS time_split
FROM d CROSS JOIN c""")
def l06_time_split(spark, sf_dir):
    """L-06: time-ordered split at the 60th / 80th percentile of the sale day."""
    return splits.time_split(listings(spark, sf_dir)).select(*KEYS, "time_split")


AUDIT_COLUMNS = [
    "mileage", "engine_power", "luxury_tier", "is_luxury", "is_performance", "registration_year",
    "registration_month", "registration_quarter", "is_summer_registration", "is_year_end_registration",
    "car_age_years", "age_mileage_interaction", "mileage_per_power", "annual_mileage", "power_age_ratio",
    "luxury_mileage_interaction", "luxury_age_interaction", "is_high_mileage", "is_old_car",
    "fuel_encoded", "color_encoded", "car_type_encoded",
]


def _audit_sql():
    parts = [
        f"SELECT '{c}' AS column_name, corr(price, {c}) AS r FROM processed WHERE data_split = 'train'" for c in AUDIT_COLUMNS
    ]
    denied = ", ".join(f"'{c}'" for c in K.LEAKY_COLUMNS)
    return f"""{WITH_PROCESSED},
a AS ({' UNION ALL '.join(parts)})
SELECT column_name, {R('r', 'corr_with_price')}, column_name IN ({denied}) AS denied,
  coalesce(abs(r) > {K.LEAKAGE_CORR_BOUND}, false) OR column_name IN ({denied}) AS flagged
FROM a"""


@query("l07_leakage_audit", _audit_sql())
def l07_leakage_audit(spark, sf_dir):
    """L-07: deny-list check plus |corr(feature, price)| above a bound, on train rows, in one scan."""
    t = P.processed_rows(spark, sf_dir).where(F.col("data_split") == "train")
    long = moments.matrix(t, [("price", c) for c in AUDIT_COLUMNS]).select(F.col("col_b").alias("column_name"), F.col("r").alias("corr_with_price"))
    denied = F.col("column_name").isin(K.LEAKY_COLUMNS)
    return long.select(
        "column_name", "corr_with_price", denied.alias("denied"),
        (F.coalesce(F.abs("corr_with_price") > K.LEAKAGE_CORR_BOUND, F.lit(False)) | denied).alias("flagged"),
    )


@query("l04_split_fallback", f"""{WITH_BASE}
SELECT {KEYS_SQL}, data_split FROM base""")
def l04_split_fallback(spark, sf_dir):
    """L-04: a table without the split marker gets the seeded 60/20/20 split; one that has it keeps it."""
    marked = splits.with_split(listings(spark, sf_dir).drop("bucket"))
    return splits.with_split(marked).select(*KEYS, "data_split")
