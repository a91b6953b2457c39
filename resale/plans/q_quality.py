"""Queries: data-quality checks (Q-*) on the raw listings.

Most checks read one wide aggregate row (every statistic in a single pass
over the table) and reshape it with ``unpivot``; per-column work never
loops over the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.functions.exprs import adjusted_skewness, parse_date
from resale.operators import quality as Q
from resale.plans import prepared as P
from resale.plans.oracle_base import WITH_BASE, WITH_PROCESSED
from resale.plans.registry import query
from resale.plans.sqlhelp import I, R
from resale.sources.tables import RAW_COLUMNS

KEYS = ["order_key", "line_number", "part_key", "supp_key"]
KEYS_SQL = "order_key, line_number, part_key, supp_key"
RAW = [c for c in RAW_COLUMNS if c != "bucket"]
RAW_DOUBLES = ["mileage", "price"]


def raw(spark, sf_dir):
    return P.base(spark, sf_dir).select(*RAW)


_EXPECTED_SQL = ", ".join(f"('{c}')" for c in K.EXPECTED_RAW_COLUMNS)


_VALUES_SQL = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n FROM listings" for c in RAW)


@query("q01_schema_check", f"""{WITH_BASE},
actual AS ({_VALUES_SQL}),
expected AS (SELECT * FROM (VALUES {_EXPECTED_SQL}) AS e(column_name))
SELECT coalesce(e.column_name, a.column_name) AS column_name,
  CASE WHEN a.column_name IS NULL THEN 'missing' WHEN e.column_name IS NULL THEN 'extra' ELSE 'present' END AS status, {I('coalesce(a.n, 0)', 'n_values')}
FROM expected e FULL JOIN actual a ON a.column_name = e.column_name""")
def q01_schema_check(spark, sf_dir):
    """Q-01: expected columns present / missing, extra columns, and how many values each holds."""
    return Q.schema_check(raw(spark, sf_dir), K.EXPECTED_RAW_COLUMNS)


@query("q02_row_count", f"""{WITH_BASE}
SELECT {I('count(*)', 'n_rows')}, count(*) >= {K.MIN_ROWS} AS passes FROM listings""")
def q02_row_count(spark, sf_dir):
    """Q-02: at least 1000 rows."""
    return raw(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("passes", F.col("n_rows") >= K.MIN_ROWS)


NUMERIC_PROCESSED = [
    "mileage", "engine_power", "price", "car_age_years", "age_mileage_interaction", "mileage_per_power", "annual_mileage",
    "power_age_ratio", "luxury_mileage_interaction", "luxury_age_interaction", "fuel_encoded", "color_encoded",
    "car_type_encoded", "price_log",
]


@query("q03_infinity_count", f"""{WITH_PROCESSED}
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, {I(f'count(CASE WHEN isinf({c}) THEN 1 END)', 'inf_count')} FROM processed" for c in NUMERIC_PROCESSED)}""")
def q03_infinity_count(spark, sf_dir):
    """Q-03: count of ±infinity per numeric column of the processed table (one pass)."""
    return Q.infinity_counts(P.processed_rows(spark, sf_dir), NUMERIC_PROCESSED)


def _null_sql(c):
    cond = f"{c} IS NULL OR isnan({c})" if c in RAW_DOUBLES else f"{c} IS NULL"
    return f"SELECT '{c}' AS column_name, count(CASE WHEN {cond} THEN 1 END) AS null_count, count(*) AS n FROM listings"


_NULLS_SQL = f"""{WITH_BASE},
nc AS ({' UNION ALL '.join(_null_sql(c) for c in RAW)})"""


@query("q04_null_counts", f"""{_NULLS_SQL}
SELECT column_name, {I('null_count', 'null_count')}, {R('null_count * 100.0 / n', 'null_pct')} FROM nc""")
def q04_null_counts(spark, sf_dir):
    """Q-04: null (or NaN) count and per cent per column."""
    return Q.null_counts(raw(spark, sf_dir), RAW_DOUBLES)


@query("q05_missing_severity", f"""{_NULLS_SQL}
SELECT column_name, {R('null_count * 100.0 / n', 'null_pct')},
  CASE WHEN null_count * 100.0 / n > {K.MISSING_CRITICAL_PCT} THEN 'critical' WHEN null_count * 100.0 / n > {K.MISSING_WARNING_PCT} THEN 'warning' ELSE 'minor' END AS severity
FROM nc WHERE null_count > 0""")
def q05_missing_severity(spark, sf_dir):
    """Q-05: severity of columns with missing values (> 20 critical, > 5 warning, else minor)."""
    return Q.missing_severity(Q.null_counts(raw(spark, sf_dir), RAW_DOUBLES))


_RANGE_SQL = f"""
SELECT {R('min(price)', 'price_min')}, {R('max(price)', 'price_max')}, {R('min(mileage)', 'mileage_min')}, {R('max(mileage)', 'mileage_max')},
  CASE WHEN {K.PRICE_RANGE[0]} <= min(price) AND max(price) <= {K.PRICE_RANGE[1]} THEN 'pass'
       WHEN max(price) > {K.PRICE_RANGE[1]} THEN 'warning_high' ELSE 'warning_unusual' END AS price_status,
  CASE WHEN {K.MILEAGE_RANGE[0]} <= min(mileage) AND max(mileage) <= {K.MILEAGE_RANGE[1]} THEN 'pass' ELSE 'warning_unusual' END AS mileage_status
FROM listings"""


@query("q06_range_check", f"{WITH_BASE}{_RANGE_SQL}")
def q06_range_check(spark, sf_dir):
    """Q-06: price within 5k-100k and mileage within 0-300k."""
    return Q.range_check(raw(spark, sf_dir))


@query("q07_diversity", f"""{WITH_BASE}
SELECT {I('count(DISTINCT price)', 'distinct_prices')}, {R('count(DISTINCT price) * 100.0 / count(price)', 'unique_pct')},
  count(DISTINCT price) = 1 AS all_identical, {I('count(DISTINCT model_key)', 'distinct_model_keys')},
  {I('count(DISTINCT series)', 'distinct_series')} FROM base""")
def q07_diversity(spark, sf_dir):
    """Q-07: distinct prices, share unique, all-identical flag; distinct model keys vs series."""
    return Q.diversity(P.base(spark, sf_dir))


@query("q08_zero_share", f"""{WITH_BASE}
SELECT {I('count(CASE WHEN mileage = 0 THEN 1 END)', 'zero_mileage')}, {R('count(CASE WHEN mileage = 0 THEN 1 END) * 100.0 / count(*)', 'zero_pct')},
  count(CASE WHEN mileage = 0 THEN 1 END) * 100.0 / count(*) = 100 AS all_zero,
  count(CASE WHEN mileage = 0 THEN 1 END) * 100.0 / count(*) > {K.ZERO_MILEAGE_WARN_PCT} AS high_zero
FROM listings""")
def q08_zero_share(spark, sf_dir):
    """Q-08: share of zero mileage; flags at 100 % and above 10 %."""
    return Q.zero_share(raw(spark, sf_dir))


@query("q09_temporal_span", f"""{WITH_BASE}
SELECT {I('min(registration_year)', 'year_min')}, {I('max(registration_year)', 'year_max')}, {I('max(registration_year) - min(registration_year)', 'span')},
  CASE WHEN max(registration_year) - min(registration_year) >= 5 THEN 'good' WHEN max(registration_year) - min(registration_year) >= 3 THEN 'moderate' ELSE 'limited' END AS grade
FROM base""")
def q09_temporal_span(spark, sf_dir):
    """Q-09: registration-year span and its grade."""
    return Q.temporal_span(P.base(spark, sf_dir))


@query("q10_future_old_dates", f"""{WITH_BASE},
n AS (SELECT year(max(CAST(sold_at AS DATE))) AS as_of_year FROM base)
SELECT {I('n.as_of_year', 'as_of_year')}, {I('count(CASE WHEN registration_year > n.as_of_year THEN 1 END)', 'n_future')},
  {I(f'count(CASE WHEN registration_year < {K.OLDEST_YEAR} THEN 1 END)', 'n_very_old')}
FROM base CROSS JOIN n GROUP BY n.as_of_year""")
def q10_future_old_dates(spark, sf_dir):
    """Q-10: registrations after "now" (the latest sale year, a parameter) and before 1990."""
    return Q.future_old_dates(P.base(spark, sf_dir))


def _vc_sql():
    return f"""(SELECT 'model_key' AS dimension, model_key AS value, count(*) AS n FROM base GROUP BY model_key ORDER BY n DESC, value LIMIT {K.TOP_MODEL_KEYS})
UNION ALL (SELECT 'series', series, count(*) FROM base GROUP BY series)
UNION ALL (SELECT 'luxury_tier', CAST(luxury_tier AS VARCHAR), count(*) FROM base GROUP BY luxury_tier)"""


@query("q11_value_counts", f"""{WITH_BASE},
v AS ({_vc_sql()})
SELECT dimension, value, {I('n', 'n')} FROM v""")
def q11_value_counts(spark, sf_dir):
    """Q-11: top 15 model keys; rows per series and per luxury tier."""
    return Q.value_counts(P.base(spark, sf_dir))


@query("q12_known_codes", f"""{WITH_BASE}
{' UNION ALL '.join(f"SELECT '{c}' AS code, coalesce(bool_or(contains(model_key, '{c}')), false) AS found FROM listings" for c in K.KNOWN_CODES)}""")
def q12_known_codes(spark, sf_dir):
    """Q-12: which of the known model codes occur as a substring of some key."""
    return Q.known_codes(raw(spark, sf_dir), K.KNOWN_CODES)


CATS = ["fuel", "car_type", "paint_color"]


@query("q13_category_distribution", f"""{WITH_BASE},
c AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM listings WHERE {c} IS NOT NULL GROUP BY {c}" for c in CATS)}),
t AS (SELECT feature, sum(n) AS total FROM c GROUP BY feature)
SELECT c.feature, c.value, {I('c.n', 'n')}, {R('c.n * 100.0 / t.total', 'pct')}, c.n * 100.0 / t.total < {K.RARE_SHARE_PCT} AS rare
FROM c JOIN t ON t.feature = c.feature""")
def q13_category_distribution(spark, sf_dir):
    """Q-13: category counts and shares; rare below 5 %."""
    return Q.category_distribution(raw(spark, sf_dir), CATS)


DESCRIBE_COLS = ["mileage", "engine_power", "price"]


def _describe_sql(c):
    x = f"CAST({c} AS DOUBLE)"
    return (
        f"SELECT '{c}' AS column_name, {I(f'count({c})', 'n')}, {R(f'avg({x})', 'mean')}, {R(f'stddev_samp({x})', 'std')}, "
        f"{R(f'min({x})', 'min')}, {R(f'quantile_cont({x}, 0.25)', 'p25')}, {R(f'quantile_cont({x}, 0.5)', 'p50')}, "
        f"{R(f'quantile_cont({x}, 0.75)', 'p75')}, {R(f'max({x})', 'max')} FROM listings"
    )


@query("q14_describe", f"""{WITH_BASE}
{' UNION ALL '.join(_describe_sql(c) for c in DESCRIBE_COLS)}""")
def q14_describe(spark, sf_dir):
    """Q-14: count, mean, std (n-1), min, quartiles, max per numeric column (exact quartiles)."""
    return Q.describe(raw(spark, sf_dir), DESCRIBE_COLS)


@query("q15_named_stats", f"""{WITH_PROCESSED}
SELECT {R('min(mileage_per_power)', 'mpp_min')}, {R('max(mileage_per_power)', 'mpp_max')}, {R('avg(mileage_per_power)', 'mpp_mean')},
  {R('min(power_age_ratio)', 'par_min')}, {R('max(power_age_ratio)', 'par_max')}, {R('avg(power_age_ratio)', 'par_mean')},
  {I('count(CASE WHEN engine_power = 0 THEN 1 END)', 'zero_power')}, {I('count(CASE WHEN car_age_years = 0 THEN 1 END)', 'zero_age')}
FROM processed""")
def q15_named_stats(spark, sf_dir):
    """Q-15: ratio ranges and means, rows with zero power and zero age (processed table)."""
    return Q.named_stats(P.processed_rows(spark, sf_dir))


def _verdict_sql():
    nulls = " UNION ALL ".join(_null_sql(c) for c in RAW)
    exp = ", ".join(f"'{c}'" for c in K.EXPECTED_RAW_COLUMNS)
    return f"""{WITH_BASE},
nc AS ({nulls}),
cols AS (SELECT count(*) AS n_missing FROM (SELECT unnest([{exp}]) AS c) e WHERE c NOT IN (SELECT column_name FROM (DESCRIBE (SELECT {', '.join(RAW)} FROM listings)))),
s AS (SELECT count(*) AS n_rows, min(price) AS pmin, max(price) AS pmax, min(mileage) AS mmin, max(mileage) AS mmax,
        max(registration_year) - min(registration_year) AS span, max(registration_year) AS ymax,
        year(max(CAST(sold_at AS DATE))) AS as_of_year FROM base),
m AS (SELECT max(null_count * 100.0 / n) AS max_null_pct FROM nc),
checks AS (
  SELECT 'columns' AS check_name, CASE WHEN n_missing = 0 THEN 'pass' ELSE 'critical' END AS status FROM cols
  UNION ALL SELECT 'row_count', CASE WHEN n_rows >= {K.MIN_ROWS} THEN 'pass' ELSE 'critical' END FROM s
  UNION ALL SELECT 'price_range', CASE WHEN {K.PRICE_RANGE[0]} <= pmin AND pmax <= {K.PRICE_RANGE[1]} THEN 'pass' ELSE 'warning' END FROM s
  UNION ALL SELECT 'mileage_range', CASE WHEN {K.MILEAGE_RANGE[0]} <= mmin AND mmax <= {K.MILEAGE_RANGE[1]} THEN 'pass' ELSE 'warning' END FROM s
  UNION ALL SELECT 'temporal_span', CASE WHEN span >= 5 THEN 'pass' ELSE 'warning' END FROM s
  UNION ALL SELECT 'future_dates', CASE WHEN ymax <= as_of_year THEN 'pass' ELSE 'critical' END FROM s
  UNION ALL SELECT 'missing_data', CASE WHEN max_null_pct = 0 THEN 'pass' WHEN max_null_pct > {K.MISSING_CRITICAL_PCT} THEN 'critical' ELSE 'warning' END FROM m
)
SELECT check_name, status FROM checks
UNION ALL SELECT 'verdict', CASE WHEN bool_or(status = 'critical') THEN 'STOP' ELSE 'PROCEED' END FROM checks"""


@query("q16_verdict", _verdict_sql())
def q16_verdict(spark, sf_dir):
    """Q-16: check rows (pass / warning / critical) and the PROCEED / STOP verdict."""
    return Q.verdict(P.base(spark, sf_dir), RAW, RAW_DOUBLES, K.EXPECTED_RAW_COLUMNS)


@query("q17_before_after", f"""{WITH_PROCESSED}
SELECT 'raw' AS stage, {I('count(*)', 'n_rows')}, {R('avg(price)', 'price_mean')}, {R('median(price)', 'price_median')},
  {R('stddev_samp(price)', 'price_std')}, {R('skewness(price)', 'price_skew')}, {R('skewness(ln(1 + price))', 'log_price_skew')},
  {I(f'count(CASE WHEN price > (SELECT price_cap FROM params) THEN 1 END)', 'rows_at_cap')}
FROM base
UNION ALL
SELECT 'clean', {I('count(*)', 'n_rows')}, {R('avg(price)', 'price_mean')}, {R('median(price)', 'price_median')},
  {R('stddev_samp(price)', 'price_std')}, {R('skewness(price)', 'price_skew')}, {R('skewness(price_log)', 'log_price_skew')},
  {I('count(CASE WHEN price = (SELECT price_cap FROM params) THEN 1 END)', 'rows_at_cap')}
FROM processed""")
def q17_before_after(spark, sf_dir):
    """Q-17: raw vs clean price: mean, median, std, adjusted skew of price and log price, rows at the cap."""
    return Q.before_after(P.base(spark, sf_dir), P.processed_rows(spark, sf_dir), P.learned_params(spark, sf_dir))


def _rules_sql():
    fuels = ", ".join(f"'{v}'" for v in K.FIXTURE_FUELS)
    types = ", ".join(f"'{v}'" for v in K.FIXTURE_CAR_TYPES)
    reg = "CAST(try_strptime(registration_date, '%Y-%m-%d') AS DATE)"
    sold = "CAST(try_strptime(sold_at, '%Y-%m-%d') AS DATE)"
    return ", ".join([
        "CASE WHEN mileage IS NULL THEN 'mileage_missing' END",
        "CASE WHEN mileage < 0 THEN 'mileage_negative' END",
        "CASE WHEN engine_power IS NULL THEN 'power_missing' END",
        "CASE WHEN engine_power <= 0 THEN 'power_not_positive' END",
        f"CASE WHEN {reg} IS NULL THEN 'registration_date_invalid' END",
        f"CASE WHEN fuel IS NULL OR lower(fuel) NOT IN ({fuels}) THEN 'fuel_invalid' END",
        f"CASE WHEN car_type IS NULL OR lower(car_type) NOT IN ({types}) THEN 'car_type_invalid' END",
        f"CASE WHEN {sold} < {reg} THEN 'sold_before_registration' END",
    ])


VALIDATION_SQL = f"""v AS (SELECT *, concat_ws(',', {_rules_sql()}) AS failed_rules FROM listings)"""


@query("q18_record_validation", f"""{WITH_BASE},
{VALIDATION_SQL}
SELECT {KEYS_SQL}, failed_rules, failed_rules = '' AS accepted FROM v""")
def q18_record_validation(spark, sf_dir):
    """Q-18 / Q-19: failed rule names per record; accepted when none failed."""
    v = Q.validate_records(raw(spark, sf_dir))
    return v.select(*KEYS, "failed_rules", "accepted")


@query("q19_sold_before_registration", f"""{WITH_BASE}
SELECT data_split, {I('count(*)', 'n_rows')},
  {I("count(CASE WHEN CAST(sold_at AS DATE) < CAST(registration_date AS DATE) THEN 1 END)", 'n_violations')},
  {R("count(CASE WHEN CAST(sold_at AS DATE) < CAST(registration_date AS DATE) THEN 1 END) * 100.0 / count(*)", 'violation_pct')}
FROM base GROUP BY data_split""")
def q19_sold_before_registration(spark, sf_dir):
    """Q-19: sales dated before the registration, per split."""
    b = P.base(spark, sf_dir)
    bad = parse_date("sold_at") < parse_date("registration_date")
    return b.groupBy("data_split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(bad, 1)).alias("n_violations"),
        F.try_divide(F.count(F.when(bad, 1)) * 100.0, F.count(F.lit(1))).alias("violation_pct"),
    )


@query("q20_overview", f"""{WITH_BASE}
{' UNION ALL '.join(f"SELECT {i} AS position, '{c}' AS column_name, {I(f'count({c})', 'non_null')}, {I('count(*)', 'n_rows')} FROM listings" for i, c in enumerate(RAW))}""")
def q20_overview(spark, sf_dir):
    """Q-20: column positions and names, non-null count per column (one pass), row count."""
    return Q.overview(raw(spark, sf_dir))


@query("q21_drop_corrupted", f"""{WITH_BASE},
s AS (SELECT count(*) AS n, count(CASE WHEN mileage < 0 THEN 1 END) AS bad FROM listings)
SELECT {I('n', 'n_rows')}, {I('bad', 'n_corrupt')}, {R('bad * 100.0 / n', 'corrupt_pct')},
  bad * 100.0 / n <= {K.MAX_CORRUPT_SHARE_PCT} AS dropped,
  {I(f'CASE WHEN bad * 100.0 / n <= {K.MAX_CORRUPT_SHARE_PCT} THEN n - bad ELSE n END', 'n_kept')}
FROM s""")
def q21_drop_corrupted(spark, sf_dir):
    """Q-21: negative-mileage rows are dropped when their share is small (<= 5 %)."""
    kept, summary = Q.drop_corrupted(raw(spark, sf_dir))
    return summary


@query("q21_kept_rows", f"""{WITH_BASE},
s AS (SELECT count(*) AS n, count(CASE WHEN mileage < 0 THEN 1 END) AS bad FROM listings)
SELECT order_key, line_number, part_key, supp_key, {R('mileage', 'mileage')} FROM listings CROSS JOIN s
WHERE bad * 100.0 / n > {K.MAX_CORRUPT_SHARE_PCT} OR mileage IS NULL OR mileage >= 0""")
def q21_kept_rows(spark, sf_dir):
    """Q-21: the rows that stay after negative mileages were dropped."""
    kept, _ = Q.drop_corrupted(raw(spark, sf_dir))
    return kept.select("order_key", "line_number", "part_key", "supp_key", "mileage")
