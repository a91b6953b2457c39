"""Oracle SQL (DuckDB dialect) for the prepared tables.

The CTE chain below states, in plain SQL over the driver tables, the same
stages the Spark plan builds: listings, split, row features, learned
parameters and encodings (train only), processed table, baseline
predictions and residual columns.  Query oracles append their own SELECT.
The rule lists come from :mod:`resale.functions.constants`, so both sides
use the same fixed values.
"""

from __future__ import annotations

from resale.functions import constants as K


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def series_case(text: str) -> str:
    whens = []
    for label, needles in K.SERIES_RULES:
        cond = " OR ".join(f"contains({text}, {_q(n)})" for n in needles)
        whens.append(f"WHEN {cond} THEN {_q(label)}")
    return "CASE " + " ".join(whens) + f" ELSE {_q(K.SERIES_DEFAULT)} END"


def tier_case(col: str) -> str:
    whens = [f"WHEN {col} IN ({', '.join(_q(s) for s in labels)}) THEN {tier}" for tier, labels in K.LUXURY_TIERS.items()]
    return "CAST(CASE " + " ".join(whens) + f" ELSE {K.LUXURY_DEFAULT} END AS INTEGER)"


def md5_bucket(expr: str, salt: str | None = None, modulus: int = 100) -> str:
    text = f"CAST({expr} AS VARCHAR)" if salt is None else f"(CAST({expr} AS VARCHAR) || {_q(salt)})"
    return f"CAST(('0x' || substr(md5({text}), 1, 8))::BIGINT % {modulus} AS BIGINT)"


_MODEL_KEYS = "[" + ", ".join(_q(k) for k in K.LISTING_MODEL_KEYS) + "]"
_FEATURE_BITS = ",\n    ".join(f"(l.l_suppkey & {1 << (k - 1)}) <> 0 AS feature_{k}" for k in range(1, 9))

LISTINGS = f"""listings AS (
  SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_number, l.l_partkey AS part_key, l.l_suppkey AS supp_key,
    'MAKER' AS maker_key,
    {_MODEL_KEYS}[l.l_partkey % {len(K.LISTING_MODEL_KEYS)} + 1] AS model_key,
    CASE WHEN l.l_suppkey % 50 = 0 THEN NULL WHEN l.l_suppkey % 50 = 1 THEN -l.l_quantity ELSE l.l_quantity * 5000 END AS mileage,
    CASE WHEN l.l_partkey % 97 = 0 THEN NULL WHEN l.l_partkey % 97 = 1 THEN -1 WHEN l.l_partkey % 97 = 2 THEN 0 ELSE 60 + p.p_size * 5 END AS engine_power,
    CAST(CAST(o.o_orderdate AS DATE) - CAST((p.p_size % 12) * 365 AS INTEGER) AS VARCHAR) AS registration_date,
    lower(p.p_type) AS fuel,
    l.l_returnflag || l.l_linestatus AS paint_color,
    o.o_orderpriority AS car_type,
    {_FEATURE_BITS},
    (CAST(8000 AS DOUBLE) + p.p_size * 700 + (l.l_partkey % 27) * 900)
      * ((1000 - 45 * (p.p_size % 12)) * (1000 - 8 * l.l_quantity) / CAST(1000000 AS DOUBLE))
      + (floor(l.l_extendedprice) % 4001 - 2000) AS price,
    CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS sold_at,
    {md5_bucket('l.l_orderkey')} AS bucket
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
)"""

BASE = f"""base0 AS (
  SELECT *,
    CASE WHEN bucket < {K.TRAIN_SHARE} THEN 'train' WHEN bucket < {K.TRAIN_SHARE + K.VAL_SHARE} THEN 'val' ELSE 'test' END AS data_split,
    {series_case("upper(coalesce(CAST(model_key AS VARCHAR), 'nan'))")} AS series,
    CAST(try_strptime(registration_date, '%Y-%m-%d') AS DATE) AS _reg,
    CAST(try_strptime(sold_at, '%Y-%m-%d') AS DATE) AS _sold
  FROM listings
),
base AS (
  SELECT * EXCLUDE (_reg, _sold),
    {tier_case('series')} AS luxury_tier,
    CAST(({tier_case('series')}) >= 3 AS INTEGER) AS is_luxury,
    CAST(series = 'M_series' AS INTEGER) AS is_performance,
    year(_reg) AS registration_year, month(_reg) AS registration_month, quarter(_reg) AS registration_quarter,
    CAST(coalesce(month(_reg) IN (6, 7, 8), false) AS INTEGER) AS is_summer_registration,
    CAST(coalesce(month(_reg) IN (11, 12), false) AS INTEGER) AS is_year_end_registration,
    CASE WHEN datediff('day', _reg, _sold) IS NULL THEN NULL ELSE greatest(datediff('day', _reg, _sold) / 365.25, 0.0) END AS age_raw
  FROM base0
)"""

PARAMS = """params AS (
  SELECT quantile_cont(mileage, 0.99) AS mileage_cap,
    quantile_cont(price, 0.01) AS price_floor,
    quantile_cont(price, 0.99) AS price_cap,
    quantile_cont(mileage, 0.5) AS median_mileage,
    quantile_cont(CAST(engine_power AS DOUBLE), 0.5) AS median_engine_power,
    quantile_cont(age_raw, 0.5) AS median_age
  FROM base WHERE data_split = 'train'
),
enc AS (
  SELECT 'fuel' AS feature, fuel AS category, avg(price) AS encoded FROM base WHERE data_split = 'train' AND fuel IS NOT NULL GROUP BY fuel
  UNION ALL SELECT 'color', paint_color, avg(price) FROM base WHERE data_split = 'train' AND paint_color IS NOT NULL GROUP BY paint_color
  UNION ALL SELECT 'car_type', car_type, avg(price) FROM base WHERE data_split = 'train' AND car_type IS NOT NULL GROUP BY car_type
)"""

PROCESSED = """feat AS (
  SELECT b.*, coalesce(b.age_raw, p.median_age) AS car_age_years, p.*
  FROM base b CROSS JOIN params p
),
feat2 AS (
  SELECT *,
    car_age_years * mileage / 10000 AS age_mileage_interaction,
    mileage / nullif(engine_power + 1, 0) AS mileage_per_power,
    mileage / nullif(car_age_years + 1, 0) AS annual_mileage,
    CAST(engine_power AS DOUBLE) / nullif(car_age_years + 1, 0) AS power_age_ratio,
    is_luxury * mileage / 10000 AS luxury_mileage_interaction,
    is_luxury * car_age_years AS luxury_age_interaction,
    CAST(coalesce(mileage / nullif(car_age_years + 1, 0) > 25000, false) AS INTEGER) AS is_high_mileage,
    CAST(coalesce(car_age_years > 8, false) AS INTEGER) AS is_old_car
  FROM feat
),
rep1 AS (
  SELECT *,
    CASE WHEN coalesce(mileage, median_mileage) < 0 THEN 0.0 ELSE coalesce(mileage, median_mileage) END AS _m1,
    coalesce(CAST(engine_power AS DOUBLE), median_engine_power) AS _p1
  FROM feat2
),
rep2 AS (
  SELECT * EXCLUDE (mileage, engine_power, price, _m1, _p1),
    CASE WHEN _m1 > mileage_cap THEN mileage_cap ELSE _m1 END AS mileage,
    CASE WHEN _p1 < 0 THEN median_engine_power ELSE _p1 END AS engine_power,
    CASE WHEN price < price_floor THEN price_floor WHEN price > price_cap THEN price_cap ELSE price END AS price
  FROM rep1
),
encj AS (
  SELECT r.*, ef.encoded AS _fe, ec.encoded AS _ce, et.encoded AS _te
  FROM rep2 r
  LEFT JOIN enc ef ON ef.feature = 'fuel' AND ef.category = r.fuel
  LEFT JOIN enc ec ON ec.feature = 'color' AND ec.category = r.paint_color
  LEFT JOIN enc et ON et.feature = 'car_type' AND et.category = r.car_type
),
processed AS (
  SELECT * EXCLUDE (_fe, _ce, _te, mileage_cap, price_floor, price_cap, median_mileage, median_engine_power, median_age, age_raw),
    coalesce(_fe, avg(_fe) OVER (PARTITION BY data_split)) AS fuel_encoded,
    coalesce(_ce, avg(_ce) OVER (PARTITION BY data_split)) AS color_encoded,
    coalesce(_te, avg(_te) OVER (PARTITION BY data_split)) AS car_type_encoded,
    ln(1 + price) AS price_log
  FROM encj
)"""

SCORED = """bfit AS (
  SELECT series, fuel, sum(price_log) AS sum_log, count(*) AS n FROM processed WHERE data_split = 'train' GROUP BY series, fuel
),
bs AS (SELECT series, sum(sum_log) / sum(n) AS p_s FROM bfit GROUP BY series),
bg AS (SELECT sum(sum_log) / sum(n) AS p_g FROM bfit),
preds AS (
  SELECT pr.*, bg.p_g AS pred_baseline_global, coalesce(bs.p_s, bg.p_g) AS pred_baseline_series,
    coalesce(bf.sum_log / bf.n, bs.p_s, bg.p_g) AS pred_baseline_series_fuel
  FROM processed pr
  LEFT JOIN bfit bf ON bf.series = pr.series AND bf.fuel = pr.fuel
  LEFT JOIN bs ON bs.series = pr.series
  CROSS JOIN bg
),
scored0 AS (
  SELECT *, 'baseline_global' AS model_id, pred_baseline_global AS predicted_log FROM preds
  UNION ALL SELECT *, 'baseline_series' AS model_id, pred_baseline_series AS predicted_log FROM preds
  UNION ALL SELECT *, 'baseline_series_fuel' AS model_id, pred_baseline_series_fuel AS predicted_log FROM preds
),
scored AS (
  SELECT *, price AS actual_euro, exp(predicted_log) - 1 AS predicted_euro,
    price - (exp(predicted_log) - 1) AS residual_euro,
    abs(price - (exp(predicted_log) - 1)) AS abs_residual_euro,
    abs((price - (exp(predicted_log) - 1)) / nullif(price, 0)) * 100 AS ape,
    coalesce(abs((price - (exp(predicted_log) - 1)) / nullif(price, 0)) * 100 > 5.0, false) AS in_tail
  FROM scored0
)"""

WITH_LISTINGS = "WITH " + LISTINGS
WITH_BASE = WITH_LISTINGS + ",\n" + BASE
WITH_PARAMS = WITH_BASE + ",\n" + PARAMS
WITH_PROCESSED = WITH_PARAMS + ",\n" + PROCESSED
WITH_SCORED = WITH_PROCESSED + ",\n" + SCORED
