"""Data-quality operators (Q-01 ... Q-21).

Pattern: one aggregate row with every statistic (a single pass; partial
aggregation on the map side), then ``unpivot`` into long rows when the
result is per column.  Metadata checks (column names) read the schema only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.functions.exprs import adjusted_skewness, parse_date
from resale.operators import quantiles


def schema_check(df: DataFrame, expected: list[str]) -> DataFrame:
    """Q-01: (column_name, status, n_values) with present / missing / extra; one aggregate counts the values of all columns."""
    names = df.columns
    counts = df.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "column_name", "n_values")
    known = F.when(F.col("column_name").isin(expected), "present").otherwise("extra")
    missing = df.sparkSession.createDataFrame([(c, 0, "missing") for c in expected if c not in names], "column_name string, n_values long, status string")
    return counts.withColumn("status", known).unionByName(missing)


def infinity_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q-03: ±inf count per numeric column."""
    wide = df.agg(*[F.count(F.when(F.abs(F.col(c)) == float("inf"), 1)).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "inf_count")


def null_counts(df: DataFrame, nan_columns: list[str]) -> DataFrame:
    """Q-04: null (NaN counts as null for double columns) count and per cent per column."""
    def is_missing(c):
        cond = F.col(c).isNull()
        return cond | F.isnan(c) if c in nan_columns else cond

    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.when(is_missing(c), 1)).alias(c) for c in cols])
    long = wide.unpivot(["_n"], cols, "column_name", "null_count")
    return long.select("column_name", "null_count", F.try_divide(F.col("null_count") * 100.0, "_n").alias("null_pct"))


def missing_severity(nulls: DataFrame) -> DataFrame:
    """Q-05: severity of columns with any missing value."""
    pct = F.col("null_pct")
    sev = F.when(pct > K.MISSING_CRITICAL_PCT, "critical").when(pct > K.MISSING_WARNING_PCT, "warning").otherwise("minor")
    return nulls.where(F.col("null_count") > 0).select("column_name", "null_pct", sev.alias("severity"))


def range_check(df: DataFrame) -> DataFrame:
    """Q-06: price and mileage ranges with outcomes."""
    s = df.agg(F.min("price").alias("price_min"), F.max("price").alias("price_max"),
               F.min("mileage").alias("mileage_min"), F.max("mileage").alias("mileage_max"))
    lo, hi = K.PRICE_RANGE
    price = F.when((F.col("price_min") >= lo) & (F.col("price_max") <= hi), "pass").when(F.col("price_max") > hi, "warning_high").otherwise("warning_unusual")
    mlo, mhi = K.MILEAGE_RANGE
    mil = F.when((F.col("mileage_min") >= mlo) & (F.col("mileage_max") <= mhi), "pass").otherwise("warning_unusual")
    return s.select("*", price.alias("price_status"), mil.alias("mileage_status"))


def diversity(df: DataFrame, exact: bool = True) -> DataFrame:
    """Q-07: distinct prices, % unique, all-identical flag, distinct model keys and series.

    ``exact=False`` uses ``approx_count_distinct`` (HyperLogLog++, bounded memory).
    """
    cd = F.count_distinct if exact else (lambda c: F.approx_count_distinct(c))
    s = df.agg(cd(F.col("price")).alias("distinct_prices"), F.count("price").alias("_n"),
               cd(F.col("model_key")).alias("distinct_model_keys"), cd(F.col("series")).alias("distinct_series"))
    return s.select(
        "distinct_prices", F.try_divide(F.col("distinct_prices") * 100.0, "_n").alias("unique_pct"),
        (F.col("distinct_prices") == 1).alias("all_identical"), "distinct_model_keys", "distinct_series",
    )


def zero_share(df: DataFrame) -> DataFrame:
    """Q-08: zero mileage count and share, with the 100 % and > 10 % flags."""
    s = df.agg(F.count(F.when(F.col("mileage") == 0, 1)).alias("zero_mileage"), F.count(F.lit(1)).alias("_n"))
    pct = F.try_divide(F.col("zero_mileage") * 100.0, "_n")
    return s.select("zero_mileage", pct.alias("zero_pct"), (pct == 100).alias("all_zero"), (pct > K.ZERO_MILEAGE_WARN_PCT).alias("high_zero"))


def temporal_span(df: DataFrame) -> DataFrame:
    """Q-09: min / max registration year, span, grade."""
    s = df.agg(F.min("registration_year").alias("year_min"), F.max("registration_year").alias("year_max"))
    span = F.col("year_max") - F.col("year_min")
    grade = F.when(span >= 5, "good").when(span >= 3, "moderate").otherwise("limited")
    return s.select("year_min", "year_max", span.alias("span"), grade.alias("grade"))


def future_old_dates(df: DataFrame, as_of_year=None) -> DataFrame:
    """Q-10: registrations after the as-of year (default: latest sale year) and before 1990."""
    if as_of_year is None:
        now = df.agg(F.year(F.max(F.to_date("sold_at"))).alias("as_of_year"))
    else:
        now = df.sparkSession.range(1).select(F.lit(as_of_year).alias("as_of_year"))
    d = df.crossJoin(F.broadcast(now))  # one row
    return d.groupBy("as_of_year").agg(
        F.count(F.when(F.col("registration_year") > F.col("as_of_year"), 1)).alias("n_future"),
        F.count(F.when(F.col("registration_year") < K.OLDEST_YEAR, 1)).alias("n_very_old"),
    )


def value_counts(df: DataFrame) -> DataFrame:
    """Q-11: top-15 model keys (count desc, key asc) and rows per series and per tier."""
    mk = df.groupBy(F.col("model_key").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    top = mk.orderBy(F.desc("n"), F.asc("value")).limit(K.TOP_MODEL_KEYS).select(F.lit("model_key").alias("dimension"), "value", "n")
    ser = df.groupBy(F.col("series").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("series").alias("dimension"), "value", "n")
    tier = df.groupBy(F.col("luxury_tier").cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("luxury_tier").alias("dimension"), "value", "n")
    return top.unionByName(ser).unionByName(tier)


def known_codes(df: DataFrame, codes: list[str]) -> DataFrame:
    """Q-12: whether each known code occurs as a substring of some model key."""
    wide = df.agg(*[F.coalesce(F.bool_or(F.col("model_key").contains(c)), F.lit(False)).alias(c) for c in codes])
    return wide.unpivot([], codes, "code", "found")


def category_distribution(df: DataFrame, cats: list[str]) -> DataFrame:
    """Q-13: count and share per category value; rare below 5 %."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cats])))
    c = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    t = c.groupBy("feature").agg(F.sum("n").alias("_t"))
    j = c.join(F.broadcast(t), "feature")  # one row per categorical column
    pct = F.try_divide(F.col("n") * 100.0, "_t")
    return j.select("feature", "value", "n", pct.alias("pct"), (pct < K.RARE_SHARE_PCT).alias("rare"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q-14: count, mean, std (n-1), min, exact quartiles, max per column, one aggregate."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(c).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    wide = df.agg(*aggs)
    stats = ["n", "mean", "std", "min", "max"]
    rows = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{s}").cast("double" if s != "n" else "long").alias(s) for s in stats])
        for c in columns
    ]))
    q = quantiles.quartiles(df, columns).select("column_name", F.col("q1").alias("p25"), F.col("median").alias("p50"), F.col("q3").alias("p75"))
    return wide.select(rows).join(q, "column_name", "left")


def named_stats(df: DataFrame) -> DataFrame:
    """Q-15: ranges and means of the two ratios; zero power and zero age counts."""
    return df.agg(
        F.min("mileage_per_power").alias("mpp_min"), F.max("mileage_per_power").alias("mpp_max"), F.avg("mileage_per_power").alias("mpp_mean"),
        F.min("power_age_ratio").alias("par_min"), F.max("power_age_ratio").alias("par_max"), F.avg("power_age_ratio").alias("par_mean"),
        F.count(F.when(F.col("engine_power") == 0, 1)).alias("zero_power"),
        F.count(F.when(F.col("car_age_years") == 0, 1)).alias("zero_age"),
    )


def verdict(df: DataFrame, raw_cols: list[str], nan_cols: list[str], expected: list[str]) -> DataFrame:
    """Q-16: check rows and verdict (PROCEED iff no critical), from one aggregate pass."""
    n_missing_cols = len([c for c in expected if c not in set(df.columns)])
    def is_missing(c):
        cond = F.col(c).isNull()
        return cond | F.isnan(c) if c in nan_cols else cond

    s = df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("price").alias("pmin"), F.max("price").alias("pmax"),
        F.min("mileage").alias("mmin"), F.max("mileage").alias("mmax"),
        (F.max("registration_year") - F.min("registration_year")).alias("span"), F.max("registration_year").alias("ymax"),
        F.year(F.max(F.to_date("sold_at"))).alias("as_of_year"),
        F.greatest(*[F.count(F.when(is_missing(c), 1)) for c in raw_cols]).alias("max_nulls"),
    )
    pct = F.try_divide(F.col("max_nulls") * 100.0, "n_rows")
    checks = [
        ("columns", F.lit("pass" if n_missing_cols == 0 else "critical")),
        ("row_count", F.when(F.col("n_rows") >= K.MIN_ROWS, "pass").otherwise("critical")),
        ("price_range", F.when((F.col("pmin") >= K.PRICE_RANGE[0]) & (F.col("pmax") <= K.PRICE_RANGE[1]), "pass").otherwise("warning")),
        ("mileage_range", F.when((F.col("mmin") >= K.MILEAGE_RANGE[0]) & (F.col("mmax") <= K.MILEAGE_RANGE[1]), "pass").otherwise("warning")),
        ("temporal_span", F.when(F.col("span") >= 5, "pass").otherwise("warning")),
        ("future_dates", F.when(F.col("ymax") <= F.col("as_of_year"), "pass").otherwise("critical")),
        ("missing_data", F.when(pct == 0, "pass").when(pct > K.MISSING_CRITICAL_PCT, "critical").otherwise("warning")),
    ]
    long = s.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), c.alias("status")) for n, c in checks])))
    v = long.agg(F.when(F.bool_or(F.col("status") == "critical"), "STOP").otherwise("PROCEED").alias("status")).select(
        F.lit("verdict").alias("check_name"), "status")
    return long.unionByName(v)


def before_after(raw: DataFrame, clean: DataFrame, params: DataFrame) -> DataFrame:
    """Q-17: raw vs clean price profile and rows beyond / at the price cap."""
    cap = F.broadcast(params.select("price_cap"))  # one row

    def prof(df, stage, log_col, at_cap):
        d = df.crossJoin(cap)
        median = quantiles.wide(df, {"price_median": ("price", 0.5)})
        return d.agg(
            F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("n_rows"), F.avg("price").alias("price_mean"),
            F.stddev_samp("price").alias("price_std"),
            adjusted_skewness(F.col("price")).alias("price_skew"), adjusted_skewness(log_col).alias("log_price_skew"),
            F.count(F.when(at_cap, 1)).alias("rows_at_cap"),
        ).crossJoin(median)  # one row each

    a = prof(raw, "raw", F.log1p("price"), F.col("price") > F.col("price_cap"))
    b = prof(clean, "clean", F.col("price_log"), F.col("price") == F.col("price_cap"))
    return a.unionByName(b)


def validation_rules():
    """Q-18 / Q-19 rule list: (name, failing condition)."""
    reg, sold = parse_date("registration_date"), parse_date("sold_at")
    return [
        ("mileage_missing", F.col("mileage").isNull()),
        ("mileage_negative", F.col("mileage") < 0),
        ("power_missing", F.col("engine_power").isNull()),
        ("power_not_positive", F.col("engine_power") <= 0),
        ("registration_date_invalid", reg.isNull()),
        ("fuel_invalid", F.col("fuel").isNull() | ~F.lower("fuel").isin(K.FIXTURE_FUELS)),
        ("car_type_invalid", F.col("car_type").isNull() | ~F.lower("car_type").isin(K.FIXTURE_CAR_TYPES)),
        ("sold_before_registration", sold < reg),
    ]


def validate_records(df: DataFrame) -> DataFrame:
    """Q-18: failed rule names (comma list, empty when clean) and the accepted flag."""
    names = F.array_compact(F.array(*[F.when(cond, F.lit(n)) for n, cond in validation_rules()]))
    out = df.withColumn("failed_rules", F.array_join(names, ","))
    return out.withColumn("accepted", F.col("failed_rules") == "")


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and quarantined rows (with their reasons)."""
    v = validate_records(df)
    return v.where("accepted").drop("failed_rules", "accepted"), v.where(~F.col("accepted"))


def overview(df: DataFrame) -> DataFrame:
    """Q-20: (position, column_name, non_null, n_rows), non-null counts in one pass."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in cols])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(i).cast("long").alias("position"), F.lit(c).alias("column_name"), F.col(c).alias("non_null"), F.col("_n").alias("n_rows"))
        for i, c in enumerate(cols)
    ])))


def drop_corrupted(df: DataFrame, max_pct: float = K.MAX_CORRUPT_SHARE_PCT) -> tuple[DataFrame, DataFrame]:
    """Q-21: drop negative-mileage rows when their share is at most ``max_pct``.

    The share is one aggregate (1 row, broadcast) and the filter stays lazy.
    """
    s = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("mileage") < 0, 1)).alias("n_corrupt"))
    s = s.withColumn("corrupt_pct", F.try_divide(F.col("n_corrupt") * 100.0, "n_rows")).withColumn("dropped", F.coalesce(F.col("corrupt_pct") <= max_pct, F.lit(False)))
    kept = df.crossJoin(F.broadcast(s.select("dropped"))).where(~(F.col("dropped") & F.coalesce(F.col("mileage") < 0, F.lit(False)))).drop("dropped")
    summary = s.withColumn("n_kept", F.when(F.col("dropped"), F.col("n_rows") - F.col("n_corrupt")).otherwise(F.col("n_rows")))
    return kept, summary.select("n_rows", "n_corrupt", "corrupt_pct", "dropped", "n_kept")
