"""Unit tests on hand-made frames: one per semantics trap and rule list."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.functions.exprs import finalize, parse_date, series_of
from resale.functions.stats import f_sf
from resale.operators import encoders, features, metrics as M, quality, residuals, selection


def test_series_rules_order(spark):
    # T-05: "I8" contains 8 -> 8_series; M135 hits the 1-series list first; "X5 M" is X5.
    rows = [("X1",), ("320d",), ("I8",), ("i3",), ("M135i",), ("M3",), ("X5 M",), ("Z4",), ("850",), (None,), ("",), ("740",)]
    df = spark.createDataFrame(rows, "model_key string").withColumn("series", series_of("model_key"))
    got = {r.model_key: r.series for r in df.collect()}
    assert got["X1"] == "X1"
    assert got["320d"] == "3_series"
    assert got["I8"] == "8_series"
    assert got["i3"] == "i_series"
    assert got["M135i"] == "1_series"
    assert got["M3"] == "M_series"
    assert got["X5 M"] == "X5"
    assert got["Z4"] == "Z4"
    assert got["850"] == "8_series"
    assert got[None] == "other_series"
    assert got[""] == "other_series"
    assert got["740"] == "7_series"


def test_tier_and_flags(spark):
    df = spark.createDataFrame([("M3",), ("X5 M",), ("116",)], "model_key string")
    out = {r.model_key: r for r in features.segment_features(df).collect()}
    assert out["M3"].luxury_tier == 4 and out["M3"].is_performance == 1 and out["M3"].is_luxury == 1
    assert out["X5 M"].is_performance == 0 and out["X5 M"].luxury_tier == 3
    assert out["116"].luxury_tier == 1 and out["116"].is_luxury == 0


def test_bad_dates_and_null_flags(spark):
    # F-05 / T-14: bad text -> null date; null month -> flags 0; leap day parses.
    df = spark.createDataFrame(
        [("2015-13-01", "2018-01-01"), ("", "2018-01-01"), ("2016-02-29", "2018-03-01"), ("2016-07-01", "2015-01-01")],
        "registration_date string, sold_at string",
    )
    out = features.temporal_features(df).collect()
    assert out[0].registration_month is None and out[0].is_summer_registration == 0 and out[0].age_raw is None
    assert out[1].registration_year is None
    assert out[2].registration_month == 2
    assert out[3].is_summer_registration == 1
    assert out[3].age_raw == 0.0  # sold before registration: floored at 0 (not null)


def test_interactions_use_raw_values_and_null_safe_division(spark):
    # T-06 / F-10: interactions before repair; power -1 -> null ratio (no ANSI error).
    df = spark.createDataFrame([(2.0, -10.0, -1, 1)], "car_age_years double, mileage double, engine_power int, is_luxury int")
    r = features.interaction_features(df).collect()[0]
    assert r.age_mileage_interaction == pytest.approx(2.0 * -10.0 / 10000)
    assert r.mileage_per_power is None
    assert r.is_high_mileage == 0


def test_repair_order(spark):
    # F-15..F-17: fill, then fix negatives, then cap; price clamped both sides.
    df = spark.createDataFrame([(None, None, 1.0), (-5.0, -1, 99999.0), (500.0, 100, 50.0)], "mileage double, engine_power int, price double")
    p = {"median_mileage": F.lit(40.0), "median_engine_power": F.lit(120.5), "mileage_cap": F.lit(300.0),
         "price_floor": F.lit(10.0), "price_cap": F.lit(1000.0)}
    out = features.repair(df, p).collect()
    assert (out[0].mileage, out[0].engine_power, out[0].price) == (40.0, 120.5, 10.0)
    assert (out[1].mileage, out[1].engine_power, out[1].price) == (0.0, 120.5, 1000.0)
    assert (out[2].mileage, out[2].engine_power, out[2].price) == (300.0, 100.0, 50.0)
    assert out[2].price_log == pytest.approx(math.log1p(50.0))


def test_target_encoding_fill_rules(spark):
    # E-02 / E-03 / T-15: unseen -> split mean of matched rows (offline) or mean of category means (serving).
    df = spark.createDataFrame(
        [("a", "c1", "t1", 10.0, "train"), ("a", "c1", "t1", 20.0, "train"), ("b", "c1", "t1", 60.0, "train"),
         ("a", "c1", "t1", 0.0, "val"), ("zz", "c1", "t1", 0.0, "val"), (None, "c1", "t1", 0.0, "val")],
        "fuel string, paint_color string, car_type string, price double, data_split string",
    )
    fit = encoders.fit_target_encoding(df)
    enc = {(r.feature, r.category): r.encoded for r in fit.collect()}
    assert enc[("fuel", "a")] == 15.0 and enc[("fuel", "b")] == 60.0 and enc[("fuel", "zz")] is None
    off = encoders.apply_target_encoding(df, fit, encoders.split_fill(fit)).where("data_split = 'val'").collect()
    vals = sorted((r.fuel or "", r.fuel_encoded) for r in off)
    assert vals == [("", 15.0), ("a", 15.0), ("zz", 15.0)]  # only 'a' matched in val -> its mean
    serv = encoders.apply_target_encoding(df.drop("data_split"), fit, encoders.serving_fill(fit), by_split=False)
    got = {r.fuel: r.fuel_encoded for r in serv.collect()}
    assert got["zz"] == pytest.approx((15.0 + 60.0) / 2)


def test_label_encoder_unseen_and_nan(spark):
    # E-05 / E-06 / T-14: sorted codes, null reads 'nan', unseen -> -1.
    train = spark.createDataFrame([("b",), ("a",), (None,)], "fuel string")
    codes = encoders.fit_label_encoder(train, ["fuel"])
    got = {r.category: r.code for r in codes.collect()}
    assert got == {"a": 0, "b": 1, "nan": 2}
    test = spark.createDataFrame([("a",), ("q",), (None,)], "fuel string")
    out = {r.fuel: r.fuel_code for r in encoders.apply_label_encoder(test, codes, ["fuel"]).collect()}
    assert out == {"a": 0, "q": -1, None: 2}


def test_metrics_edge_cases(spark):
    # T-16: perfect prediction; constant target (R² null); no tail rows -> TC-APE 0.
    df = spark.createDataFrame([(100.0, 100.0, 4.0, 4.0), (100.0, 100.0, 4.0, 4.0)],
                               "actual_euro double, predicted_euro double, price_log double, predicted_log double")
    r = M.all_metrics(df, []).collect()[0]
    assert r.mae == 0.0 and r.rmse == 0.0 and r.r2 is None and r.tail_rate == 0.0 and r.tc_ape == 0.0 and r.tail_samples == 0
    df2 = spark.createDataFrame([(100.0, 90.0), (200.0, 199.0)], "actual_euro double, predicted_euro double")
    a, p = F.col("actual_euro"), F.col("predicted_euro")
    r2 = df2.agg(M.tail_rate(a, p).alias("t"), M.tc_ape(a, p).alias("c"), M.mape(a, p).alias("m")).collect()[0]
    assert r2.t == 50.0 and r2.c == pytest.approx(10.0) and r2.m == pytest.approx((10.0 + 0.5) / 2)


def test_targets_are_strict(spark):
    df = spark.createDataFrame([(2500.0, 2999.0, 0.9, 4.0, 10.0, 5.0)], "mae double, rmse double, r2 double, mape double, tail_rate double, tc_ape double")
    r = M.targets_met(df, []).collect()[0]
    assert r.mae_ok is False and r.rmse_ok is True and r.all_targets_met is False


def test_segments_right_closed_and_empty_kept(spark):
    # R-04 / R-05 / T-11: 20000 is Economy, 35000 Mid-Range, 50000 Premium; empty Luxury kept.
    df = spark.createDataFrame([(20000.0, 1.0, False), (35000.0, 6.0, True), (50000.0, 2.0, False)], "actual_euro double, ape double, in_tail boolean")
    seg = {r.segment: r for r in df.select(residuals.segment_label().alias("segment")).collect()}
    assert set(seg) == {"Economy (<€20K)", "Mid-Range (€20-35K)", "Premium (€35-50K)"}
    stats = {r.segment: r for r in residuals.segment_stats(df).collect()}
    assert stats["Luxury (>€50K)"].n == 0 and stats["Luxury (>€50K)"].tail_rate is None
    w = residuals.worst_segment(residuals.segment_stats(df)).collect()[0]
    assert w.segment == "Mid-Range (€20-35K)"


def test_gate_inclusive_and_skips_unknown_metrics(spark):
    # G-02 / T-03: value equal to the limit passes both ways; metric without threshold is skipped.
    df = spark.createDataFrame([("m", 2500.0, 0.70, 1.0)], "model_id string, mae double, r2 double, extra double")
    g = selection.gate(df, [("mae", 2500.0, False), ("r2", 0.70, True)]).collect()
    assert {r.metric for r in g} == {"mae", "r2"}
    assert all(r.passed for r in g) and all(r.gate_passed for r in g)


def test_vote_equality_goes_to_first(spark):
    df = spark.createDataFrame([("a", 10.0, 0.5, 20.0, 5.0), ("b", 10.0, 0.5, 20.0, 5.0)], "model_id string, mae double, r2 double, tail_rate double, mape double")
    r = selection.weighted_vote(df, "a", "b").collect()[0]
    assert (r.score_a, r.score_b, r.winner) == (8, 0, "a")


def test_validation_rules(spark):
    df = spark.createDataFrame(
        [(-1.0, 0, "2015-13-01", "x", "5-LOW", "2018-01-01"), (10.0, 100, "2010-01-01", "Large", "2-HIGH", "2009-01-01")],
        "mileage double, engine_power int, registration_date string, fuel string, car_type string, sold_at string",
    )
    out = quality.validate_records(df).collect()
    assert out[0].failed_rules == "mileage_negative,power_not_positive,registration_date_invalid,fuel_invalid"
    assert out[1].failed_rules == "sold_before_registration" and out[1].accepted is False


def test_finalize_rounding_is_engine_independent(spark):
    import duckdb

    from resale.plans.sqlhelp import R

    xs = [-0.00005, 0.00015, -0.0, 2.5e-5, 1234.56785, -7.77775, 0.1 + 0.2]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.x for r in finalize(df).collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT {R('x', 'y')} FROM (SELECT CAST(? AS DOUBLE) AS x)", [x]).fetchone()[0] for x in xs]
    assert [repr(g) for g in got] == [repr(w) for w in want]
    assert math.copysign(1, got[2]) == 1.0


def test_f_distribution_tail():
    # Known values: F(2, 10) at 4.1028 -> p = 0.05; F(1, 1) at 1 -> 0.5.
    assert f_sf(4.102821, 2, 10) == pytest.approx(0.05, abs=1e-5)
    assert f_sf(1.0, 1, 1) == pytest.approx(0.5, abs=1e-9)
    assert f_sf(0.0, 3, 7) == 1.0


def test_required_columns_alias(spark):
    df = spark.createDataFrame([("k", "m", "2010-01-01", "f", "c", "t", 1.0, 100, 2.0, "2018-01-01")],
                               "maker_key string, model_key string, registration_date string, fuel string, paint_color string, "
                               "car_type string, mileage double, power int, price double, sold_at string")
    assert "engine_power" in features.require_columns(df).columns
    with pytest.raises(ValueError):
        features.require_columns(df.drop("power", "price"))


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), (None,)], "v string")
    assert [r.v for r in features.coerce_numeric(df, ["v"]).collect()] == [12.5, 0.0, 0.0]


def test_label_codes_of_all_splits(spark):
    # E-06: the codes of train apply to every row of every split; the query equals its SQL.
    import oracle_check
    from conftest import SF_SMALL

    from resale.plans import catalog, prepared

    name = "e06_label_encoder_all_splits"
    got = catalog.queries()[name](spark, SF_SMALL).toPandas()
    rows = prepared.processed(spark, SF_SMALL).groupBy("data_split").count().collect()
    assert got.data_split.value_counts().to_dict() == {r["data_split"]: r["count"] for r in rows} and len(rows) == 3
    want = oracle_check.duck(SF_SMALL).execute(catalog.oracle_sql()[name]).fetchdf()
    assert oracle_check.compare(got, want) == "ok"
    assert (got[got.data_split == "train"].filter(like="_code") >= 0).all().all()
