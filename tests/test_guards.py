"""Constant columns, zero baselines and empty tables; one-scan moments, drift profiles and narrowed quantiles."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.operators import eda, moments, monitor, quantiles, residuals, selection
from resale.plans import catalog
from resale.plans import prepared as P
from resale.plans import q_monitor
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
GUARDED = [
    "a01_distribution_profile", "a04_iqr_outliers", "a06_target_correlation", "a07_strong_predictors", "a08_high_pairs", "a09_linear_trend", "a10_histogram", "a14_anova", "l07_leakage_audit", "r03_tail_vs_normal",
    "r09_error_correlations", "r11_heteroscedasticity", "r12_recommendations", "d01_mean_shift", "d02_kl_divergence", "d03_unknown_key_alarm", "d04_weekly_drift", "d05_retrain_decision", "m13_health_tier",
    "c01_model_comparison", "e02_target_encoding_apply", "e07_unknown_key_share", "q04_null_counts", "q07_diversity", "q08_zero_share", "q13_category_distribution", "q16_verdict", "q21_drop_corrupted", "s06_run_metadata",
]


@pytest.fixture(scope="module")
def odd_dirs(spark, tmp_path_factory):
    """The driver tables without a row, and with the same values in every row of the listing tables (and a zero event value)."""
    out = {}
    for kind in ("empty", "constant"):
        d = str(tmp_path_factory.mktemp(kind))
        for t in TABLES:
            df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
            if kind == "empty":
                df = df.where(F.lit(False))
            elif t == "lineitem":
                # 60 rows of one part with one price and quantity; the orders (and so the splits) differ
                keys = df.select("l_orderkey").distinct().orderBy("l_orderkey").limit(60)
                one = df.orderBy("l_orderkey", "l_linenumber").limit(1).drop("l_orderkey")
                df = keys.crossJoin(one).select(*df.columns)
            elif t == "orders":
                date = df.agg(F.min("o_orderdate")).first()[0]
                df = df.withColumn("o_orderdate", F.lit(date).cast(df.schema["o_orderdate"].dataType)).withColumn("o_orderpriority", F.lit("1-URGENT"))
            elif t == "events":
                df = df.withColumn("value", F.lit(0.0))
            df.write.parquet(f"{d}/{t}.parquet")
        out[kind] = d
    return out


@pytest.mark.parametrize("kind", ["empty", "constant"])
def test_queries_on_odd_tables(spark, odd_dirs, kind):
    qs = catalog.queries()
    for name in GUARDED:
        rows = qs[name](spark, odd_dirs[kind]).collect()
        if kind == "constant" and name in ("a06_target_correlation", "r09_error_correlations"):
            assert rows and all(r[1] is None for r in rows), name
        if name == "r11_heteroscedasticity":
            assert [r.heteroscedastic for r in rows] == [False]
        if name == "a08_high_pairs":
            assert rows == []


def test_shift_against_a_zero_baseline(spark):
    zero, some = (spark.createDataFrame([(v,), (v,)], "x double") for v in (0.0, 2.0))
    r = monitor.mean_shift(zero, some, [("x", "x", 0.2)]).first()
    assert r.baseline == 0 and r.shift_pct is None and r.alarm is None
    m = spark.createDataFrame([("a", 0.0, 0.0, 0.0, 1.0), ("b", 1.0, 0.5, 2.0, 1.0)], "model_id string, mae double, r2 double, tail_rate double, rmse double")
    assert selection.compare(m, "a", "b").first().mae_improvement_pct is None


def test_moments_equal_numpy(spark):
    rng = np.random.default_rng(5)
    n = 5000
    x = rng.normal(size=(n, 5)) * [1, 50, 1e-3, 1, 1] + [0, 1e6, 5, 0, 0]
    x[:, 3] = x[:, 0] * 2 + rng.normal(size=n) * 0.1
    x[:, 4] = 0.1  # constant
    missing = rng.random((n, 5)) < [0.0, 0.3, 0.1, 0.2, 0.1]
    missing[:1500, 1] = True  # no value in the first tasks
    rows = [tuple(None if m else float(v) for v, m in zip(r, k)) for r, k in zip(x, missing)]
    names = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(1).repartition(7)
    pairs = [(p, q) for i, p in enumerate(names) for q in names[i + 1 :]] + [("a", "a")]
    got = {(r.col_a, r.col_b): r for r in moments.matrix(df, pairs).collect()}
    for p, q in pairs:
        i, j = names.index(p), names.index(q)
        both = ~missing[:, i] & ~missing[:, j]
        r = got[p, q]
        assert r.n == both.sum()
        if "e" in (p, q):
            assert r.r is None
        else:
            assert abs(r.r - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9
            assert abs(r.mean_a - x[both, i].mean()) < 1e-9 * max(1, abs(x[both, i].mean()))
    # parts of any split merge to the whole
    parts = moments.partials(df.where("a < 0"), pairs).unionByName(moments.partials(df.where("a >= 0"), pairs))
    whole = {(r.a, r.b): r for r in moments.merge(moments.partials(df, pairs)).collect()}
    for r in moments.merge(parts).collect():
        assert r.n == whole[r.a, r.b].n and np.isclose(r.cab, whole[r.a, r.b].cab, rtol=1e-9, atol=1e-9)
    none = moments.matrix(df.where("a > 1e9"), [("a", "b")]).first()
    assert none.n == 0 and none.r is None
    assert spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double").agg(moments.safe_corr("a", "b")).first()[0] is None
    assert abs(df.agg(moments.safe_corr("a", "d")).first()[0] - got["a", "d"].r) < 1e-12


def test_correlations_are_one_scan(spark):
    t = P.processed(spark, SF_SMALL)
    plan = eda.correlation_pairs(t, ["price", "mileage", "engine_power", "car_age_years"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_profiles_add_up(spark):
    prof = q_monitor.drift_profile(spark, SF_SMALL)
    rows = q_monitor.mon_frame(spark, SF_SMALL)
    edges = monitor.bin_edges(rows.where("data_split = 'train'"), "price")
    p = P.learned_params(spark, SF_SMALL).first()
    e = edges.first()
    assert (e._lo, e._hi) == (p.price_floor, p.price_cap)
    args = ("data_split", edges, "price", {"m": "mileage"}, {"tail": "in_tail"}, residuals.segment_label(), {"sale": "sold_at"})
    halves = [monitor.profile(rows.where(c), *args) for c in ("part_key % 2 = 0", "part_key % 2 = 1")]
    merged = monitor.merge_profiles(halves[0].unionByName(halves[1]))
    key = lambda r: (r.period, r.bin if r.bin is not None else -1, r.segment or "")
    a, b = ({key(r): r for r in x.collect()} for x in (merged, monitor.profile(rows, *args)))
    assert set(a) == set(b) and all((a[k].n, a[k].m__n, a[k].tail__true, a[k].sale__last) == (b[k].n, b[k].m__n, b[k].tail__true, b[k].sale__last) and np.isclose(a[k].m__sum or 0, b[k].m__sum or 0) for k in a)
    assert prof.count() <= 3 * (K.HIST_BINS + 1) * 5
    for query in ("d01_mean_shift", "d02_kl_divergence", "d05_retrain_decision", "m13_health_tier"):
        plan = catalog.queries()[query](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "model_key" not in plan and "mileage#" not in plan  # the profile, not the rows


@pytest.mark.parametrize("bound", [60, 20])
def test_narrowed_quantiles_stay_exact(spark, monkeypatch, bound):
    rng = np.random.default_rng(2)
    x = np.r_[rng.normal(size=40_000), np.full(9000, 0.25), np.repeat(rng.integers(0, 5, 3), 2000)]
    rows = [("a" if i % 7 else "b", float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(11)
    wanted = {f"q{i}": ("x", q) for i, q in enumerate((0.0, 0.003, 0.25, 0.5, 0.61, 0.999, 1.0))}
    plain = quantiles.wide(df, wanted, ["g"]).orderBy("g").collect()
    passes = []
    kept = quantiles._stored
    monkeypatch.setattr(quantiles, "_stored", lambda small: passes.append(1) or kept(small))
    monkeypatch.setattr(quantiles, "MAX_BRACKET", bound)
    got = quantiles.wide(df, wanted, ["g"]).orderBy("g").collect()
    assert got == plain and len(passes) >= 3
    for r in got:
        part = np.array([v for g, v in rows if g == r.g])
        assert all(abs(r[k] - np.quantile(part, q)) < 1e-9 for k, (_, q) in wanted.items())


def test_stored_sketches_merge(spark):
    rng = np.random.default_rng(3)
    x = rng.gamma(2.0, size=20_000)
    df = spark.createDataFrame([(i % 5, float(v), None if i % 3 else float(-v)) for i, v in enumerate(x)], "day int, x double, y double")
    stored = quantiles.sketches(df, ["x", "y"], ["day"])
    got = {(r.name, r.level): r for r in quantiles.estimate(stored, [0.05, 0.5, 0.95]).collect()}
    for (name, level), r in got.items():
        part = np.sort(x if name == "x" else -x[::3])
        assert r.n == len(part) and abs(np.searchsorted(part, r.value) / len(part) - level) < 0.03
    assert len(got) == 6 and quantiles.estimate(stored.where("day < 2"), [0.5], ["day"]).count() == 4
