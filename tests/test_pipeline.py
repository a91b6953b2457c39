"""Properties of the prepared tables and end-to-end checks on the driver tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.operators import params
from resale.plans import catalog
from resale.plans import prepared as P
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck


def test_splits_disjoint_and_complete(spark):
    b = P.base(spark, SF_SMALL)
    from resale.sources.tables import listings

    n = listings(spark, SF_SMALL).count()
    counts = {r.data_split: r["count"] for r in b.groupBy("data_split").count().collect()}
    assert set(counts) == {"train", "val", "test"} and sum(counts.values()) == n
    # an order never spans two splits
    per_order = b.groupBy("order_key").agg(F.countDistinct("data_split").alias("k"))
    assert per_order.where("k > 1").count() == 0


def test_params_do_not_see_val_or_test(spark):
    # Leak test: changing val/test rows leaves the learned parameters unchanged.
    b = P.base(spark, SF_SMALL)
    base_params = params.learn(b.where("data_split = 'train'")).collect()[0]
    changed = b.withColumn("price", F.when(F.col("data_split") != "train", F.col("price") * 1000).otherwise(F.col("price")))
    new_params = params.learn(changed.where("data_split = 'train'")).collect()[0]
    assert base_params == new_params


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) == 9 and set(df.columns) >= {"model_id", "data_split", "mae", "tail_rate"}


def test_every_query_has_doc_and_oracle_names_match():
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 120
    for name, fn in qs.items():
        assert fn.__doc__, name


FAST = [
    "m08_all_metrics", "m10_mispricing_cost", "e02_target_encoding_apply", "f02_series", "q16_verdict",
    "a10_histogram", "r05_segment_stats", "d02_kl_divergence", "g02_threshold_gate", "p01_batch_scoring", "s11_golden_set",
]


@pytest.mark.parametrize("name", FAST)
def test_oracle_small(spark, name):
    sdf = catalog.queries()[name](spark, SF_SMALL).toPandas()
    odf = duck(SF_SMALL).execute(catalog.oracle_sql()[name]).fetchdf()
    assert compare(sdf, odf) == "ok"


def test_stream_equals_batch(spark):
    qs = catalog.queries()
    batch = qs["p01_batch_scoring"](spark, SF_SMALL).toPandas()
    stream = qs["p02_streaming_scoring"](spark, SF_SMALL).toPandas()
    assert compare(batch, stream) == "ok"


def test_streaming_drift_equals_batch_on_closed_windows(spark):
    from resale.operators.monitor import weekly_drift
    from resale.sources.tables import table

    s = catalog.queries()["p03_streaming_weekly_drift"](spark, SF_SMALL).toPandas()
    ev = table(spark, SF_SMALL, "events", ["ts", "event_type", "value"])
    b = ev.groupBy("event_type", F.window("ts", "7 days").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    b = {(r.event_type, r.w.start.strftime("%Y-%m-%d %H:%M:%S")): r.n for r in b.collect()}
    assert len(s) > 0
    for r in s.itertuples():
        assert b[(r.event_type, r.window_start)] == r.n
    assert weekly_drift(ev).count() == len(b)


def test_gate_monotone_in_thresholds(spark):
    from resale.operators import selection
    from resale.plans.q_sources import golden_set

    gm = selection.golden_metrics(spark, SF_SMALL, golden_set(spark, SF_SMALL))
    strict = [(m, v / 10 if not hib else v * 10, hib) for m, v, hib in K.GATE_THRESHOLDS]
    loose = [(m, v * 10 if not hib else -1e9, hib) for m, v, hib in K.GATE_THRESHOLDS]
    n_strict = selection.gate(gm, strict).where("passed").count()
    n_base = selection.gate(gm, K.GATE_THRESHOLDS).where("passed").count()
    n_loose = selection.gate(gm, loose).where("passed").count()
    assert n_strict <= n_base <= n_loose


def test_trained_models_beat_the_baseline_on_validation(spark):
    # The listing price follows power, model, age and mileage (FIXTURES §2), so a model that learns must show it.
    qs = catalog.queries()
    base = {(r.model_id, r.data_split): r.mae for r in qs["m08_all_metrics"](spark, SF_SMALL).collect()}
    for name in ("t01_random_forest", "t02_boosted_trees"):
        rows = {r.data_split: r for r in qs[name](spark, SF_SMALL).collect()}
        assert rows["val"].mae < base[("baseline_series_fuel", "val")]
        assert rows["val"].r2 > 0.5
    assert rows["val"].rounds > 20
    curve = qs["t04_learning_curve"](spark, SF_SMALL).collect()
    assert len(curve) == K.BOOST_PARAMS["maxIter"] and sum(r.is_best for r in curve) == 1


def test_saved_package_scores_like_the_session(spark):
    row = catalog.queries()["s09_model_persistence"](spark, SF_SMALL).collect()[0]
    assert row.n_rows > 0 and row.max_abs_diff == 0
    scored = catalog.queries()["p01_forest_scoring"](spark, SF_SMALL)
    assert scored.where("accepted and (predicted_euro is null or lower > predicted_euro)").count() == 0
    assert scored.where("not accepted and predicted_euro is not null").count() == 0


def test_gate_raises(spark):
    from resale.operators import selection

    gated = catalog.queries()["g02_model_gate"](spark, SF_SMALL)
    rows = spark.createDataFrame([("m", 1.0)], "model_id string, mae double")
    selection.assert_gate(selection.gate(rows, [("mae", 2.0, False)]))
    with pytest.raises(RuntimeError):
        selection.assert_gate(selection.gate(rows, [("mae", 0.5, False)]))
    assert gated.select("model_id").distinct().count() == 2


def test_overfit_gap_and_recommendations_use_unrounded_values(spark):
    from resale.operators import residuals, selection

    m = spark.createDataFrame([("a", "train", 1000.0), ("a", "val", 400.0), ("b", "train", 1000.0), ("b", "val", 1400.0)], "model_id string, data_split string, mae double")
    assert {r.model_id: r.healthy for r in selection.overfit_gap(m).collect()} == {"a": False, "b": True}
    tails = [(10.0 * i, 10.0 * i, 1.0, 6.0 if i < 503 else 1.0, i < 503) for i in range(1000)]
    df = spark.createDataFrame(tails, "actual_euro double, predicted_euro double, abs_residual_euro double, ape double, in_tail boolean").where("actual_euro > 0")
    assert {r.rule: r.triggered for r in residuals.recommendations(df).collect()}["worst_segment"]


def test_streamed_events_in_any_order_give_the_batch_windows(spark, tmp_path):
    from resale.sources.tables import table
    from resale.streaming import jobs

    ev = table(spark, SF_SMALL, "events", ["ts", "event_type", "value"]).withColumn("ts", F.col("ts").cast("timestamp"))
    ev.orderBy(F.xxhash64("ts", "value")).repartition(9).write.parquet(f"{tmp_path}/in")
    jobs.streaming_weekly_drift(spark, f"{tmp_path}/in", ev.schema, f"{tmp_path}/out", f"{tmp_path}/ckpt")
    got = {(r.event_type, r.window_start, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    end = ev.agg(F.max("ts")).first()[0]
    b = ev.groupBy("event_type", F.window("ts", "7 days").alias("w")).count().where(F.col("w.end") <= F.lit(end) - F.expr("interval 1 day"))
    assert got == {(r.event_type, r.w.start, r["count"]) for r in b.collect()} and got


def test_bounded_quantiles_equal_numpy(spark):
    import numpy as np

    from resale.operators import quantiles

    rng = np.random.default_rng(1)
    x = rng.normal(size=30_000)
    rows = [("a" if i % 10 else "b", float(v)) for i, v in enumerate(x)] + [("c", None), ("d", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(23)
    wanted = {f"q{i}": ("x", q) for i, q in enumerate((0.0, 0.01, 0.25, 0.5, 0.99, 1.0))}
    got = quantiles.wide(df, wanted).first()
    known = np.array([v for _, v in rows if v is not None])
    assert all(abs(got[k] - np.quantile(known, q)) < 1e-9 for k, (_, q) in wanted.items())
    for r in quantiles.wide(df, wanted, ["g"]).collect():
        part = np.array([v for g, v in rows if g == r.g and v is not None])
        assert all(abs(r[k] - np.quantile(part, q)) < 1e-9 for k, (_, q) in wanted.items())
