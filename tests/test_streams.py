"""Late rows, report store, and streams that are stopped and started again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from resale.operators import metrics as M
from resale.operators.scoring import fitted, score
from resale.plans import catalog
from resale.plans import q_streaming as Q
from resale.sources.reports import ReportStore
from resale.streaming import jobs
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck


@pytest.mark.parametrize("name", ["p03_streaming_late_windows", "p03_streaming_late_rows", "s08_report_store"])
def test_equal_to_sql(spark, name):
    got = catalog.queries()[name](spark, SF_SMALL).toPandas()
    assert len(got) and compare(got, duck(SF_SMALL).execute(catalog.oracle_sql()[name]).fetchdf()) == "ok"


def test_late_rows_are_the_ones_missing_from_the_windows(spark):
    windows, late = Q._replayed(spark, SF_SMALL)
    all_rows = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    whole = {(r.event_type, r.w.start): r["count"] for r in all_rows.groupBy("event_type", F.window("ts", "7 days").alias("w")).count().collect()}
    missing = {(r.event_type, r.w.start): r["count"] for r in late.groupBy("event_type", F.window("ts", "7 days").alias("w")).count().collect()}
    kept = {(r.event_type, r.window_start): r.n for r in windows.collect()}
    assert missing and kept
    for k, n in kept.items():
        assert n + missing.get(k, 0) == whole[k]
    assert late.where(F.window("ts", "7 days").getField("end") > F.col("watermark")).count() == 0


def test_report_store_is_idempotent_and_pruned(spark, tmp_path):
    store = ReportStore(spark, f"file://{tmp_path}/reports")
    rows = lambda d, v: spark.createDataFrame([("m1", d, v), ("m2", d, v + 1)], "model_id string, report_date string, mae double")
    store.append(rows("2024-01-01", 1.0), "a")
    store.append(rows("2024-02-01", 2.0), "b")
    store.append(rows("2024-02-01", 3.0), "c")
    store.append(rows("2024-01-15", 9.0).where("model_id = 'm2'"), "d")
    store.append(rows("2024-02-01", 2.5), "b")  # again: replaced
    assert store.read().count() == 7
    assert {(r.model_id, r.run, r.mae) for r in store.latest().collect()} == {("m1", "c", 3.0), ("m2", "c", 4.0)}
    scan = [x for x in store.latest()._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x and "mae" in x]
    assert scan and all("PartitionFilters: [report_date" in x or "isnotnull(report_date" in x for x in scan)


def landed(spark, tmp_path, part):
    rows = Q.requests(spark, SF_SMALL).where(F.pmod(F.xxhash64("part_key"), F.lit(2)) == part)
    rows.repartition(4).write.mode("append").parquet(f"file://{tmp_path}/in")
    return f"file://{tmp_path}/in"


def test_scoring_goes_on_after_a_stop(spark, tmp_path):
    """Stopped after its first batch, with files added meanwhile: every request is scored once."""
    model = fitted(spark, SF_SMALL)
    src = landed(spark, tmp_path, 0)
    schema = spark.read.parquet(src).schema
    sink, ckpt = f"file://{tmp_path}/out", f"file://{tmp_path}/ckpt"
    q = jobs.start_scoring(spark, src, schema, model, sink, ckpt, "1")  # one file a batch
    while q.isActive and not q.recentProgress:
        pass
    q.stop()
    first = spark.read.parquet(sink).count()
    landed(spark, tmp_path, 1)
    jobs.streaming_scoring(spark, src, schema, model, sink, ckpt, "1")
    jobs.streaming_scoring(spark, src, schema, model, sink, ckpt)  # nothing left
    got, want = spark.read.parquet(sink), score(Q.requests(spark, SF_SMALL), model)
    assert 0 < first < got.count() == want.count()
    cols = [*Q.KEYS, "accepted", "failed_rules", "predicted_euro"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0


def test_metrics_go_on_after_a_failure_inside_a_batch(spark, tmp_path, monkeypatch):
    """A batch that fails after it has written its sums is run again; the report equals that of one run."""
    model = fitted(spark, SF_SMALL)
    src = landed(spark, tmp_path, 0)
    schema = spark.read.parquet(src).schema
    sink, ckpt = f"file://{tmp_path}/sums", f"file://{tmp_path}/ckpt"
    plain, calls = M.metric_sums, []

    class Failing:
        def __init__(self, df):
            self.df = df

        @property
        def write(self):
            return self

        def mode(self, m):
            return self

        def parquet(self, path):
            self.df.write.mode("overwrite").parquet(path)
            raise RuntimeError("lost after the write")

    def sums(df, group):
        calls.append(1)
        return Failing(plain(df, group)) if len(calls) == 2 else plain(df, group)

    monkeypatch.setattr(M, "metric_sums", sums)
    with pytest.raises(Exception):
        jobs.streaming_labelled_metrics(spark, src, schema, model, sink, ckpt, "1")
    landed(spark, tmp_path, 1)
    jobs.streaming_labelled_metrics(spark, src, schema, model, sink, ckpt, "1")
    got = {r.sale_month: r for r in jobs.monthly_report(spark, sink).collect()}
    monkeypatch.undo()
    jobs.streaming_labelled_metrics(spark, src, schema, model, f"file://{tmp_path}/sums2", f"file://{tmp_path}/ckpt2")
    want = {r.sale_month: r for r in jobs.monthly_report(spark, f"file://{tmp_path}/sums2").collect()}
    assert set(got) == set(want) and len(calls) > 3
    for k, r in got.items():
        assert r.total_samples == want[k].total_samples and abs(r.mae - want[k].mae) < 1e-6 and abs(r.rmse - want[k].rmse) < 1e-6
