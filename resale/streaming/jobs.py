"""Structured Streaming jobs (P-02 ... P-04).

All three read a folder of parquet files with an explicit schema (the shape
a landing zone or a Kafka-to-files connector produces), run with
``trigger(availableNow=True)`` so a run processes what has arrived and
stops, and keep their checkpoints in the shared work folder so a restarted
or failed run resumes exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from resale.operators import metrics as M
from resale.operators.scoring import FittedModel, score


def _stream(spark: SparkSession, path: str, schema, bytes_per_trigger: str | None = None) -> DataFrame:
    """File stream over all that has landed; ``bytes_per_trigger`` bounds a micro-batch where memory asks for it."""
    r = spark.readStream.schema(schema).format("parquet")
    if bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", bytes_per_trigger)
    return r.load(path)


def start_scoring(spark: SparkSession, source: str, schema, model: FittedModel, sink: str, checkpoint: str, bytes_per_trigger: str | None = None) -> StreamingQuery:
    """P-02: the batch scoring plan on an unbounded input; stateless, append to a parquet sink.

    The fitted tables are static sides of stream-static joins.  The sink's log and
    the checkpoint name the batches that are done: a query that is stopped, or
    fails, between or inside batches goes on without losing or doubling rows.
    """
    return (
        score(_stream(spark, source, schema, bytes_per_trigger), model)
        .select("*", F.col("price_interval.lower").alias("lower"), F.col("price_interval.upper").alias("upper"))
        .drop("price_interval")
        .writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def streaming_scoring(spark: SparkSession, source: str, schema, model: FittedModel, sink: str, checkpoint: str, bytes_per_trigger: str | None = None) -> None:
    """P-02 over all that has landed."""
    start_scoring(spark, source, schema, model, sink, checkpoint, bytes_per_trigger).awaitTermination()


def streaming_weekly_drift(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, watermark: str = "1 day") -> list[dict]:
    """P-03: 7-day tumbling windows per event type with a watermark.

    Append mode emits a window once the watermark passes its end, so windows
    still open when the input ends are not written.  The watermark moves
    between micro-batches: files that land together may be in any order, and
    ``watermark`` must cover the disorder between landings.
    """
    ev = _stream(spark, source, schema).withWatermark("ts", watermark)
    agg = ev.groupBy("event_type", F.window("ts", "7 days").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value_sum"))
    out = agg.select("event_type", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "value_sum")
    q = (
        out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return [{"rows": p.numInputRows, "watermark": p.eventTime.get("watermark")} for p in q.recentProgress]


def replay_weekly_drift(spark: SparkSession, landings: Iterable[DataFrame], folder: str, sink: str, late: str, checkpoint: str, watermark: str = "1 day") -> None:
    """P-03 over landings in their order, with a side output of the rows that come too late.

    Each landing is one run of the query over the same checkpoint: the watermark
    that its rows meet is the one the landings before it have set.  A row whose
    window ended at or before it is dropped by the aggregation; the same rows,
    with the landing's number and the engine's own watermark, are written to
    ``late`` (a folder per landing, overwritten when a landing is repeated).
    """
    for k, rows in enumerate(landings):
        rows.write.mode("append").parquet(folder)
        runs = streaming_weekly_drift(spark, folder, rows.schema, sink, checkpoint, watermark)
        met = next((r["watermark"] for r in runs if r["rows"]), None)
        if met is None:
            continue
        mark = F.to_timestamp(F.lit(met))
        dropped = rows.where(F.window("ts", "7 days").getField("end") <= mark).withColumn("watermark", mark)
        dropped.write.mode("overwrite").parquet(f"{late}/landing={k}")


def streaming_labelled_metrics(spark: SparkSession, source: str, schema, model: FittedModel, sink: str, checkpoint: str, bytes_per_trigger: str | None = None) -> None:
    """P-04: as labelled sales arrive, each micro-batch writes its sums per sale month (``foreachBatch``;
    the batch id names the folder, so a retried batch overwrites its own output); :func:`monthly_report`
    adds them up."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        s = score(batch, model).where(F.col("accepted"))
        s = s.withColumn("actual_euro", F.col("price")).withColumn("predicted_log", F.col(f"pred_{model.model_id}"))
        s = s.withColumn("sale_month", F.date_format(F.to_date("sold_at"), "yyyy-MM"))
        M.metric_sums(s, ["sale_month"]).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    q = (
        _stream(spark, source, schema, bytes_per_trigger).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()


def monthly_report(spark: SparkSession, sink: str) -> DataFrame:
    """One row of metrics and mispricing cost per sale month, from the sums of all batches."""
    return M.from_sums(spark.read.parquet(sink), ["sale_month"])
