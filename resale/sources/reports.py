"""Append-only store of metric reports, partitioned by model, date and run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["model_id", "report_date", "run"]


class ReportStore:
    """Reports of any runs in one folder; a run that is appended again replaces its own rows and no others."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, rows: DataFrame, run: str) -> None:
        """Write a run's reports (one per model, with ``model_id`` and ``report_date``)."""
        out = rows.withColumn("run", F.lit(run)).withColumn("report_date", F.col("report_date").cast("date"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).withColumn("run", F.col("run").cast("string")).withColumn("report_date", F.col("report_date").cast("date"))

    def latest(self) -> DataFrame:
        """The newest report of every model (of one date, the run that sorts last).

        The newest keys come from the partitions' names alone; their dates (one per model at most) prune the
        partitions that are read, and a broadcast join of one row per model picks the reports.
        """
        table = self.spark.read.parquet(self.path)
        newest = table.select(*KEYS).distinct().groupBy("model_id").agg(F.max(F.struct("report_date", "run")).alias("k")).select("model_id", "k.report_date", "k.run")
        dates = [r.report_date for r in newest.select("report_date").distinct().collect()]
        return table.where(F.col("report_date").isin(dates)).join(F.broadcast(newest), KEYS)
