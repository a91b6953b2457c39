"""The prepared tables every analysis starts from.

Stage 1 ``base``: listings + split + row-local features.  It is the output
of the two big joins, so it is written once (parquet, partitioned by
``data_split``) and read back: the parameter and encoding fits then scan only
the columns and the split they need, and the lineage is cut, so a lost
executor re-reads parquet instead of re-running the joins.

Stage 2 ``params`` / ``encodings``: small fitted tables (1 row; categories).

Stage 3 ``processed``: base + parameters + encodings, computed on read (no
shuffle; a query computes the columns it reads).  The sink (S-04) writes it
the same way as base.

Stage 4 ``scored``: processed rows with the predictions of the baseline
models (T1-15), in long form ``(model_id, ...)``; computed on read, no write.

Tables live in the shared folder of :func:`resale.session.work_dir` and are
memoised per application and input folder.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.functions.exprs import back_transform
from resale.operators import encoders, features, params
from resale.operators.splits import assign_split
from resale.session import setting, work_dir
from resale.sources.tables import listings

_LOCK = threading.RLock()
_MEMO: dict[tuple, tuple] = {}
VERSION = "v1"
#: Files that a task may keep open (a split has one); with more partition values rows are sorted.
OPEN_FILES = "8"


def location(spark: SparkSession, name: str, sf_dir: str) -> str:
    """Folder of a table made from one input; the same in every session with the same shared folder."""
    digest = hashlib.sha1(f"{VERSION}|{sf_dir}".encode()).hexdigest()[:12]
    return f"{work_dir(spark)}/resale/{name}-{digest}"


def materialize(spark: SparkSession, name: str, sf_dir: str, build, partition_by: str | None = None) -> DataFrame:
    key = (spark.sparkContext.applicationId, name, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _MEMO:
            path = location(spark, name, sf_dir)
            df = build()
            writer = df.write.mode("overwrite")
            if partition_by:
                # a file per split is open in each task, so that wide rows are not sorted (and spilled) by split first
                with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES):
                    writer.partitionBy(partition_by).parquet(path)
            else:
                writer.parquet(path)
            _MEMO[key] = path, df.schema
        path, schema = _MEMO[key]
    return spark.read.schema(schema).parquet(path)  # a partitioned table without rows has no file to tell its schema


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(
        spark, "base", sf_dir, lambda: features.base_features(assign_split(listings(spark, sf_dir))), "data_split"
    )


def learned_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(
        spark, "params", sf_dir,
        lambda: params.learn(base(spark, sf_dir).where(F.col("data_split") == "train")).coalesce(1),
    )


def encoding_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(
        spark, "encodings", sf_dir, lambda: encoders.fit_target_encoding(base(spark, sf_dir)).coalesce(1)
    )


def label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-05: label codes of the text columns, from the train rows of the processed table."""
    return materialize(
        spark, "label-codes", sf_dir,
        lambda: encoders.fit_label_encoder(processed_rows(spark, sf_dir).where(F.col("data_split") == "train"), features.STRING_FEATURES),
    )


PROCESSED_COLUMNS = [
    "order_key", "line_number", "part_key", "supp_key", "maker_key", "model_key", "mileage", "engine_power",
    "registration_date", "fuel", "paint_color", "car_type", *[f"feature_{k}" for k in range(1, 9)], "price", "sold_at",
    "series", "luxury_tier", "is_luxury", "is_performance", "registration_year", "registration_month",
    "registration_quarter", "is_summer_registration", "is_year_end_registration", "car_age_years",
    "age_mileage_interaction", "mileage_per_power", "annual_mileage", "power_age_ratio",
    "luxury_mileage_interaction", "luxury_age_interaction", "is_high_mileage", "is_old_car",
    "fuel_encoded", "color_encoded", "car_type_encoded", "price_log", "bucket", "data_split",
]


def transform(df: DataFrame, p: DataFrame, fit: DataFrame, fill: DataFrame) -> DataFrame:
    """Stage 3 as a plain function of the fitted tables (also used for scoring)."""
    d = params.attach(df, p)
    d = features.fill_age(d, F.col("median_age"))
    d = features.interaction_features(d)
    d = features.repair(d, params.columns())
    d = encoders.apply_target_encoding(d, fit, fill, by_split="data_split" in d.columns)
    return d


def processed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed rows: row-local over ``base`` and small fitted tables, so they are computed on read."""
    fit = encoding_fit(spark, sf_dir)
    fill = materialize(spark, "encoding-fill", sf_dir, lambda: encoders.split_fill(fit).coalesce(1))
    return transform(base(spark, sf_dir), learned_params(spark, sf_dir), fit, fill).select(*PROCESSED_COLUMNS)


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-04: the processed rows written partitioned by split, read back."""
    return materialize(spark, "processed", sf_dir, lambda: processed_rows(spark, sf_dir), "data_split")


def baseline_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1-15: train mean of log price per (series, fuel), with the row counts.

    Coarser grains (series, global) are re-aggregated from this small table.
    """
    return materialize(
        spark, "baseline", sf_dir,
        lambda: processed_rows(spark, sf_dir)
        .where(F.col("data_split") == "train")
        .groupBy("series", "fuel")
        .agg(F.sum("price_log").alias("sum_log"), F.count(F.lit(1)).alias("n"))
        .coalesce(1),
    )


def model_rmse(spark: SparkSession, sf_dir: str, model_id: str = K.DEFAULT_MODEL) -> DataFrame:
    """Train RMSE (euro) of a baseline model: 1-row fitted table used by the prediction interval."""
    return materialize(
        spark, f"rmse-{model_id}", sf_dir,
        lambda: scored(spark, sf_dir, models=[model_id]).where(F.col("data_split") == "train")
        .agg(F.sqrt(F.avg(F.pow("residual_euro", 2))).alias("rmse")).coalesce(1),
    )


SCORED_COLUMNS = [
    "order_key", "line_number", "part_key", "supp_key", "data_split", "model_key", "series", "fuel", "car_type",
    "paint_color", "mileage", "car_age_years", "engine_power", "annual_mileage", "sold_at", "price", "price_log",
]


def predictions(df: DataFrame, fit: DataFrame) -> DataFrame:
    """Add the three baseline predictions (log scale) as columns."""
    sf = fit.select("series", "fuel", (F.col("sum_log") / F.col("n")).alias("_p_sf"))
    s = fit.groupBy("series").agg((F.sum("sum_log") / F.sum("n")).alias("_p_s"))
    g = fit.agg((F.sum("sum_log") / F.sum("n")).alias("_p_g"))
    out = (
        df.join(sf, ["series", "fuel"], "left")
        .join(F.broadcast(s), ["series"], "left")  # at most one row per series label (19)
        .crossJoin(F.broadcast(g))  # one row
    )
    return out.withColumns({
        "pred_baseline_global": F.col("_p_g"),
        "pred_baseline_series": F.coalesce("_p_s", "_p_g"),
        "pred_baseline_series_fuel": F.coalesce("_p_sf", "_p_s", "_p_g"),
    }).drop("_p_sf", "_p_s", "_p_g")


def scored(spark: SparkSession, sf_dir: str, inverse: str = "expm1", columns: list[str] | None = None,
           models: list[str] | None = None, only: DataFrame | None = None) -> DataFrame:
    """Long scored table: one row per (model_id, listing) with euro values and residual columns (R-01).

    ``only`` (row keys, few) limits the listings before anything is predicted.

    ``models`` limits the generated rows to the models a query reads (the
    model id is a generated column, so a later filter could not be pushed
    below the generator).
    """
    cols = columns or SCORED_COLUMNS
    rows = processed_rows(spark, sf_dir).select(*cols)
    if only is not None:
        rows = rows.join(F.broadcast(only), only.columns, "left_semi")
    df = predictions(rows, baseline_fit(spark, sf_dir))
    long = df.select(
        *cols,
        F.inline(F.array(*[
            F.struct(F.lit(m).alias("model_id"), F.col(f"pred_{m}").alias("predicted_log")) for m in (models or K.BASELINE_MODELS)
        ])),
    )
    return residual_columns(long, inverse)


def residual_columns(df: DataFrame, inverse: str = "expm1", actual_log: str = "price_log", predicted_log: str = "predicted_log") -> DataFrame:
    """R-01: actual and predicted euro, residual, absolute residual, APE, tail flag."""
    actual = back_transform(F.col(actual_log), inverse)
    if inverse == "expm1" and "price" in df.columns and actual_log == "price_log":
        actual = F.col("price")  # expm1(log1p(price)) is price; skip the round trip
    d = df.withColumn("actual_euro", actual).withColumn("predicted_euro", back_transform(F.col(predicted_log), inverse))
    d = d.withColumn("residual_euro", F.col("actual_euro") - F.col("predicted_euro"))
    d = d.withColumn("abs_residual_euro", F.abs("residual_euro"))
    d = d.withColumn("ape", F.abs(F.try_divide(F.col("residual_euro"), F.col("actual_euro"))) * 100)
    return d.withColumn("in_tail", F.coalesce(F.col("ape") > K.TAIL_APE, F.lit(False)))
