"""Leak-free split operators (L-01 ... L-07).

Splits are deterministic hash buckets of the order key, so every line of an
order lands in the same split (no group leaks across), results do not depend
on partitioning, and no shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.functions.exprs import hash_bucket


def split_label(bucket: str | Column = "bucket", train: int = K.TRAIN_SHARE, val: int = K.VAL_SHARE) -> Column:
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    return F.when(b < train, "train").when(b < train + val, "val").otherwise("test")


def assign_split(df: DataFrame, key: str = "order_key", train: float = 0.6, val: float = 0.2, test: float = 0.2) -> DataFrame:
    """L-01: 60/20/20 split by hash bucket; shares must sum to 1 ± 0.001."""
    if abs(train + val + test - 1.0) >= 0.001:
        raise ValueError("split shares must sum to 1.0")
    if "bucket" not in df.columns:
        df = df.withColumn("bucket", hash_bucket(key))
    return df.withColumn("data_split", split_label("bucket", round(train * 100), round(val * 100)))


def with_split(df: DataFrame, split_col: str = "data_split") -> DataFrame:
    """L-04: the table's own split marker, or the seeded 60/20/20 split when the marker is absent."""
    return df if split_col in df.columns else assign_split(df)


def eda_split(df: DataFrame, key: str = "order_key") -> DataFrame:
    """L-02: 80/20 split for exploratory analysis; the train part is analysed."""
    b = F.col("bucket") if "bucket" in df.columns else hash_bucket(key)
    return df.withColumn("eda_part", F.when(b < K.EDA_TRAIN_SHARE, "train").otherwise("holdout"))


def inner_validation(df: DataFrame, key: str = "order_key") -> DataFrame:
    """L-03: validation = a fixed 20 % of the train rows (second-level bucket, salt 'val')."""
    inner = hash_bucket(key, salt="val")
    return df.withColumn(
        "fit_role",
        F.when(F.col("data_split") != "train", F.lit(None)).when(inner < K.INNER_VAL_SHARE, "val").otherwise("fit"),
    )


def fold_of(key: str = "order_key", k: int = K.CV_FOLDS) -> Column:
    """L-05: fold number for k-fold cross-validation (salted bucket)."""
    return hash_bucket(key, salt="fold", modulus=k).cast("int")


def time_split(df: DataFrame, date_col: str = "sold_at") -> DataFrame:
    """L-06: time-ordered split: cut-offs at the 60th and 80th percentile of the sale day.

    The cut-offs are one global aggregate (a 1-row frame, broadcast).
    """
    day = F.datediff(F.to_date(F.col(date_col)), F.lit("1970-01-01").cast("date"))
    d = df.withColumn("_day", day)
    cuts = d.agg(F.percentile("_day", F.array(F.lit(0.6), F.lit(0.8))).alias("_c")).select(
        F.col("_c")[0].alias("_cut_train"), F.col("_c")[1].alias("_cut_val"))
    return (
        d.crossJoin(F.broadcast(cuts))
        .withColumn(
            "time_split",
            F.when(F.col("_day") <= F.col("_cut_train"), "train").when(F.col("_day") <= F.col("_cut_val"), "val").otherwise("test"),
        )
        .drop("_day", "_cut_train", "_cut_val")
    )
