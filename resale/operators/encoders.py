"""Encoders (E-01 ... E-07).

Target-mean encodings are fitted in one pass over all rows (``unpivot`` of
the three categorical columns, then one grouped aggregate with map-side
partial aggregation, so a category holding a third of all rows costs one
partial row per task).  The same pass counts each category per split, which
gives the per-split fill value for unseen categories without a second pass
or a window over the split column.

Lookups join the fitted table back without a hint: Catalyst and AQE broadcast
it when its bytes allow that, and use a shuffle join with skew splitting
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resale.functions import constants as K


def long_categories(df: DataFrame, pairs=K.TARGET_ENCODED, extra: list[str] | None = None) -> DataFrame:
    """(feature, category, *extra) rows for the encoded columns: one Generate, no shuffle."""
    ids = extra or []
    stacked = df.select(
        *ids,
        F.inline(F.array(*[F.struct(F.lit(name).alias("feature"), F.col(col).cast("string").alias("category")) for name, col in pairs])),
    )
    return stacked


def fit_target_encoding(df: DataFrame, target: str = "price", split_col: str = "data_split") -> DataFrame:
    """E-01: mean train target per (feature, category); null keys dropped.

    Also returns the count of rows of each split per category (``n_train``,
    ``n_val``, ``n_test``), used by :func:`split_fill`.
    """
    long = long_categories(df, extra=[target, split_col]).where(F.col("category").isNotNull())
    is_train = F.col(split_col) == "train"
    return (
        long.groupBy("feature", "category")
        .agg(
            F.avg(F.when(is_train, F.col(target))).alias("encoded"),
            F.count(F.when(is_train, 1)).alias("n_train"),
            F.count(F.when(F.col(split_col) == "val", 1)).alias("n_val"),
            F.count(F.when(F.col(split_col) == "test", 1)).alias("n_test"),
        )
    )


def split_fill(fit: DataFrame) -> DataFrame:
    """E-02 default: per split, the row-weighted mean of the encoded values that matched.

    Equals the mean of the encoded column over that split's rows with a
    known category.  Result: one row per (feature, data_split).
    """
    known = fit.where(F.col("encoded").isNotNull())
    long = known.select(
        "feature", "encoded",
        F.inline(F.array(
            F.struct(F.lit("train").alias("data_split"), F.col("n_train").alias("n")),
            F.struct(F.lit("val").alias("data_split"), F.col("n_val").alias("n")),
            F.struct(F.lit("test").alias("data_split"), F.col("n_test").alias("n")),
        )),
    )
    return long.groupBy("feature", "data_split").agg(
        F.try_divide(F.sum(F.col("encoded") * F.col("n")), F.sum("n")).alias("fill")
    )


def serving_fill(fit: DataFrame) -> DataFrame:
    """E-03: unseen category at serving time -> unweighted mean of the category means."""
    return fit.where(F.col("encoded").isNotNull()).groupBy("feature").agg(F.avg("encoded").alias("fill"))


def apply_target_encoding(df: DataFrame, fit: DataFrame, fill: DataFrame, by_split: bool = True) -> DataFrame:
    """E-02 / E-03: look the three encodings up; unseen or null categories take the fill value.

    ``fit`` and ``fill`` are small fitted tables (categories x 3, splits x 3).
    """
    enc = fit.where(F.col("encoded").isNotNull()).select("feature", "category", "encoded")
    out = df
    for name, col in K.TARGET_ENCODED:
        e = enc.where(F.col("feature") == name).select(F.col("category").alias(f"_{name}_cat"), F.col("encoded").alias(f"_{name}_enc"))
        out = out.join(e, out[col].cast("string") == e[f"_{name}_cat"], "left").drop(f"_{name}_cat")
        if by_split:
            f = fill.where(F.col("feature") == name).select(F.col("data_split").alias(f"_{name}_split"), F.col("fill").alias(f"_{name}_fill"))
            out = out.join(F.broadcast(f), out["data_split"] == f[f"_{name}_split"], "left").drop(f"_{name}_split")
        else:
            f = fill.where(F.col("feature") == name).select(F.col("fill").alias(f"_{name}_fill"))
            out = out.crossJoin(F.broadcast(f))
        out = out.withColumn(f"{name}_encoded", F.coalesce(F.col(f"_{name}_enc"), F.col(f"_{name}_fill"))).drop(f"_{name}_enc", f"_{name}_fill")
    return out


def fit_label_encoder(train: DataFrame, columns: list[str]) -> DataFrame:
    """E-05: per string column, sorted distinct text (null reads 'nan') -> 0..n-1.

    The ranking window is partitioned by column name over the *distinct*
    values only (a small dimension), never over row data.
    """
    long = train.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("category")) for c in columns
    ]))).distinct()
    w = Window.partitionBy("feature").orderBy("category")
    return long.withColumn("code", (F.dense_rank().over(w) - 1).cast("long"))


#: Bytes of one column's codes that every executor may hold.
MAX_LOOKUP = 32_000_000


def bounded(codes: DataFrame) -> set[str]:
    """The features whose codes are small enough for a broadcast (one row per feature is looked at)."""
    size = codes.groupBy("feature").agg(F.sum(F.octet_length("category") + 64).alias("size"))
    return {r.feature for r in size.where(F.col("size") <= MAX_LOOKUP).collect()}


def apply_label_encoder(df: DataFrame, codes: DataFrame, columns: list[str]) -> DataFrame:
    """E-06: lookup; unseen text -> -1.  ``codes`` is read once per column: a written table.

    Codes whose size is known to be small are broadcast.  A join by shuffle would send all rows
    of a frequent category to one task, and the rows through one shuffle per column.
    """
    out, small = df, bounded(codes)
    for c in columns:
        e = codes.where(F.col("feature") == c).select(F.col("category").alias(f"_{c}_cat"), F.col("code").alias(f"_{c}_code"))
        e = F.broadcast(e) if c in small else e
        key = F.coalesce(out[c].cast("string"), F.lit("nan"))
        out = out.join(e, key == e[f"_{c}_cat"], "left").withColumn(f"{c}_code", F.coalesce(F.col(f"_{c}_code"), F.lit(-1).cast("long"))).drop(f"_{c}_cat", f"_{c}_code")
    return out


def unknown_key_share(current: DataFrame, reference: DataFrame, key: str = "model_key") -> DataFrame:
    """E-07 / J-06: share (%) of rows whose key never occurs in the reference rows (left anti join)."""
    seen = reference.select(key).where(F.col(key).isNotNull()).distinct()
    unseen = current.join(seen, key, "left_anti")
    total = current.agg(F.count(F.lit(1)).alias("n_rows"))
    miss = unseen.agg(F.count(F.lit(1)).alias("n_unknown"))
    return total.crossJoin(miss).select(
        "n_rows", "n_unknown",
        F.try_divide(F.col("n_unknown") * 100.0, "n_rows").alias("unknown_pct"),
    )
