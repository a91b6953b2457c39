"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resale.functions import constants as K


def hash_bucket(col: str | Column, salt: str | None = None, modulus: int = 100) -> Column:
    """Deterministic bucket in [0, modulus): first 8 hex digits of md5 as an integer.

    md5 is used (not an engine hash) so the same number comes out of any SQL
    engine, and the bucket does not depend on partitioning like randomSplit.
    """
    c = F.col(col) if isinstance(col, str) else col
    text = c.cast("string") if salt is None else F.concat(c.cast("string"), F.lit(salt))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(modulus)).cast("long")


def first_match(text: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """Ordered substring classifier: the label of the first rule whose needle occurs in ``text``.

    A rule is one comparison: a chain of them per needle makes the generated
    method so long that the JVM (8,000 bytes) no longer compiles it.
    """
    expr = None
    for label, needles in rules:
        cond = text.contains(needles[0]) if len(needles) == 1 else text.rlike("|".join(f"\\Q{n}\\E" for n in needles))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def series_of(model_key: str | Column) -> Column:
    """Series label of a model key (upper-cased text; missing key reads as 'NAN')."""
    c = F.col(model_key) if isinstance(model_key, str) else model_key
    return first_match(F.upper(F.coalesce(c.cast("string"), F.lit("nan"))), K.SERIES_RULES, K.SERIES_DEFAULT)


def luxury_tier_of(series: str | Column) -> Column:
    c = F.col(series) if isinstance(series, str) else series
    expr = None
    for tier, labels in K.LUXURY_TIERS.items():
        cond = c.isin(labels)
        expr = F.when(cond, F.lit(tier)) if expr is None else expr.when(cond, F.lit(tier))
    return expr.otherwise(F.lit(K.LUXURY_DEFAULT)).cast("int")


def flag(cond: Column) -> Column:
    """0/1 integer flag; a null comparison counts as false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields null on a zero denominator (ANSI mode would raise)."""
    return F.try_divide(num, den)


def parse_date(col: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date; unparsable text gives null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(F.try_to_timestamp(c.cast("string"), F.lit(fmt)))


def clip_low(c: Column, low: float) -> Column:
    """Lower clip that keeps nulls null (``greatest`` alone would skip them)."""
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(low)))


def back_transform(c: Column, inverse: str = "expm1") -> Column:
    """Log price back to euro: expm1 inverts log1p; 'exp' keeps the +1 offset."""
    return F.expm1(c) if inverse == "expm1" else F.exp(c)


def adjusted_skewness(c: Column) -> Column:
    """Bias-adjusted sample skewness, from Spark's population skewness."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def round_half_away(c: Column, decimals: int = 4) -> Column:
    """Round a double to ``decimals`` as round(x * 10^d) / 10^d, half away from zero, no -0.0.

    Scaling first and rounding the scaled double makes the result depend
    only on IEEE arithmetic, so every engine produces the same bits.
    """
    scale = float(10**decimals)
    return F.round(c.cast("double") * scale) / scale + F.lit(0.0)


def r4(c: Column) -> Column:
    """Round a double for presentation (4 decimals)."""
    return round_half_away(c, 4)


def finalize(df: DataFrame, decimals: int = 4) -> DataFrame:
    """Normalise the output schema: integers as long, doubles rounded."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            cols.append(F.col(f.name).cast("long").alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(round_half_away(F.col(f.name), decimals).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def unpivot_columns(df: DataFrame, ids: list[str], columns: list[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Long form of ``columns`` (one pass, Generate operator; no shuffle)."""
    return df.unpivot(ids, columns, name, value) if ids else df.unpivot([], columns, name, value)
