"""Pairwise-complete moments of many column pairs in one scan.

For every pair of columns: the rows where both have a value, their means, sums
of squared deviations and sum of products of deviations.  A task adds up its
rows as products of matrices (values around the first value of each column times
the table of present values), so all pairs together cost one pass.  The tasks'
rows merge pair by pair with the update of Chan, Golub and LeVeque; merged parts
equal the whole, so partial results of any periods can be kept and merged later.

A pair without a common row has n = 0 and no statistics; the correlation is null
where a column does not vary (Spark's own ``corr`` divides by zero there).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ["n", "mean_a", "mean_b", "caa", "cbb", "cab"]
PART_SCHEMA = "a int, b int, n long, mean_a double, mean_b double, caa double, cbb double, cab double"


def safe_corr(a: Column | str, b: Column | str) -> Column:
    """Aggregate: Pearson correlation over the rows that have both values; null where one does not vary."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def partials(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Rows of ``PART_SCHEMA``: a row per task and pair (a and b are positions in the sorted list of columns)."""
    names = sorted({c for p in pairs for c in p})
    left, right = (np.array([names.index(p[k]) for p in pairs], np.int32) for k in (0, 1))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(names)
        shift, count, sums, squares, products = None, np.zeros((k, k)), np.zeros((k, k)), np.zeros((k, k)), np.zeros((k, k))
        for batch in batches:
            if not batch.num_rows:
                continue
            has = np.column_stack([np.asarray(c.is_valid()) for c in batch.columns])
            x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
            if shift is None:
                shift, known = np.zeros(k), np.zeros(k, bool)
            fresh = ~known & has.any(axis=0)
            if fresh.any():
                # a column that had no value yet has added nothing to its own sums
                shift[fresh], known[fresh] = x[has[:, fresh].argmax(axis=0), np.flatnonzero(fresh)], True
            x, m = np.where(has, x - shift, 0.0), has.astype(float)
            count += m.T @ m
            sums += x.T @ m  # [i, j]: of column i where column j has a value
            squares += (x * x).T @ m
            products += x.T @ x
        if shift is None:
            return
        n = count[left, right]
        some = np.maximum(n, 1)
        sa, sb = sums[left, right], sums[right, left]
        cols = [
            n.astype(np.int64), shift[left] + sa / some, shift[right] + sb / some, np.maximum(squares[left, right] - sa * sa / some, 0),
            np.maximum(squares[right, left] - sb * sb / some, 0), products[left, right] - sa * sb / some,
        ]
        yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right), *map(pa.array, cols)], ["a", "b", *FIELDS])

    return df.select(*[F.col(c).cast("double").alias(c) for c in names]).mapInArrow(step, PART_SCHEMA)


def merge(parts: DataFrame) -> DataFrame:
    """One row per pair from any number of partial rows."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(c) for c in FIELDS[1:]])

    def add(x: Column, y: Column) -> Column:
        n = x["n"] + y["n"]
        da, db, share = y["mean_a"] - x["mean_a"], y["mean_b"] - x["mean_b"], F.coalesce(F.try_divide(y["n"].cast("double"), n.cast("double")), F.lit(0.0))
        between = x["n"] * share  # n_x * n_y / n
        return F.struct(
            n.alias("n"), (x["mean_a"] + da * share).alias("mean_a"), (x["mean_b"] + db * share).alias("mean_b"),
            (x["caa"] + y["caa"] + da * da * between).alias("caa"), (x["cbb"] + y["cbb"] + db * db * between).alias("cbb"), (x["cab"] + y["cab"] + da * db * between).alias("cab"),
        )

    # a row per task and pair
    return parts.groupBy("a", "b").agg(F.aggregate(F.collect_list(F.struct(*FIELDS)), zero, add).alias("m")).select("a", "b", "m.*")


def matrix(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(col_a, col_b, n, mean_a, mean_b, caa, cbb, cab, r) of the given pairs."""
    names = sorted({c for p in pairs for c in p})
    label = F.array(*map(F.lit, names))
    spread = F.sqrt(F.col("caa")) * F.sqrt(F.col("cbb"))
    found = merge(partials(df, pairs)).select(F.get(label, F.col("a")).alias("col_a"), F.get(label, F.col("b")).alias("col_b"), *FIELDS, F.try_divide(F.col("cab"), spread).alias("r"))
    asked = df.sparkSession.createDataFrame(pairs, "col_a string, col_b string")
    return asked.join(found, ["col_a", "col_b"], "left").withColumn("n", F.coalesce("n", F.lit(0)))  # a row per pair
