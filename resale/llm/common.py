"""Helpers shared by the training-data operators: table scans, written tables, bounded Arrow slices."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resale.session import work_dir

#: Largest text volume one Python step holds at a time (a single longer text is still taken whole).
SLICE_BYTES = 16 << 20

#: Rows of the Arrow batches that go to Python where this package writes a table; a batch of whole texts is held by
#: the JVM and by the Python worker at the same time.
BATCH_ROWS = 1000
_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"

#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder (``spark.checkpoint.dir``)."""
    return f"{work_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, executors may be lost after it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it holds, Arrow batches have at most ``BATCH_ROWS`` rows, unless the session set a number of its own."""
    chosen = spark.conf.get(_BATCH_CONF)
    mine = chosen == _BATCH_DEFAULT
    if mine:
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)
    try:
        yield
    finally:
        if mine:
            spark.conf.set(_BATCH_CONF, _BATCH_DEFAULT)


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under names of our own, so that no other column can clash; null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def bound_batches(spark: SparkSession) -> None:
    """Small Arrow batches for a whole session, unless it set a number of its own (for tables that others write)."""
    if spark.conf.get(_BATCH_CONF) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)


def trimmed(step):
    """A step that gives freed memory back to the system when its task ends: Python workers outlive their stage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim:
                trim(0)

    return run


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not have (names are compared as Spark does, without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def raw_words(text: Column) -> Column:
    """Words ``[^\x20\x09-\x0D]+`` of a text, in order; an empty array if there is none."""
    return F.filter(F.split(text, WORD_SPLIT), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one piece holds at most ``limit`` bytes of ``column``, one row at least."""
    for b in batches:
        if not b.num_rows:
            continue
        arr = b.column(b.schema.get_field_index(column))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(arr), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield b.slice(at, stop - at)
            at = stop


def strings(arr: pa.Array) -> list[str]:
    """Python strings of a string array; null is empty, bytes that are not UTF-8 become U+FFFD."""
    return ["" if v is None else v.decode("utf-8", "replace") for v in arr.cast(pa.binary()).to_pylist()]


def splitmix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Classes whose counts are broadcast when a sample is drawn.
MAX_CLASSES = 100_000


def hashed_sample(keys: DataFrame, cap: dict | int, cls: str | None = None) -> DataFrame:
    """At most ``cap`` distinct rows (per class) of ``keys``: those with the smallest hash of ``doc_id``.

    A count per class gives the hash below which a little more than ``cap`` rows
    are to be expected (ten standard deviations more).  The counts are broadcast
    (their number is checked), so the bound cuts the table before anything is
    dealt by class, and only about ``cap`` rows per class are ranked.
    """
    label, draw, number, most, nth = free_names(keys, "cls", "u", "n", "cap", "r")
    by = F.lit(0) if cls is None else F.col(cls)
    rows = keys.select("*", by.alias(label), (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)).alias(draw))
    limit = F.lit(cap) if isinstance(cap, int) else F.coalesce(*[F.when(F.col(label) == k, F.lit(v)) for k, v in cap.items()], F.lit(0))
    counts = written(rows.groupBy(label).agg(F.count(F.lit(1)).alias(number)).withColumn(most, limit), "class-counts")
    if counts.count() > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    near = rows.join(F.broadcast(counts), label).where(F.col(draw) < (F.col(most) + 10 * F.sqrt(most) + 10) / F.col(number))
    near = near.distinct()  # rows of one id share a hash, however many they are
    rank = F.row_number().over(Window.partitionBy(label).orderBy(draw, "doc_id"))
    return near.withColumn(nth, rank).where(F.col(nth) <= F.col(most)).drop(label, draw, number, most, nth)
