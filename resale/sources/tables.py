"""Scans of the driver tables and the ``listings`` view built from them.

Each reader names the columns it needs, so the parquet scan reads only those
(``ReadSchema`` in the plan) and filters placed after it are pushed down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.functions.exprs import hash_bucket

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


#: Rows that are worth a task of their own.
TASK_ROWS = 20_000


def parts_for(df: DataFrame, cores: int, task_rows: int = TASK_ROWS, most_rows: int | None = None) -> tuple[int, bool]:
    """Partitions that the rows are worth (more than cores only beyond ``most_rows`` a partition), and whether one of
    those they lie in holds more than twice its share."""
    held = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("part")).count().collect()]  # a row per partition
    rows = sum(held)
    least = -(-rows // most_rows) if most_rows else 1
    wanted = max(1, least, min(cores, -(-rows // task_rows)))
    return wanted, max(held, default=0) * wanted > 2 * rows


def dealt(df: DataFrame) -> DataFrame:
    """The rows of a scan on all cores: a file of one row group is read by one task, which would do all the work up to
    the next shuffle (and with broadcast joins there is none).  A scan in enough parts stays as it is."""
    wanted, uneven = parts_for(df, max(1, df.sparkSession.sparkContext.defaultParallelism))
    return df.repartition(wanted) if uneven else df


RAW_COLUMNS = [
    "order_key", "line_number", "part_key", "supp_key", "maker_key", "model_key", "mileage", "engine_power",
    "registration_date", "fuel", "paint_color", "car_type",
    *[f"feature_{k}" for k in range(1, 9)],
    "price", "sold_at", "bucket",
]


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing table: lineitem joined with its order and its part.

    Two equi-joins on the TPC-H keys; Catalyst picks broadcast when a side is
    below ``autoBroadcastJoinThreshold`` by statistics and sort-merge otherwise,
    AQE splits skewed partitions at run time.  The lines are dealt out first where
    their file has too few row groups for the cores.  Every other column is a
    row-local expression of the joined row, so no further shuffle.
    """
    li = dealt(table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ]))
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"])
    part = table(spark, sf_dir, "part", ["p_partkey", "p_type", "p_size"])
    j = li.join(orders, li.l_orderkey == orders.o_orderkey).join(part, li.l_partkey == part.p_partkey)

    supp_mod = F.col("l_suppkey") % 50
    part_mod = F.col("l_partkey") % 97
    model_keys = F.array(*[F.lit(k) for k in K.LISTING_MODEL_KEYS])
    # the price follows power, model, age and mileage; the cents-free extended price, folded, is its noise
    worth = F.lit(8000.0) + F.col("p_size") * 700 + (F.col("l_partkey") % 27) * 900
    kept = (1000 - 45 * (F.col("p_size") % 12)) * (1000 - 8 * F.col("l_quantity")) / 1e6
    price = worth * kept + (F.floor("l_extendedprice").cast("double") % 4001 - 2000)
    reg_date = F.date_sub(F.to_date("o_orderdate"), ((F.col("p_size") % 12) * 365).cast("int"))
    return j.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp_key"),
        F.lit("MAKER").alias("maker_key"),
        F.element_at(model_keys, (F.col("l_partkey") % len(K.LISTING_MODEL_KEYS) + 1).cast("int")).alias("model_key"),
        F.when(supp_mod == 0, F.lit(None).cast("double"))
        .when(supp_mod == 1, -F.col("l_quantity"))
        .otherwise(F.col("l_quantity") * 5000)
        .alias("mileage"),
        F.when(part_mod == 0, F.lit(None).cast("int"))
        .when(part_mod == 1, F.lit(-1))
        .when(part_mod == 2, F.lit(0))
        .otherwise(F.lit(60) + F.col("p_size") * 5)
        .alias("engine_power"),
        reg_date.cast("string").alias("registration_date"),
        F.lower("p_type").alias("fuel"),
        F.concat("l_returnflag", "l_linestatus").alias("paint_color"),
        F.col("o_orderpriority").alias("car_type"),
        *[((F.col("l_suppkey").bitwiseAND(1 << (k - 1))) != 0).alias(f"feature_{k}") for k in range(1, 9)],
        price.alias("price"),
        F.to_date("l_shipdate").cast("string").alias("sold_at"),
        hash_bucket("l_orderkey").alias("bucket"),
    )
