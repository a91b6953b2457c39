"""What keeps the prepared tables and their readers in proportion to the rows: plans, settings and equal results."""

import contextlib
import io
import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import DataFrameWriter, Window
from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.functions.exprs import first_match
from resale.operators import encoders, features, models, quantiles
from resale.operators.splits import assign_split
from resale.plans import prepared as P
from resale.plans import q_sources
from resale.session import setting
from resale.sources import tables
from resale.sources.tables import listings


def text_of(df, mode):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_generated_methods_of_base_are_compiled(spark):
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text_of(features.base_features(assign_split(listings(spark, SF_SMALL))), "codegen"))]
    assert sizes and max(sizes) < 8000  # HotSpot interprets longer methods


def test_rules_match_any_needle_in_order(spark):
    rules = [("a", ["1.0"]), ("b", ["x+", "10", "("]), ("c", ["1"])]
    df = spark.createDataFrame([("1.0",), ("110",), ("x+",), ("xx",), ("(",), ("1x0",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(first_match(F.col("t"), rules, "none")).collect()] == ["a", "b", "b", "none", "b", "c", "none", "none"]


def test_split_tables_are_written_without_a_sort(spark, monkeypatch):
    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(key, None)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: seen.append(w._spark.conf.get(key, None)) or write(w, *a, **k))
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("part"))
    out = P.materialize(spark, "unsorted-test", "none", lambda: df, "part")
    assert seen == [P.OPEN_FILES] and spark.conf.get(key, None) == before
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


def test_rows_on_read_equal_the_written_table(spark):
    rows, table = P.processed_rows(spark, SF_SMALL), P.processed(spark, SF_SMALL)
    assert rows.columns == table.columns and rows.dtypes == table.dtypes
    assert rows.exceptAll(table).isEmpty() and table.exceptAll(rows).isEmpty()
    assert "Exchange hash" not in text_of(rows, "simple")


@pytest.mark.parametrize("limit", [32_000_000, 0])
def test_label_lookup_sends_no_rows_around(spark, monkeypatch, limit):
    monkeypatch.setattr(encoders, "MAX_LOOKUP", limit)
    rows = spark.createDataFrame([("a", None), ("b", "x"), ("c", "x")], "u string, v string")
    codes = encoders.fit_label_encoder(rows.where("u <> 'c'"), ["u", "v"])
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        out = encoders.apply_label_encoder(rows, codes, ["u", "v"])
        assert text_of(out, "simple").count("BroadcastHashJoin") == (2 if limit else 0)
        assert sorted(map(tuple, out.collect())) == [("a", None, 0, 0), ("b", "x", 1, 1), ("c", "x", -1, 1)]


def test_quantiles_read_the_rows_no_third_time(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    got = quantiles.wide(df, {"m": ("x", 0.5)})
    assert "LogicalRDD" not in got._jdf.queryExecution().optimizedPlan().toString() and got.first().m == 49.5


def test_golden_rows_are_a_bounded_top(spark):
    got = q_sources._golden(spark, SF_SMALL)
    assert "Window" not in text_of(got, "simple") and text_of(got, "simple").count("TakeOrderedAndProject") == 4
    t = P.processed(spark, SF_SMALL).where("data_split = 'test'")
    q = t.selectExpr("percentile(price, array(0.25, 0.5, 0.75)) q").first().q
    quart = F.when(F.col("price") <= q[0], 1).when(F.col("price") <= q[1], 2).when(F.col("price") <= q[2], 3).otherwise(4)
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in q_sources.KEYS]))
    rank = F.row_number().over(Window.partitionBy("quartile").orderBy(h, *q_sources.KEYS))
    want = t.withColumn("quartile", quart).withColumn("r", rank).where(F.col("r") <= K.GOLDEN_ROWS_PER_QUARTILE).select(*q_sources.GOLDEN_COLUMNS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_tree_fits_use_the_cores(spark, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    cores = min(spark.sparkContext.defaultParallelism, 10)

    def largest(df):
        return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    few = models.narrow(spark.range(1000).coalesce(1))  # one file, one row group
    assert largest(few) <= 2 * -(-1000 // cores) and few.count() == 1000 and few.rdd.getNumPartitions() == cores
    many = models.narrow(spark.range(0, 1000, 1, 4 * cores))
    assert many.rdd.getNumPartitions() == cores and "Exchange" not in text_of(many, "simple")
    assert models.narrow(spark.range(0)).count() == 0


def test_listings_of_one_row_group_use_the_cores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "parts_for", lambda df, cores, parts_for=tables.parts_for: parts_for(df, cores, 100))
    day = F.lit("2024-01-05 00:00:00").cast("timestamp")
    made = {
        "lineitem": spark.range(1000).selectExpr(
            "id l_orderkey", "id % 7 l_partkey", "id % 50 l_suppkey", "1 l_linenumber", "2D l_quantity", "1000D + id l_extendedprice",
            "'A' l_returnflag", "'F' l_linestatus").withColumn("l_shipdate", day),
        "orders": spark.range(1000).selectExpr("id o_orderkey", "'1-URGENT' o_orderpriority").withColumn("o_orderdate", day),
        "part": spark.range(7).selectExpr("id p_partkey", "'STEEL' p_type", "cast(id as int) p_size"),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")  # one file, one row group
    got, cores = listings(spark, str(tmp_path)), min(spark.sparkContext.defaultParallelism, 10)
    held = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 1000 and max(held) <= 2 * -(-1000 // cores)
    assert got.select("order_key").distinct().count() == 1000
    even = spark.range(0, 1000, 1, 4 * cores)
    assert "Exchange" not in text_of(tables.dealt(even), "simple") and tables.dealt(spark.range(0)).count() == 0
    long = spark.range(0, 100 * 50 * 4 * cores, 1, spark.sparkContext.defaultParallelism)  # many rows on all cores: no shuffle either
    assert "Exchange" not in text_of(tables.dealt(long), "simple")
