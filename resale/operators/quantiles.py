"""Exact quantiles with bounded memory, global or per group.

A bounded sketch (``percentile_approx``) brackets each wanted rank.  One more
pass counts the rows between brackets and, per distinct value, the rows inside
them; the values on either side of the wanted position are read from running
counts over one bracket at a time and interpolated linearly (the rule of pandas
and DuckDB ``quantile_cont``).  No task holds the distinct values of a column:
a task's state is a sketch per group and column, and a bracket holds about
``10 / ACCURACY`` of a group's rows.  Where that is more than ``MAX_BRACKET``
rows, brackets are narrowed by further passes (each sketches the rows inside and
counts those below) until they hold no more, or a single value.

:func:`sketches` and :func:`estimate` are the approximate way: one mergeable sketch
per column and part (a day, a partition), stored once; quantiles of any union of
parts come from the stored sketches without reading rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resale.session import work_dir

ACCURACY = 5000
#: Rows of a bracket that one task may sort.
MAX_BRACKET = 4_000_000
#: Levels of the sketch inside a bracket that is narrowed, and most passes.
STEPS, MAX_PASSES = 256, 12


def long(df: DataFrame, wanted: dict[str, tuple[str, float]], by: list[str] | None = None) -> DataFrame:
    """(by..., name, value) for every name -> (column, level); no row where the column has no value in the group."""
    by = by or []
    keys = [*(f"_by{i}" for i in range(len(by))), "_col"]
    levels = {c: sorted({q for k, q in wanted.values() if k == c}) for c, _ in wanted.values()}
    pairs = F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_x")) for c in levels])
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.inline(pairs)).where(F.col("_x").isNotNull())

    margin = 5.0 / ACCURACY  # the sketch errs by 1 / ACCURACY
    small = F.col("_n") <= 4 * ACCURACY  # so few rows are one bracket
    grid = sorted({v for qs in levels.values() for q in qs for v in (max(0.0, q - margin), min(1.0, q + margin))})
    at = {g: i + 1 for i, g in enumerate(grid)}
    sketch = rows.groupBy(*keys).agg(F.percentile_approx("_x", F.array(*map(F.lit, grid)), ACCURACY).alias("_s"), F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"))

    sketch = _stored(sketch)

    def ends(qs: list[float], low: bool):
        if low:
            return F.array(*[F.col("_min") if q <= margin else F.when(small, F.col("_min")).otherwise(F.element_at("_s", at[q - margin])) for q in qs])
        return F.array(*[F.col("_max") if q + margin >= 1 else F.when(small, F.col("_max")).otherwise(F.element_at("_s", at[q + margin])) for q in qs])

    def per_column(make):
        return F.coalesce(*[F.when(F.col("_col") == c, make(qs)) for c, qs in levels.items()])

    brackets = sketch.select(*keys, "_n", per_column(lambda qs: ends(qs, True)).alias("_lo"), per_column(lambda qs: ends(qs, False)).alias("_hi"))

    if not sketch.where(F.col("_n") * (2 * margin) > MAX_BRACKET).where(~small).isEmpty():
        brackets = _narrowed(rows, brackets, keys, per_column(lambda qs: F.array(*map(F.lit, qs))))

    def same(a: str, b: str):
        out = F.lit(True)
        for k in keys:
            out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
        return out

    near = rows.alias("r").join(brackets.alias("b"), same("r", "b")).select(*[f"r.{k}" for k in keys], "_x", "_lo", "_hi")
    gap = F.size(F.filter("_hi", lambda h: h < F.col("_x")))  # brackets that end below the row
    inside = F.col("_x") >= F.get("_lo", F.col("_gap"))
    counts = near.withColumn("_gap", gap).groupBy(*keys, "_gap", F.when(inside, F.col("_x")).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    counts = _stored(counts)  # read twice below; the rows are scanned once
    # rows up to a bracket from the few bracket totals, rows up to a value within its bracket
    totals = counts.groupBy(*keys, "_gap").agg(F.sum("_c").alias("_t"))
    before = totals.withColumn("_before", F.coalesce(F.sum("_t").over(Window.partitionBy(*keys).orderBy("_gap").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    run = Window.partitionBy(*keys, "_gap").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("_in", F.sum("_c").over(run)).where(F.col("_v").isNotNull()).alias("c")
    ranked = upto.join(before.alias("t"), same("c", "t") & (F.col("c._gap") == F.col("t._gap"))).select(*[f"c.{k}" for k in keys], "_v", (F.col("_in") + F.col("_before")).alias("_upto"))

    names = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("_for"), F.lit(q).alias("_q")) for n, (c, q) in wanted.items()])
    asked = brackets.select(*keys, "_n", F.inline(names)).where(F.col("_for") == F.col("_col")).withColumn("_place", F.col("_q") * (F.col("_n") - 1))
    ranks = asked.select(*keys, "name", "_place", F.explode(F.array_distinct(F.array(F.floor("_place"), F.ceil("_place")))).alias("_rank"))
    # the first value whose running count passes the rank
    step = ranked.withColumn("_from", F.coalesce(F.lag("_upto").over(Window.partitionBy(*keys).orderBy("_upto")), F.lit(0)))
    hit = ranks.alias("a").join(step.alias("s"), same("a", "s") & (F.col("_upto") > F.col("_rank")) & (F.col("_from") <= F.col("_rank")))
    share = F.col("_place") - F.floor("_place")
    found = hit.select(*[f"a.{k}" for k in keys], "name", "_place", "_rank", "_v").groupBy(*keys, "name", "_place").agg(
        F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    value = F.when(share == 0, F.col("_a")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * share)
    return found.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "name", value.alias("value"))


def _stored(small: DataFrame) -> DataFrame:
    """A small table written to the shared folder: it is used several times."""
    path = f"{work_dir(small.sparkSession)}/resale/quantiles/{uuid.uuid4().hex[:12]}"
    small.write.parquet(path)
    return small.sparkSession.read.schema(small.schema).parquet(path)


def _narrowed(rows: DataFrame, brackets: DataFrame, keys: list[str], levels) -> DataFrame:
    """Brackets (keys, _n, _lo, _hi) that hold at most ``MAX_BRACKET`` rows each, or one value."""
    one = brackets.select(*keys, "_n", F.posexplode(F.arrays_zip(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), levels.alias("q"))).alias("_i", "_z"))
    one = _stored(one.select(*keys, "_n", "_i", F.col("_z.lo").alias("_l"), F.col("_z.hi").alias("_h"), (F.col("_z.q") * (F.col("_n") - 1)).alias("_at")))
    grid = F.array(*[F.lit(k / STEPS) for k in range(STEPS + 1)])
    on = None
    for k in keys:
        c = F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}"))
        on = c if on is None else on & c
    for _ in range(MAX_PASSES):
        inside = F.when(F.col("_x") >= F.col("_l"), F.col("_x"))
        near = rows.alias("r").join(one.alias("b"), on & (F.col("r._x") <= F.col("b._h"))).select(*[f"b.{k}" for k in keys], "_i", "_n", "_l", "_h", "_at", "_x")
        found = near.groupBy(*keys, "_i", "_n", "_l", "_h", "_at").agg(F.count(F.when(inside.isNull(), 1)).alias("_below"), F.count(inside).alias("_in"), F.percentile_approx(inside, grid, ACCURACY).alias("_g"))
        first = F.floor((F.floor("_at") - F.col("_below")) / F.greatest("_in", F.lit(1)) * STEPS).cast("int") - 1
        last = F.ceil((F.ceil("_at") + 1 - F.col("_below")) / F.greatest("_in", F.lit(1)) * STEPS).cast("int") + 1
        low = F.greatest(F.col("_l"), F.when(first >= 0, F.get("_g", first)).otherwise(F.col("_l")))
        high = F.least(F.col("_h"), F.when(last <= STEPS, F.get("_g", last)).otherwise(F.col("_h")))
        large = F.col("_in") > MAX_BRACKET
        nxt = _stored(found.select(
            *keys, "_n", "_i", F.when(large, low).otherwise(F.col("_l")).alias("_l"), F.when(large, high).otherwise(F.col("_h")).alias("_h"), "_at",
            (large & (low < high) & ((low > F.col("_l")) | (high < F.col("_h")))).alias("_more"),
        ))
        one = nxt.drop("_more")
        if nxt.where("_more").isEmpty():
            break
    lists = one.groupBy(*keys, "_n").agg(F.array_sort(F.collect_list(F.struct("_i", "_l", "_h"))).alias("_p"))  # a few per column
    # ends rise with the level
    highest = F.transform("_p._h", lambda h, i: F.array_max(F.slice("_p._h", F.lit(1), i + 1)))
    return lists.select(*keys, "_n", F.col("_p._l").alias("_lo"), highest.alias("_hi"))


def sketches(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """(by..., name, n, sketch): a mergeable sketch per part and column, to be stored and added to part by part."""
    aggs = [a for c in columns for a in (F.count(c).alias(f"{c}__n"), F.kll_sketch_agg_double(F.col(c).cast("double")).alias(f"{c}__s"))]
    rows = df.groupBy(*by).agg(*aggs)
    parts = F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"{c}__n").alias("n"), F.col(f"{c}__s").alias("sketch")) for c in columns]))
    return rows.select(*by, parts).where("n > 0")


def estimate(stored: DataFrame, levels: list[float], by: list[str] | None = None) -> DataFrame:
    """(by..., name, n, level, value) of the union of the stored parts (rank error about 1.3 %)."""
    merged = stored.groupBy(*(by or []), "name").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    values = F.inline(F.array(*[F.struct(F.lit(q).alias("level"), F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("value")) for q in levels]))
    return merged.select(*(by or []), "name", "n", values)


def wide(df: DataFrame, wanted: dict[str, tuple[str, float]], by: list[str] | None = None) -> DataFrame:
    """One row (per group) with a column for every name."""
    rows = long(df, wanted, by)
    return rows.groupBy(*(by or [])).agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in wanted])


def quartiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, q1, median, q3) of several columns."""
    parts = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    rows = long(df, {f"{n}|{c}": (c, q) for c in columns for n, q in parts.items()})
    rows = rows.select(F.substring_index("name", "|", 1).alias("part"), F.substring_index("name", "|", -1).alias("column_name"), "value")
    return rows.groupBy("column_name").agg(*[F.max(F.when(F.col("part") == n, F.col("value"))).alias(n) for n in parts])
