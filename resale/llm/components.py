"""Connected components of a link table, by contraction over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resale.llm.common import written

#: Links up to which a round needs no shuffle: so few fit one task.
SMALL = 100_000


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of the links; the component is its smallest node.

    Each round points every node to the smallest of itself and its neighbours,
    follows the pointers once more, and replaces the links by links between the
    nodes pointed to; what remains shrinks fast, and the smallest node of a
    component always points to itself.  Rounds end when no link is left.  A node
    with very many neighbours is one key of joins that adaptive execution can
    split and of minima that are combined before the shuffle.  The last rounds, with at most ``SMALL``
    links left, run in one task each.
    """
    edges = written(links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x != y").distinct(), "edges")
    total = None
    while (n := edges.count()) or total is None:
        few = n <= SMALL
        edges = edges.coalesce(1) if few else edges
        ends = F.inline(F.array(F.struct(F.col("x").alias("node"), F.col("y").alias("other")), F.struct(F.col("y").alias("node"), F.col("x").alias("other"))))
        first = edges.select(ends).groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("to"))
        first = written(first, "pointers")
        first = first.coalesce(1) if few else first
        second = first.select(F.col("node").alias("to"), F.col("to").alias("further"))
        steps = written(first.join(second, "to").select("node", F.col("further").alias("to")), "steps")
        steps = steps.coalesce(1) if few else steps
        if total is None:
            total = steps
        else:
            total = total.join(steps.select(F.col("node").alias("to"), F.col("to").alias("next")), "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        at = lambda c: steps.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}"))
        moved = edges.join(at("x"), "x").join(at("y"), "y").select(F.least("to_x", "to_y").alias("x"), F.greatest("to_x", "to_y").alias("y"))
        edges = written(moved.where("x != y").distinct(), "edges")
    return total.select("node", F.col("to").alias("component"))
