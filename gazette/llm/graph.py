"""Connected components by contraction: every node joins a neighbour, edges shrink, repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import discard, kept


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of `edges` (a, b) and the smallest node it reaches.

    A round lets each node follow the least of its neighbours and itself in an order
    drawn anew by hash, and then where that one goes, so a chain shrinks by a constant
    factor as well as a star. The minima combine before the shuffle; every table of a round
    is written to the shared folder, so a hub's edges are split by the adaptive join and a
    lost executor costs one step; a round's tables are deleted once the next one's stand. Loops, repeated edges and edges with a null end are ignored; a node that
    only has loops is its own component.
    """
    edges = edges.select(F.col("a"), F.col("b")).where("a is not null and b is not null")
    left = kept(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    root = kept(
        left.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("root")),
        "roots")
    old, left = [left], left.where("a <> b")
    draw = 0
    while not left.isEmpty():
        draw += 1
        both = left.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            left.select(F.col("b").alias("u"), F.col("a").alias("v")))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(draw)).alias("h"), F.col(c).alias("to"))
        least = both.groupBy("u").agg(F.min(order("v")).alias("v"))
        first = kept(least.select("u", F.least(F.col("v"), order("u"))["to"].alias("to")), "follow")
        # two steps at once: where the neighbour itself goes
        onward = first.select(F.col("u").alias("to"), F.col("to").alias("on"))
        follow = kept(first.join(onward, "to").select("u", F.col("on").alias("to")), "follow")
        shrunk = kept(
            left.join(follow.withColumnsRenamed({"u": "a", "to": "a2"}), "a")
            .join(follow.withColumnsRenamed({"u": "b", "to": "b2"}), "b")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
            .where("a <> b").distinct(), "edges")
        moved = kept(
            root.join(follow.withColumnRenamed("u", "root"), "root", "left")
            .select("node", F.coalesce("to", "root").alias("root")), "roots")
        discard(*old, root, first, follow)
        old, left, root = [shrunk], shrunk, moved
    smallest = root.groupBy("root").agg(F.min("node").alias("component"))
    return root.join(kept(smallest, "smallest"), "root").select("node", "component")
