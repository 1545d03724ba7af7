"""Bounded walks over an edge table that the caller gives: families of words, nearest labelled ancestors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.base import cut


def walks(starts: DataFrame, start: str, edges: DataFrame, a: str, b: str, most: int) -> DataFrame:
    """``start, node, depth`` of every node that ``most`` steps along edges from ``a`` to ``b`` reach, with the fewest steps.

    A start reaches itself in 0 steps.  Frontier by frontier: a step joins what the last one added with the edges and
    drops what was seen; each is checkpointed, and an empty one ends the walk.  Starts that repeat count once, null
    starts and null ends of edges are no nodes, and edges that repeat or lead back change nothing.
    """
    step = edges.select(F.col(a).alias("_a"), F.col(b).alias("_b")).where("_a is not null and _b is not null").distinct()
    seen = cut(starts.select(F.col(start).alias("start")).where("start is not null").distinct().select("start", F.col("start").alias("node"), F.lit(0).alias("depth")))
    fresh = seen
    for depth in range(1, most + 1):
        reached = fresh.join(step, F.col("node") == F.col("_a")).select("start", F.col("_b").alias("node")).distinct()
        fresh = cut(reached.join(seen, ["start", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if fresh.isEmpty():
            break
        seen = cut(seen.unionByName(fresh))
    return seen


def nearest_labels(starts: DataFrame, start: str, edges: DataFrame, a: str, b: str, labels: DataFrame, node: str, label: str, most: int) -> DataFrame:
    """``start, label, depth``: the label of the nearest labelled node within ``most`` steps, the start itself included.

    Of several as near the smallest label counts; null where there is none.  A start goes no further than its first
    label, so a frontier holds only what is still open.
    """
    step = edges.select(F.col(a).alias("_a"), F.col(b).alias("_b")).where("_a is not null and _b is not null").distinct()
    named = labels.where(F.col(label).isNotNull()).groupBy(F.col(node).alias("_n")).agg(F.min(label).alias("_label"))
    own = cut(starts.select(F.col(start).alias("start")).where("start is not null").distinct())
    fresh, seen, parts = own.select("start", F.col("start").alias("node")), None, []
    for depth in range(most + 1):
        told = cut(fresh.join(named, F.col("node") == F.col("_n"), "left"))
        found = told.groupBy("start").agg(F.min("_label").alias("label"), F.lit(depth).alias("depth")).where("label is not null")
        parts.append(found)
        left = told.join(found.select("start"), "start", "left_anti").select("start", "node")
        seen = left if seen is None else cut(seen.join(found.select("start"), "start", "left_anti").union(left))
        if depth == most or left.isEmpty():
            break
        fresh = cut(left.join(step, F.col("node") == F.col("_a")).select("start", F.col("_b").alias("node")).distinct().join(seen, ["start", "node"], "left_anti"))
        if fresh.isEmpty():
            break
    found = reduce(DataFrame.unionByName, parts)
    return own.join(found, "start", "left").select("start", "label", "depth")


def families(walked: DataFrame, nodes: DataFrame, node: str, kind: str, name: str, kinds: list[str]) -> DataFrame:
    """``start`` and a column a kind: the name of the nearest node of that kind (at one step or more), '' if there is none.

    Of several as near the smallest name counts.
    """
    own = nodes.select(F.col(node).alias("_n"), F.col(kind).alias("_kind"), F.col(name).alias("_name"))
    told = walked.join(own, F.col("node") == F.col("_n"), "left")
    best = lambda k: F.coalesce(F.min(F.when((F.col("_kind") == k) & (F.col("depth") > 0) & F.col("_name").isNotNull(), F.struct("depth", "_name")))["_name"], F.lit(""))
    return told.groupBy("start").agg(*[best(k).alias(k) for k in kinds])
