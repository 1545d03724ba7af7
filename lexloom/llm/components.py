"""Connected components of an edge table, by rounds of small-neighbour linking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import staged


#: Parts into which the edges of one node are dealt.
SALTS = 16


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``edges``: ``root`` is the smallest node it reaches.

    Each round links every node's larger neighbours to its smallest one, then the smaller neighbours
    of each node to their smallest, until nothing moves.  Edges never grow in number beyond one a
    node and edge, paths halve, and each round is written to the shared folder, so neither a long
    chain nor a lost executor costs more than its round.  A hub's edges are combined by ``min`` on the
    map side and dealt out by salt to meet what they are compared with; no neighbourhood is ever gathered in one place.
    """
    now = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "components")
    while True:
        both = now.union(now.select(F.col("v"), F.col("u")))
        least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).withColumn("m", F.least("k", "m"))
        dealt = least.select("k", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("ks"))
        salted = both.withColumn("us", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).where("v > u")
        large = salted.join(dealt.hint("merge"), (F.col("u") == F.col("k")) & (F.col("us") == F.col("ks"))).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "components")
        floor = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = large.join(floor, large.u == floor.k)
        small = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        after = staged(small.where("u <> v").distinct(), "components")
        if _mark(after) == _mark(now):
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).union(after.select("v", "v").distinct())
        now = after


def _mark(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(mixed, 20)), F.bit_xor(mixed)).first())
