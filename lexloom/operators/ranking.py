"""Ranks: frequencies, dense ranks in a scope, global order, spacing of repeated words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.base import cut

# Levels, the gap kept between copies of a word at each, and orders among parts of speech.
LEVELS = ["A1", "A2", "B1", "B2", "C1", "C2"]
GAPS = {"A1": 100, "A2": 150, "B1": 200, "B2": 300, "C1": 400, "C2": 500}
DEFAULT_GAP = 200
POS_TIEBREAK = {"det": 1, "pron": 2, "conj": 3, "prep": 4, "noun": 5, "verb": 6, "modal": 6, "adj": 7, "adv": 8, "num": 9, "excl": 10}
POS_RATIO = {"verb": 1.0, "modal": 0.98, "conj": 0.95, "prep": 0.93, "pron": 0.92, "det": 0.9, "noun": 0.88, "adv": 0.75, "adj": 0.7, "num": 0.65, "excl": 0.4}


def lookup(table: dict, key: Column, default) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), key), F.lit(default))


def word_frequency(words: DataFrame, scope: str, word: str) -> DataFrame:
    """``scope, word, n, zipf``: occurrences and log10 of them per thousand million.

    The text is read once: counts, of which totals are made, are checkpointed.  Scopes are languages or versions,
    of which there are few; a null scope is one of them.
    """
    counts = cut(words.groupBy(scope, word).agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy(F.col(scope).alias("_s")).agg(F.sum("n").alias("_all"))
    zipf = F.round(F.log10(F.col("n") / F.col("_all") * 1e9), 6)
    return counts.join(totals, F.col(scope).eqNullSafe(F.col("_s"))).select(scope, word, "n", zipf.alias("zipf"))


def latest_per_key(rows: DataFrame, keys: list[str], line: str, *ties: str) -> DataFrame:
    """The last row of each key in an append log (by an explicit line), whole."""
    last = Window.partitionBy(*keys).orderBy(F.col(line).desc(), *[F.col(t).desc() for t in ties])
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def dense_rank_in_scope(rows: DataFrame, scope: str, value: str, into: str = "rank") -> DataFrame:
    """Dense rank of a value in its scope, highest first.

    Ranked are the distinct values, which map-side aggregation leaves few of; rows take theirs by a join, dealt
    by salt, because one value can have most of the rows.
    """
    salts = 16
    values = rows.select(F.col(scope).alias("_s"), F.col(value).alias("_v")).distinct()
    ranks = values.withColumn(into, F.dense_rank().over(Window.partitionBy("_s").orderBy(F.col("_v").desc())))
    ranks = ranks.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_n", F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(salts)).cast("int"))
    return salted.join(ranks, F.col(scope).eqNullSafe(F.col("_s")) & F.col(value).eqNullSafe(F.col("_v")) & (F.col("_n") == F.col("_k"))).drop("_s", "_v", "_k", "_n")


def ranked_observations(rows: DataFrame, keys: list[str], scope: list[str], value: str, order: str) -> DataFrame:
    """Dense ranks of the last observation of each key in one scope; observations of several scopes are refused."""
    last = latest_per_key(rows, keys, order)
    named = last.withColumn("_scope", F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in scope]))
    scopes = named.select("_scope").distinct().limit(2).count()
    if scopes > 1:
        raise ValueError("observations of several scopes are not ranked together")
    return dense_rank_in_scope(named, "_scope", value).drop("_scope")


def global_position(rows: DataFrame, order: list[Column], into: str) -> DataFrame:
    """1, 2, ... over all rows in ``order`` (which must be total), without one task that sees them all.

    Sampled splitters range-partition the rows; each partition numbers its own, and adds the counts of
    those before it.
    """
    keys = {f"_gp_o{i}": c for i, c in enumerate(order)}
    laid = rows.withColumns(keys).repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    laid = cut(laid.withColumn("_gp_m", F.monotonically_increasing_id()).drop(*keys)).withColumn("_gp_p", F.shiftright("_gp_m", 33))
    sizes = laid.groupBy(F.col("_gp_p").alias("_gp_q")).agg(F.count(F.lit(1)).alias("_gp_n"))
    before = Window.orderBy("_gp_q").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sizes = sizes.select("_gp_q", F.coalesce(F.sum("_gp_n").over(before), F.lit(0)).alias("_gp_before"))
    place = F.col("_gp_before") + F.col("_gp_m") - F.shiftleft(F.col("_gp_p"), 33) + 1
    return laid.join(sizes, F.col("_gp_p") == F.col("_gp_q")).withColumn(into, place).drop("_gp_m", "_gp_p", "_gp_q", "_gp_before")


def position_in_scope(rows: DataFrame, scope: list[str], order: list[Column], into: str, total: str | None = None) -> DataFrame:
    """1, 2, ... within each scope in ``order`` (which must be total there), and in ``total`` the size of the scope.

    One range sort by scope and order; partitions number the rows that they hold of each scope and add the counts
    of earlier partitions.  A scope of any size spreads over partitions, so none has to fit in a task.  A null scope is one.
    """
    keys = {f"_gp_s{i}": F.col(c) for i, c in enumerate(scope)} | {f"_gp_o{i}": c for i, c in enumerate(order)}
    laid = rows.withColumns(keys).repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    laid = cut(laid.withColumn("_gp_m", F.monotonically_increasing_id()).drop(*[f"_gp_o{i}" for i in range(len(order))])).withColumn("_gp_p", F.shiftright("_gp_m", 33))
    scopes = [f"_gp_s{i}" for i in range(len(scope))]
    # A row a partition and scope: as many as there are partitions and scopes together.
    sizes = laid.groupBy("_gp_p", *scopes).agg(F.count(F.lit(1)).alias("_gp_n"), F.min("_gp_m").alias("_gp_first"))
    own = Window.partitionBy(*scopes)
    before = own.orderBy("_gp_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(s).alias(f"{s}_") for s in scopes], F.col("_gp_p").alias("_gp_q"), "_gp_first", F.coalesce(F.sum("_gp_n").over(before), F.lit(0)).alias("_gp_before"), F.sum("_gp_n").over(own).alias("_gp_all"))
    same = F.col("_gp_p") == F.col("_gp_q")
    for s in scopes:
        same = same & F.col(s).eqNullSafe(F.col(f"{s}_"))
    placed = laid.join(sizes, same).withColumn(into, F.col("_gp_before") + F.col("_gp_m") - F.col("_gp_first") + 1)
    if total:
        placed = placed.withColumn(total, F.col("_gp_all"))
    return placed.drop("_gp_m", "_gp_p", "_gp_q", "_gp_first", "_gp_before", "_gp_all", *scopes, *[f"{s}_" for s in scopes])


def rerank_globally(rows: DataFrame, zipf: str, pos: str, rank: str, into: str = "new_rank") -> DataFrame:
    """By frequency, then part of speech, then the rank so far."""
    tie = lookup(POS_TIEBREAK, F.col(pos), 10)
    return global_position(rows, [-F.col(zipf), tie, F.col(rank)], into)


def reorder_duplicates(rows: DataFrame, word: str, pos: str, rank: str, into: str = "new_rank") -> DataFrame:
    """Among rows of one word, its ranks are dealt again: the lowest to the commonest part of speech."""
    by_rank = Window.partitionBy(word).orderBy(rank)
    by_pos = Window.partitionBy(word).orderBy(lookup(POS_RATIO, F.col(pos), 0.5).desc(), rank)
    ranks = rows.select(F.col(word).alias("_w"), F.col(rank).alias(into), F.row_number().over(by_rank).alias("_k"))
    placed = rows.withColumn("_n", F.row_number().over(by_pos))
    return placed.join(ranks, (F.col(word) == F.col("_w")) & (F.col("_n") == F.col("_k"))).drop("_w", "_k", "_n")


def space_copies(rows: DataFrame, word: str, level: str, rank: str, into: str = "new_rank") -> DataFrame:
    """Copies of a word move behind its first by a level's gap each; then all is numbered anew."""
    own = Window.partitionBy(word).orderBy(rank)
    anchor, nth = F.first(rank).over(own), F.row_number().over(own) - 1
    gap = lookup(GAPS, F.first(level).over(own), DEFAULT_GAP)
    return global_position(rows.withColumn("_key", anchor + nth * gap), [F.col("_key"), F.col(rank)], into).drop("_key")
