"""Blind ballots: decoding, agreement, overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decode(ballots: DataFrame, sides: DataFrame, key: str, verdict: str, a: str) -> DataFrame:
    """Verdicts A and B as what stood on that side; any other verdict as it is."""
    own = sides.select(F.col(key).alias("_k"), F.col(a).alias("_a"))
    other = F.when(F.col("_a") == "candidate", "legacy").otherwise("candidate")
    told = F.when(F.col(verdict) == "A", F.col("_a")).when(F.col(verdict) == "B", other).otherwise(F.col(verdict))
    return ballots.join(own, ballots[key] == own["_k"]).withColumn("decoded", told).drop("_k", "_a")


def agreement(human: Column, machine: Column) -> Column:
    sides = ("candidate", "legacy")
    abstains = human.isin("unjudged", "cannot-judge") | (machine == "cannot-judge")
    return F.when(human == machine, "agree").when(abstains, "abstain").when(human.isin(*sides) & machine.isin(*sides), "flip").otherwise("mismatch")


def agreement_matrix(rows: DataFrame, field: str, status: str) -> DataFrame:
    """By field: counts of each status and the share of agreement among what is not an abstention."""
    kinds = ("agree", "flip", "abstain", "mismatch")
    told = rows.groupBy(field).agg(*[F.count_if(F.col(status) == k).alias(k) for k in kinds])
    return told.withColumn("ratio", F.round(F.try_divide(F.col("agree"), F.col("agree") + F.col("flip") + F.col("mismatch")), 4))


def overall_agreement(rows: DataFrame, status: str) -> DataFrame:
    """One row: counts of each status over all fields and the share of agreement among what is not an abstention."""
    kinds = ("agree", "flip", "abstain", "mismatch")
    told = rows.agg(*[F.count_if(F.col(status) == k).alias(k) for k in kinds])
    return told.withColumn("ratio", F.round(F.try_divide(F.col("agree"), F.col("agree") + F.col("flip") + F.col("mismatch")), 4))


def reconciled(human: DataFrame, sides: DataFrame, machine: DataFrame, key: str, field: str, verdict: str, a: str) -> DataFrame:
    """Human ballots decoded beside what the machine decided of the same field, empty where it decided nothing."""
    own = decode(human, sides, key, verdict, a)
    other = machine.select(F.col(key).alias("_k"), F.col(field).alias("_f"), F.col("decoded").alias("machine"))
    told = own.join(other, (F.col(key) == F.col("_k")) & (F.col(field) == F.col("_f")), "left").drop("_k", "_f")
    return told.withColumn("machine", F.coalesce("machine", F.lit(""))).withColumn("status", agreement(F.col("decoded"), F.col("machine")))


def pair_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: pairs in both, and in one only, each pair counted once."""
    cols = a.columns
    either = a.distinct().withColumn("_a", F.lit(1)).join(b.distinct().withColumn("_b", F.lit(1)), cols, "full_outer")
    has_a, has_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    return either.agg(F.count_if(has_a & has_b).alias("both"), F.count_if(has_a & ~has_b).alias("only_a"), F.count_if(~has_a & has_b).alias("only_b"))


def systematic(rows: DataFrame, field: str, card: str, at_least: int = 3) -> DataFrame:
    """Fields in which at least so many regressions lie on at least so many cards."""
    return rows.groupBy(field).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(card).alias("cards")).where((F.col("n") >= at_least) & (F.col("cards") >= at_least))


def critical_counts(ballots: DataFrame, sides: DataFrame, key: str, criticals: str, a: str) -> DataFrame:
    """``error, side, n`` of severe errors that ballots mark (A6): ``criticals`` maps an error to ``A``, ``B``, ``both`` or nothing.

    Sides are what stood there; an error of both counts for each.
    """
    own = sides.select(F.col(key).alias("_k"), F.col(a).alias("_a"))
    told = ballots.select(F.col(key).alias("_b"), F.explode(criticals).alias("error", "_s")).join(own, F.col("_b") == F.col("_k"))
    other = F.when(F.col("_a") == "candidate", "legacy").otherwise("candidate")
    marked = F.when(F.col("_s") == "A", F.array("_a")).when(F.col("_s") == "B", F.array(other)).when(F.col("_s") == "both", F.array(F.lit("candidate"), F.lit("legacy")))
    return told.select("error", F.explode(marked).alias("side")).groupBy("error", "side").agg(F.count(F.lit(1)).alias("n"))
