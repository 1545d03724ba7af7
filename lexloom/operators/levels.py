"""Difficulty, units of a level, their roll-ups and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import syllables
from .ranking import LEVELS, lookup, position_in_scope

# Bounds of the score at each level, and what part of speech, syllables and rank add.
BOUNDS = {"A1": (2, 5), "A2": (3, 6), "B1": (4, 7), "B2": (5, 7), "C1": (7, 9), "C2": (8, 10)}
POS_DELTA = {"num": -0.5, "pron": -0.5, "excl": -0.5, "modal": -0.5, "det": 0.0, "noun": 0.0, "verb": 0.0, "adj": 0.3, "adv": 0.3, "prep": 0.7, "conj": 0.7}
SYLLABLE_DELTA = {1: -0.5, 2: 0.0, 3: 0.4, 4: 0.7}
RANK_STEPS = [(150, 0.0), (400, 0.3), (700, 0.5), (1500, 0.65), (4000, 0.78), (7000, 0.88)]


def rank_position(rank: Column) -> Column:
    out = F.lit(1.0)
    for most, at in reversed(RANK_STEPS):
        out = F.when(rank <= most, at).otherwise(out)
    return F.when(rank.isNull() | (rank <= 0), 0.5).otherwise(out)


def difficulty(level: Column, pos: Column, rank: Column, word: Column) -> Column:
    """Half-even rounded and held within the level's bounds (4 to 7 where the level is unknown)."""
    low, high = (lookup({k: b[i] for k, b in BOUNDS.items()}, level, d) for i, d in ((0, 4), (1, 7)))
    count = syllables(word)
    longer = F.when(count >= 5, 1.0).otherwise(lookup(SYLLABLE_DELTA, count, 0.0))
    raw = low + (high - low) * rank_position(rank) + lookup(POS_DELTA, pos, 0.0) + longer
    return F.greatest(low, F.least(high, F.bround(raw).cast("int")))


def score_in_bounds(score: Column, level: Column) -> Column:
    value = score.try_cast("double") if hasattr(score, "try_cast") else score.cast("double")
    low, high = (lookup({k: b[i] for k, b in BOUNDS.items()}, level, d) for i, d in ((0, 1), (1, 10)))
    return F.coalesce(value.between(low, high), F.lit(False))


def assign_units(words: DataFrame, level: str, word: str, rank: str, per_unit: int = 50) -> DataFrame:
    """``level, word, idx, unit_id``: distinct words of a level, by their lowest rank, spread evenly over its units."""
    first = words.groupBy(level, word).agg(F.min(rank).alias("first_rank"))
    told = position_in_scope(first, [level], [F.col("first_rank"), F.col(word)], "idx", "_n")
    told = told.withColumn("idx", (F.col("idx") - 1).cast("int")).withColumn("_k", F.ceil(F.col("_n") / per_unit))
    number = F.least(F.floor(F.col("idx") / (F.col("_n") / F.col("_k"))) + 1, F.col("_k"))
    return told.select(level, word, "idx", F.format_string("%s_%02d", F.col(level), number.cast("int")).alias("unit_id"))


def rollup_units(rows: DataFrame, unit: str, word: str, flags: dict[str, Column]) -> DataFrame:
    counts = [F.count_if(c).alias(name) for name, c in flags.items()]
    return rows.groupBy(unit).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.lower(F.trim(word))).alias("n_words"), *counts)


def order_units(units: DataFrame, level: str, by: dict[str, str], number: str) -> DataFrame:
    """For each named path: units by level, then by the path's count (largest first), then by their number."""
    at = lookup({x: i for i, x in enumerate(LEVELS)}, F.col(level), len(LEVELS))
    every = units.withColumn("path", F.explode(F.array(*[F.lit(p) for p in by])))
    count = F.coalesce(*[F.when(F.col("path") == path, F.col(c)) for path, c in by.items()])
    return position_in_scope(every, ["path"], [at, -count, F.col(number)], "position")


def crosstab(rows: DataFrame, level: str, flags: dict[str, Column]) -> DataFrame:
    """Counts of each flag by level, and in all (level ``all``)."""
    told = rows.rollup(level).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"), *[F.count_if(c).alias(k) for k, c in flags.items()])
    return told.withColumn(level, F.when(F.col("_g") == 1, "all").otherwise(F.col(level))).drop("_g")


def out_of_bounds(rows: DataFrame, score: str, level: str, pos: str, rank: str, word: str) -> DataFrame:
    """Rows whose score is not within their level's bounds (X4), with ``proposed``, the score they should have."""
    wrong = rows.where(~score_in_bounds(F.col(score), F.col(level)))
    return wrong.withColumn("proposed", difficulty(F.col(level), F.col(pos), F.col(rank), F.col(word)))
