"""Constraints as queries for what violates them: ``check, entity, detail``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeated_keys(rows: DataFrame, keys: list[str], check: str) -> DataFrame:
    told = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return told.select(F.lit(check).alias("check"), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]).alias("entity"), F.col("_n").cast("string").alias("detail"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, check: str) -> DataFrame:
    lost = child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias("_p")), F.col(key) == F.col("_p"), "left_anti")
    return lost.groupBy(F.col(key).cast("string").alias("entity")).agg(F.count(F.lit(1)).cast("string").alias("detail")).select(F.lit(check).alias("check"), "entity", "detail")


def broken(rows: DataFrame, entity: str, holds: Column, detail: Column, check: str) -> DataFrame:
    """Rows for which a condition does not hold; unknown counts as broken."""
    return rows.where(~F.coalesce(holds, F.lit(False))).select(F.lit(check).alias("check"), F.col(entity).cast("string").alias("entity"), detail.cast("string").alias("detail"))


def audit(*violations: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, violations)


def null_rates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``field, n_null, rate`` of each column, in one pass."""
    told = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")).alias(c) for c in columns])
    each = F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])).alias("field", "n_null")
    return told.select("_n", each).select("field", "n_null", F.round(F.try_divide(F.col("n_null"), F.col("_n")), 4).alias("rate"))


def gate(rows: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Rows with ``rejected``: the codes of the tests they fail, in order; accepted rows have none."""
    codes = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in tests.items()]), lambda c: c.isNotNull())
    return rows.withColumn("rejected", codes)


def imported(rows: DataFrame, word: str, pos: str, level: str, levels: list[str], numbers: dict[str, float]) -> tuple[DataFrame, DataFrame]:
    """Rows that may enter (V6), trimmed and with defaults for missing numbers, and those that may not, with ``reason``.

    A row without a word is neither: it is left out without a reason.
    """
    told = rows.withColumns({c: F.trim(F.coalesce(F.col(c), F.lit(""))) for c in (word, pos, level)}).where(F.col(word) != "")
    told = told.withColumn("reason", F.when(F.col(pos) == "", "missing part of speech").when(~F.col(level).isin(levels), "bad level"))
    fine = told.where("reason is null").drop("reason").withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(d)) for c, d in numbers.items()})
    return fine.withColumn("normalized", F.lower(word)), told.where("reason is not null")


def asserted_count(rows: DataFrame, n: int) -> DataFrame:
    """The rows; fails unless there are just ``n``."""
    got = rows.count()
    if got != n:
        raise ValueError(f"{got} rows where {n} are expected")
    return rows


def partial_unique(rows: DataFrame, keys: list[str], where: Column, check: str) -> DataFrame:
    """Keys that more than one row has among those that a condition selects (V4)."""
    return repeated_keys(rows.where(F.coalesce(where, F.lit(False))), keys, check)
