"""Records as wholes: provenance, sequences, parity, metric tables, phases, ids and hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import global_position


def transport(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """The named columns under their names of transport, and no others."""
    return rows.select(*[F.col(c).alias(name) for c, name in names.items()])


def missing_fields(groups: dict[str, list[str]]) -> Column:
    """``group.field`` of every required field of a nested record that is null, in order."""
    paths = [f"{g}.{f}" for g, fs in groups.items() for f in fs]
    return F.filter(F.array(*[F.when(F.col(p).isNull(), F.lit(p)) for p in paths]), lambda x: x.isNotNull())


def sequence_defects(rows: DataFrame, parent: str, number: str, primary: str) -> DataFrame:
    """Parents whose children are not numbered 1 .. n without gap, or have not exactly one primary."""
    told = rows.groupBy(parent).agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi"), F.count_distinct(number).alias("kinds"), F.count_if(primary).alias("primaries"))
    gap = (F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("kinds") != F.col("n"))
    codes = F.array(F.when(gap, "NOT_SEQUENTIAL"), F.when(F.col("primaries") != 1, "PRIMARY_COUNT"))
    return told.withColumn("codes", F.filter(codes, lambda x: x.isNotNull())).where(F.size("codes") > 0).select(parent, "n", "codes")


def parity(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys whose number of rows differs between two tables (0 where a key is absent)."""
    left = a.groupBy(key).agg(F.count(F.lit(1)).alias("in_a"))
    right = b.groupBy(key).agg(F.count(F.lit(1)).alias("in_b"))
    both = left.join(right, key, "full_outer").select(key, F.coalesce("in_a", F.lit(0)).alias("in_a"), F.coalesce("in_b", F.lit(0)).alias("in_b"))
    return both.where("in_a <> in_b")


def metric_changes(before: DataFrame, after: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """``key, metric, before, after, change`` in long form."""
    long = lambda df, name: df.select(key, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(key, metrics, "metric", name)
    both = long(before, "before").join(long(after, "after"), [key, "metric"], "full_outer")
    return both.withColumn("change", F.round(F.col("after") - F.col("before"), 6))


def phases(log: DataFrame, key: str, phase: str, wanted: list[str]) -> DataFrame:
    """Of each key, which of the wanted phases it has been through, and whether all."""
    flags = [F.bool_or(F.col(phase) == p).alias(p) for p in wanted]
    return log.groupBy(key).agg(*flags).withColumn("complete", reduce(Column.__and__, [F.col(p) for p in wanted]))


def next_ids(rows: DataFrame, table: DataFrame, key: str, order: str, prefix: str) -> DataFrame:
    """New rows with ids that go on after the largest of the table: ``prefix-0007`` and so on.

    Numbers come from a range partitioning by ``order``, which must be unique.
    """
    last = table.agg(F.coalesce(F.max(F.regexp_extract(key, r"(\d+)$", 1).cast("long")), F.lit(0)).alias("_last"))
    placed = global_position(rows, [F.col(order)], "_n")
    return placed.join(F.broadcast(last)).withColumn(key, F.format_string(f"{prefix}-%04d", F.col("_last") + F.col("_n"))).drop("_n", "_last")  # one row


def selection_hash(rows: DataFrame, key: str, chunk: int = 4096) -> DataFrame:
    """One row: how many keys were selected and a SHA-256 of them in order.

    Keys are numbered over all partitions; each run of ``chunk`` of them is hashed, one a line, then runs of
    these hashes, until one is left: no task ever holds more than a run.
    """
    lines = global_position(rows.select(F.col(key).cast("string").alias("_line")), [F.col("_line")], "_at")
    n = total = lines.count()
    if not total:
        return rows.agg(F.count(F.lit(1)).alias("n"), F.sha2(F.lit(""), 256).alias("sha256"))
    while True:
        told = lines.withColumn("_run", F.floor((F.col("_at") - 1) / chunk)).groupBy("_run")
        joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_line"))), lambda x: x["_line"]), "\n")
        lines = told.agg(F.sha2(joined, 256).alias("_line")).select((F.col("_run") + 1).alias("_at"), "_line")
        if n <= chunk:
            return lines.select(F.lit(total).cast("long").alias("n"), F.col("_line").alias("sha256"))
        n = -(-n // chunk)


def arms(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Both versions of each record in the same shape: ``key, arm, fields...``, for keys that have both."""
    both = old.select(key).intersect(new.select(key))
    put = lambda df, arm: df.join(both, key, "left_semi").select(key, F.lit(arm).alias("arm"), *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields])
    return put(old, "legacy").unionByName(put(new, "candidate"))


def observations(rows: DataFrame, key: Column, value: Column, pins: list[Column]) -> DataFrame:
    """Observations with ``problem``: a key that is not ``word/pos``, a value that is not finite, an empty pin."""
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    problem = F.when(~F.coalesce(key.rlike("^[^/]+/[^/]+$"), F.lit(False)), "key").when(~F.coalesce(finite, F.lit(False)), "value")
    for i, pin in enumerate(pins):
        problem = problem.when(pin.isNull() | (F.trim(pin) == ""), f"pin {i + 1}")
    return rows.withColumn("problem", problem)
