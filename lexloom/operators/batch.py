"""Batch boundary: request lines, strict accounting of outputs, envelope shapes, remaining work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import position_in_scope


def request_lines(rows: DataFrame, key: Column, template: str, fields: list[str]) -> DataFrame:
    """``key, line``: one JSON request a row, its prompt the template with the fields put in."""
    prompt = F.format_string(template, *[F.col(f) for f in fields])
    body = F.struct(F.array(F.struct(F.lit("user").alias("role"), F.array(F.struct(prompt.alias("text"))).alias("parts"))).alias("contents"))
    return rows.select(key.alias("key"), F.to_json(F.struct(key.alias("key"), body.alias("request")), {"ignoreNullFields": "false"}).alias("line"))


def account(lines: DataFrame, expected: DataFrame, key: str, order: str, malformed: Column, failed: Column) -> DataFrame:
    """Every output line with its outcome, the first test that applies.

    malformed; unknown (no key, or one that was not expected); duplicate (of an earlier line); then mapped,
    as failed or successful.
    """
    keys = expected.select(F.col(key).alias("_e")).distinct()
    told = lines.withColumn("_bad", malformed).join(keys, F.col(key) == F.col("_e"), "left")
    fine = ~F.col("_bad") & F.col("_e").isNotNull()
    # Which line of a key is the first is found by ``min``, combined on the map side; a key with very many lines is no hot group.
    first = told.where(fine).groupBy(F.col("_e").alias("_k")).agg(F.min(order).alias("_first"))
    told = told.join(first, fine & (F.col("_e") == F.col("_k")), "left")
    outcome = F.when(F.col("_bad"), "malformed").when(F.col("_e").isNull(), "unknown").when(F.col(order) > F.col("_first"), "duplicate").when(failed, "failed").otherwise("successful")
    return told.withColumn("outcome", outcome).drop("_bad", "_e", "_k", "_first")


def accounting(told: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """One row of counts; ``aborts`` unless every expected key came back once and nothing else did."""
    counts = told.agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in ("successful", "failed", "duplicate", "unknown", "malformed")])
    size = expected.agg(F.count_distinct(key).alias("expected"))
    both = counts.join(F.broadcast(size)).withColumn("mapped", F.col("successful") + F.col("failed"))  # one row each
    both = both.withColumn("missing", F.col("expected") - F.col("mapped"))
    return both.withColumn("aborts", F.col("missing") + F.col("duplicate") + F.col("unknown") + F.col("malformed") > 0)


def envelope_shapes(lines: DataFrame, line: str) -> DataFrame:
    """``shape, n``: how many lines have each set of top-level keys (null: not an object)."""
    shape = F.array_join(F.array_sort(F.json_object_keys(line)), ",")
    return lines.groupBy(shape.alias("shape")).agg(F.count(F.lit(1)).alias("n"))


def remaining(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return work.join(done, key, "left_anti")


def numbered_batches(rows: DataFrame, scope: str, order: str, size: int) -> DataFrame:
    """``batch_id`` and ``ordinal`` of each row within its scope."""
    placed = position_in_scope(rows, [scope], [F.col(order)], "_n").withColumn("_n", F.col("_n") - 1)
    return placed.withColumns({"batch_id": F.format_string("%s_batch_%d", F.col(scope), F.floor(F.col("_n") / size) + 1), "ordinal": (F.col("_n") % size + 1).cast("int")}).drop("_n")


def envelope_presence(lines: DataFrame, line: str, keys: list[str]) -> DataFrame:
    """``key, n, share`` of top-level keys over all lines."""
    told = lines.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.coalesce(F.array_contains(F.json_object_keys(line), k), F.lit(False))).alias(k) for k in keys])
    return told.select("_n", F.explode(F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k))])).alias("key", "n")).select("key", "n", F.round(F.try_divide(F.col("n"), F.col("_n")), 4).alias("share"))


def repeated_line_keys(lines: DataFrame, line: str, key: str) -> DataFrame:
    """``key, n`` of keys that several lines have."""
    return lines.select(F.get_json_object(line, f"$.{key}").alias("key")).where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
