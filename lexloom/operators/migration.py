"""Changes to single cells of a table: applied, audited, verified, undone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cell_hash


def drifted(changes: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Changes that may not be applied: no such row, or its cell is no longer what it was (``changes``: key, field, before, after)."""
    now = cells(table, key, None).withColumnsRenamed({key: "_k", "field": "_f", "value": "_v"})
    told = changes.join(now, (changes[key] == now["_k"]) & (changes["field"] == now["_f"]), "left")
    why = F.when(F.col("_k").isNull(), "unknown cell").when(~F.col("before").eqNullSafe(F.col("_v")), "drift").when(F.col("after").isNull(), "null value").when(F.col("before").eqNullSafe(F.col("after")), "no change")
    return told.select(*changes.columns, why.alias("why")).where("why is not null")


def cells(table: DataFrame, key: str, fields: list[str] | None) -> DataFrame:
    """Long form ``key, field, value`` (text)."""
    fields = fields or [c for c in table.columns if c != key]
    return table.select(key, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(key, fields, "field", "value")


def apply_cells(table: DataFrame, changes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The table with changed cells; a changed cell's text is cast to its column's type, null makes it null.  Copy on write."""
    held = changes.select(F.col(key).alias("_k"), "field", F.struct("after").alias("_to"))
    wide = held.groupBy("_k").pivot("field", fields).agg(F.first("_to"))
    wide = wide.withColumnsRenamed({f: f"_new_{f}" for f in fields})
    new = {f: F.when(F.col(f"_new_{f}").isNotNull(), F.col(f"_new_{f}.after").cast(table.schema[f].dataType)).otherwise(F.col(f)).alias(f) for f in fields}
    return table.join(wide, table[key] == wide["_k"], "left").select(*[new.get(c, F.col(c)) for c in table.columns])


def audit_rows(changes: DataFrame, key: str) -> DataFrame:
    return changes.select(key, "field", "before", "after", cell_hash(F.col("before")).alias("before_sha"), cell_hash(F.col("after")).alias("after_sha"))


def differences(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """``key, field, before, after`` of every cell that differs, null-safe; rows on one side only differ in all cells."""
    a = cells(before, key, None).withColumnRenamed("value", "before")
    b = cells(after, key, None).withColumnRenamed("value", "after")
    return a.join(b, [key, "field"], "full_outer").where(~F.col("before").eqNullSafe(F.col("after"))).select(key, "field", "before", "after")


def logical_hash(table: DataFrame) -> DataFrame:
    """One row that any order and partitioning of the same rows gives: their number and a hash of all of them.

    A row's hash is the SHA-256 of its canonical JSON (columns by name, nulls kept); two 60-bit parts of it are
    summed exactly, so that rows that repeat count, and the sums are hashed with the number of rows.
    """
    row = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(table.columns)]), {"ignoreNullFields": "false"}), 256)
    part = lambda at: F.sum(F.conv(F.substring(row, at, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    told = table.agg(F.count(F.lit(1)).alias("n_rows"), part(1).alias("_a"), part(16).alias("_b"))
    return told.select("n_rows", F.sha2(F.concat_ws(":", F.col("n_rows").cast("string"), F.coalesce("_a", F.lit("0")), F.coalesce("_b", F.lit("0"))), 256).alias("sha256"))


def rolled_back(after: DataFrame, audit: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """What ``apply_cells`` did, undone from its audit rows."""
    back = audit.select(key, "field", F.col("after").alias("before"), F.col("before").alias("after"))
    return apply_cells(after, back, key, fields)
