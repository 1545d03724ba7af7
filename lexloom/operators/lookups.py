"""Joins of records with what belongs to them, and the reports that come out of these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_ids(table: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the wanted ids, and the ids that have none (S3, SA1, Z6)."""
    wanted = ids.select(key).distinct()
    return table.join(wanted, key, "left_semi"), wanted.join(table.select(key), key, "left_anti")


def first_per_group(table: DataFrame, group: str, key: str) -> DataFrame:
    """Of each group the row with the smallest key, whole."""
    least = table.groupBy(F.col(group).alias("_g")).agg(F.min(key).alias("_k"))
    return table.join(least, F.col(group).eqNullSafe(F.col("_g")) & (F.col(key) == F.col("_k"))).drop("_g", "_k")


def children_of_run(children: DataFrame, parents: DataFrame, parent: str, key: str, run: Column, carry: list[str]) -> DataFrame:
    """Children of one run with what is carried of their parents."""
    own = parents.select(F.col(key).alias("_p"), *carry)
    return children.where(run).join(own, F.col(parent) == F.col("_p")).drop("_p")


def with_overlay(rows: DataFrame, gold: DataFrame, corrections: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows with the gold values of their id, corrected where there is a correction (J8); rows without gold have nulls."""
    fixed = corrections.select(F.col(key).alias("_c"), *[F.col(f).alias(f"_c_{f}") for f in fields])
    told = gold.select(F.col(key).alias("_g"), *[F.col(f).alias(f"_g_{f}") for f in fields]).join(fixed, F.col("_g") == F.col("_c"), "left")
    told = told.select("_g", *[F.coalesce(f"_c_{f}", f"_g_{f}").alias(f"gold_{f}") for f in fields])
    return rows.join(told, F.col(key) == F.col("_g"), "left").drop("_g")


def chained(rows: DataFrame, key: str, others: dict[str, tuple[DataFrame, list[str]]], how: str = "left") -> DataFrame:
    """Rows with the columns of other tables under the same key, one join a table and never by position."""
    for name, (other, carry) in others.items():
        own = other.select(F.col(key).alias(f"_{name}"), *[F.col(c).alias(f"{name}_{c}") for c in carry])
        rows = rows.join(own, F.col(key) == F.col(f"_{name}"), how).drop(f"_{name}")
    return rows


def by_trailing_id(a: DataFrame, b: DataFrame, key: str, mark: str, fields: list[str]) -> DataFrame:
    """Rows of two reports whose keys end in the same id after ``mark`` (J11), with fields of both."""
    tail = lambda df, side: df.select(F.substring_index(key, mark, -1).alias(f"_{side}"), *[F.col(f).alias(f"{f}_{side}") for f in fields])
    return tail(a, "a").join(tail(b, "b"), F.col("_a") == F.col("_b")).select(F.col("_a").alias("id"), *[f"{f}_{side}" for f in fields for side in "ab"])


def drifted_identities(manifest: DataFrame, master: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, problem`` of manifest rows that the master lacks or holds otherwise."""
    own = master.select(F.col(key).alias("_m"), *[F.col(f).alias(f"_{f}") for f in fields])
    differs = F.array_join(F.filter(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull()), ",")
    told = manifest.join(own, F.col(key) == F.col("_m"), "left").withColumn("problem", F.when(F.col("_m").isNull(), "unknown").otherwise(differs))
    return told.where("problem <> ''").select(key, "problem")


def wins(decoded: DataFrame, field: str, verdict: str) -> DataFrame:
    """Counts of each verdict by field, side by side."""
    return decoded.groupBy(field).pivot(verdict, ["candidate", "legacy", "tie", "cannot-judge", "unjudged"]).count().na.fill(0)


def win_rates(decoded: DataFrame, verdict: str) -> DataFrame:
    """``verdict, n, share`` over all that was judged; null verdicts are a class of their own."""
    n = decoded.groupBy(verdict).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 4))  # one row a verdict


def repeated_with_span(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys of several rows with their number, least and greatest value."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("least"), F.max(value).alias("greatest")).where("n > 1")


def with_totals(parents: DataFrame, children: DataFrame, key: str, totals: dict[str, Column]) -> DataFrame:
    """Parents with counts over their children, 0 where there are none: one aggregate, no query a row."""
    own = children.groupBy(F.col(key).alias("_k")).agg(*[c.alias(name) for name, c in totals.items()])
    told = parents.join(own, F.col(key) == F.col("_k"), "left")
    return told.select(*parents.columns, *[F.coalesce(name, F.lit(0)).alias(name) for name in totals])


def file_hashes(spark, path: str) -> DataFrame:
    """``file, n_bytes, sha256`` of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def folder_hash(hashes: DataFrame) -> DataFrame:
    """One hash of a folder's files, whatever their order (A22): of names and hashes, sorted."""
    from .records import selection_hash

    return selection_hash(hashes.select(F.concat_ws(":", "file", "sha256").alias("line")), "line")


def outcomes_by_identity(rows: DataFrame, keys: list[str], passed: str) -> DataFrame:
    """Distinct identities with whether any of their rows passed."""
    return rows.groupBy(*keys).agg(F.bool_or(F.coalesce(F.col(passed), F.lit(False))).alias("passed"))


def input_manifest(log: DataFrame, key: str, line: str, checks: str, prompt: str) -> DataFrame:
    """``key, status, failed, prompt`` of each key's latest record (Z9): failed checks sorted, ``pass`` if there are none."""
    last = log.groupBy(key).agg(F.max_by(F.struct(checks, prompt), line).alias("_x"))
    bad = F.array_sort(F.map_keys(F.map_filter(F.col(f"_x.{checks}"), lambda k, v: v == "fail")))
    return last.select(key, F.when(F.size(bad) > 0, "fail").otherwise("pass").alias("status"), bad.alias("failed"), F.col(f"_x.{prompt}").alias("prompt"))


def resolved_counts(rows: DataFrame, source: str) -> DataFrame:
    """``source, n`` after a repair, what was found nowhere as ``missing``."""
    return rows.groupBy(F.coalesce(source, F.lit("missing")).alias("source")).agg(F.count(F.lit(1)).alias("n"))


def changed_counts(before: Column, after: Column, rows: DataFrame) -> DataFrame:
    """One row: how many values a repair changed and how many it did not."""
    same = before.eqNullSafe(after)
    return rows.agg(F.count_if(~same).alias("changed"), F.count_if(same).alias("unchanged"))


def in_cohort(tags: Column, verdict: str) -> Column:
    """Whether a card's tags put it into a cohort of verdicts."""
    return F.coalesce(F.array_contains(tags, verdict), F.lit(False))


def with_sign(rows: DataFrame, key: str, fields: list[str], sign: str = "%") -> DataFrame:
    """Keys of rows in which a field holds a sign that templates would read, with those fields."""
    held = F.filter(F.array(*[F.when(F.contains(F.col(f), F.lit(sign)), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return rows.select(key, held.alias("fields")).where(F.size("fields") > 0)


def sealed(rows: DataFrame, key: str) -> DataFrame:
    """Rows with ``seal``, the SHA-256 of their canonical JSON without it."""
    body = F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
    return rows.withColumn("seal", F.sha2(body, 256))


def broken_seals(rows: DataFrame, key: str) -> DataFrame:
    """Keys whose seal is not that of what they hold."""
    own = [c for c in rows.columns if c != "seal"]
    body = F.to_json(F.struct(*[F.col(c) for c in sorted(own)]), {"ignoreNullFields": "false"})
    return rows.where(~F.col("seal").eqNullSafe(F.sha2(body, 256))).select(key)
