"""Gates and audits of whole runs: staging integrity, preflight, locks, quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .artifacts import CATEGORIES, PRIMARY_SENSES, REGISTERS, bad_tags


def latest_run(runs: DataFrame, key: str = "id") -> DataFrame:
    """The run with the largest id."""
    return runs.orderBy(F.col(key).desc()).limit(1)


def staging_audit(runs: DataFrame, words: DataFrame, senses: DataFrame, sounds: DataFrame, versions: DataFrame, run: int | None = None) -> DataFrame:
    """``entity, id, code`` of everything wrong with a run's rows in the staging tables (V5); the latest run if none is named.

    ``senses`` have ``id, word_id, run_id, sense_no, is_primary, definition_en, definition_ar, short_def_en,
    register, primary_sense, mnemonic_ar, semantic_tags`` (JSON); ``sounds`` one row a word and ``variant``.
    A missing closed value is an error here.
    """
    own_run = latest_run(runs) if run is None else runs.where(F.col("id") == run)
    of_run = senses.join(F.broadcast(own_run.select(F.col("id").alias("_run"))), F.col("run_id") == F.col("_run")).drop("_run")  # one row
    out = [own_run.where(~F.coalesce(F.col("status") == "completed", F.lit(False))).select(F.lit("run").alias("entity"), F.col("id").cast("long").alias("id"), F.lit("RUN_STATUS").alias("code"))]
    none = of_run.agg(F.count(F.lit(1)).alias("_n")).where("_n = 0")
    out.append(none.select(F.lit("run").alias("entity"), F.lit(None).cast("long").alias("id"), F.lit("NO_SENSES").alias("code")))

    per_word = of_run.groupBy("word_id").agg(F.count_if(F.coalesce(F.col("is_primary"), F.lit(False))).alias("_primary"))
    spoken = sounds.groupBy(F.col("word_id").alias("_w")).agg(*[F.max(F.when(F.col("variant") == v, F.col("ipa"))).alias(f"_{v}") for v in ("us", "uk", "ar")])
    told = per_word.join(words.select(F.col("id").alias("_id"), "category"), F.col("word_id") == F.col("_id"), "left").join(spoken, F.col("word_id") == F.col("_w"), "left")
    missing = lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    tests = {
        "CATEGORY": ~F.coalesce(F.col("category").isin(CATEGORIES), F.lit(False)),
        "US_MISSING": missing("_us"),
        "US_SLASHES": F.col("_us").contains("/"),
        "UK_SLASHES": F.col("_uk").contains("/"),
        "AR_MISSING": missing("_ar"),
        "PRIMARY_COUNT": F.col("_primary") != 1,
    }
    codes = lambda t: F.explode(F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in t.items()]), lambda x: x.isNotNull()))
    out.append(told.select(F.lit("word").alias("entity"), F.col("word_id").cast("long").alias("id"), codes(tests).alias("code")))

    logged = versions.where("entity_type = 'sense'").select(F.col("entity_id").alias("_e")).distinct()
    each = of_run.join(logged, F.col("id") == F.col("_e"), "left")
    tags = bad_tags(F.from_json("semantic_tags", "array<string>"))
    of_sense = {
        "DEFINITIONS": missing("definition_en") | missing("definition_ar") | missing("short_def_en"),
        "REGISTER": ~F.coalesce(F.col("register").isin(REGISTERS), F.lit(False)),
        "PRIMARY_SENSE": ~F.coalesce(F.col("primary_sense").isin(PRIMARY_SENSES), F.lit(False)),
        "BRACKETS": F.col("mnemonic_ar").rlike(r"[()\[\]]"),
        "TAGS": tags.isNotNull(),
        "NO_LINEAGE": F.col("_e").isNull(),
    }
    out.append(each.select(F.lit("sense").alias("entity"), F.col("id").cast("long").alias("id"), codes(of_sense).alias("code")))
    return reduce(DataFrame.unionByName, out)


def preflight(spark: SparkSession, files: list[str], tables: dict[str, DataFrame], columns: dict[str, list[str]], hashes: dict[str, str] | None = None) -> DataFrame:
    """``check, subject, ok`` (V7, S12): files exist and have the SHA-256 that is promised, tables have rows and the columns they need.

    A file is hashed as a stream, of any size; one that does not exist has no hash.  Tables are counted as a whole, with the
    columns they need, so that one which breaks off or cannot be read fails here and not in the run.
    """
    told = []
    for f, promised in (hashes or {}).items():
        told.append(("hash", f, file_sha256(spark, f) == promised))
    for f in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        told.append(("file", f, bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))))
    for name, table in tables.items():
        held = [F.count(F.col(f"`{c}`")) for c in columns.get(name, []) if c in table.columns]
        told.append(("rows", name, table.agg(F.count(F.lit(1)), *held).first()[0] > 0))
        told += [("column", f"{name}.{c}", c in table.columns) for c in columns.get(name, [])]
    return spark.createDataFrame(told, "check string, subject string, ok boolean")


def file_sha256(spark: SparkSession, path: str) -> str | None:
    """The SHA-256 of one file, null if there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def discovered(tables: dict[str, DataFrame]) -> list[tuple[str, str, str, int]]:
    """``table, column, type, place`` of every column."""
    return [(name, f.name, f.dataType.simpleString(), i + 1) for name, t in sorted(tables.items()) for i, f in enumerate(t.schema.fields)]


def golden_gate(rows: DataFrame, sha256: str, n_rows: int) -> DataFrame:
    """``n_rows, sha256, ok`` (V8): the table is the one whose hash and count were recorded."""
    from .migration import logical_hash

    return logical_hash(rows).withColumn("ok", (F.col("sha256") == sha256) & (F.col("n_rows") == n_rows))


def lock_mismatches(held: DataFrame, now: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, mismatches`` (V9): fields in which a run that is to go on differs from what it began with; none: it may."""
    then = now.select(F.col(key).alias("_k"), *[F.col(f).alias(f"_{f}") for f in fields])
    differs = F.filter(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return held.join(then, F.col(key) == F.col("_k")).select(key, differs.alias("mismatches"))


def quarantine_gate(rows: DataFrame, kind: str, expected: dict[str, int]) -> DataFrame:
    """``kind, n, expected, ok`` (V10): every class has just the rows it must have, and there is no other."""
    wanted = rows.sparkSession.createDataFrame(list(expected.items()), f"{kind} string, expected long")
    n = rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
    told = n.join(wanted, kind, "full_outer").select(kind, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("expected", F.lit(0)).alias("expected"))
    return told.withColumn("ok", F.col("n") == F.col("expected"))


def promotion_leaks(rows: DataFrame, key: str, state: str, forbidden: list[str] = ("lexical_identity_id", "identity_id", "canonical")) -> DataFrame:
    """Quarantined rows that look promoted (R23): an approved state; a column of a minted identity fails at once."""
    named = sorted(set(forbidden) & {c.lower() for c in rows.columns})
    if named:
        raise ValueError(f"columns of an identity in quarantine: {', '.join(named)}")
    return rows.where(F.coalesce(F.col(state).startswith("approved"), F.lit(False))).select(key, state)


def provenance_problems(groups: dict[str, list[str]], status: str, known: list[str], text: str, digest: str):
    """Problems of a run record (R21): missing fields, an unknown status, a hash that is not its text's."""
    from .records import missing_fields

    gaps = F.transform(missing_fields(groups), lambda p: F.concat(F.lit("missing "), p))
    more = F.filter(F.array(F.when(F.col(status).isNotNull() & ~F.col(status).isin(known), F.lit("bad status")), F.when(F.col(digest).isNotNull() & (F.sha2(F.coalesce(F.col(text), F.lit("")), 256) != F.col(digest)), F.lit("hash mismatch"))), lambda x: x.isNotNull())
    return F.concat(gaps, more)
