"""A guarded migration as a protocol: load, check before writing, write a version, verify, publish or take back.

A table is a folder of versions (``v=000001``, ...) and a log that names the one in force (``commits``).  Nothing is
ever overwritten: applying writes a new version, verifying reads it, publishing adds to the log, and so does taking
back, after which one can go on from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import cell_hash
from . import commits
from .migration import apply_cells, audit_rows, cells, differences, drifted, logical_hash


def load_promotions(manifest: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """``key, field, after, after_sha`` of every action to promote (M1), one row a cell.

    ``manifest`` has the key, ``actions`` (field to action), ``values`` (field to text) and ``provenance_gap``;
    records with a gap are skipped, fields without a column are not cells.  A promotion without a value fails.
    """
    column = F.try_element_at(F.create_map(*[F.lit(v) for kv in columns.items() for v in kv]), F.col("_f"))
    told = manifest.where(~F.coalesce(F.col("provenance_gap"), F.lit(False))).select(key, "values", F.explode("actions").alias("_f", "_a")).where("_a = 'promote'")
    told = told.withColumn("field", column).where("field is not null").withColumn("after", F.try_element_at("values", F.col("_f")))
    sound = F.when(F.col("after").isNull(), F.raise_error(F.concat(F.lit("promotion without value: "), F.col("_f")))).otherwise(F.col("after"))
    return told.select(key, "field", sound.alias("after")).withColumn("after_sha", cell_hash(F.col("after")))


def with_before(promotions: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Promotions with ``before``, the value of their cell now; one of an unknown row has ``known`` false."""
    fields = [c for c in table.columns if c != key]
    now = cells(table, key, fields).withColumnsRenamed({key: "_k", "field": "_f", "value": "before"})
    told = promotions.join(now, (promotions[key] == now["_k"]) & (promotions["field"] == now["_f"]), "left")
    return told.withColumn("known", F.col("_k").isNotNull()).drop("_k", "_f")


def checklist(changes: DataFrame, table: DataFrame, key: str, expected: int, protected: list[str], excluded: DataFrame | None = None, rows: int | None = None, seals: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``check, n, ok`` (M2): what must hold before anything is written; ``n`` counts what is at fault.

    The number of changes, cells changed twice, protected columns, excluded keys, cells that are unknown, have
    drifted or would not change, values without text; where given, the table's number of rows and seals: a hash that was
    promised and the one that was found, as of the manifest or the candidates, by name.
    """
    wrong = drifted(changes, table, key)
    tests = [
        changes.agg(F.abs(F.count(F.lit(1)) - expected).alias("n")).select(F.lit("count").alias("check"), "n"),
        changes.groupBy(key, "field").count().where("count > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit("twice").alias("check"), "n"),
        changes.agg(F.count_if(F.col("field").isin(protected)).alias("n")).select(F.lit("protected").alias("check"), "n"),
    ]
    if excluded is not None:
        held = changes.join(excluded.select(F.col(key).alias("_x")).distinct(), F.col(key) == F.col("_x"), "left_semi")
        tests.append(held.agg(F.count(F.lit(1)).alias("n")).select(F.lit("excluded").alias("check"), "n"))
    if rows is not None:
        tests.append(table.agg(F.abs(F.count(F.lit(1)) - rows).alias("n")).select(F.lit("rows").alias("check"), "n"))
    for name, (promised, found) in (seals or {}).items():
        tests.append(table.sparkSession.range(1).select(F.lit(name).alias("check"), F.lit(int(promised != found)).cast("long").alias("n")))
    by_reason = wrong.agg(*[F.count_if(F.col("why") == w).alias(w) for w in ("unknown cell", "drift", "null value", "no change")])
    tests.append(by_reason.select(F.explode(F.create_map(*[x for w in ("unknown cell", "drift", "null value", "no change") for x in (F.lit(w), F.col(f"`{w}`"))])).alias("check", "n")))
    out = tests[0]
    for more in tests[1:]:
        out = out.unionByName(more)
    return out.withColumn("ok", F.col("n") == 0)


def verify(before: DataFrame, after: DataFrame, changes: DataFrame, audit: DataFrame, key: str) -> DataFrame:
    """``check, n, ok`` (M4, M5): what must hold of a written version; ``n`` counts what is at fault.

    Cells that changed but should not have, that should have changed but did not, rows that came or went, audit
    rows that are missing or say something else.
    """
    cols = [key, "field", "before", "after"]
    changed = differences(before, after, key).select(*cols)
    wanted = changes.where(~F.col("before").eqNullSafe(F.col("after"))).select(*cols)
    ids = before.select(key).exceptAll(after.select(key)).unionByName(after.select(key).exceptAll(before.select(key)))
    told = audit.select(*cols, "after_sha")
    said = changes.select(*cols).withColumn("after_sha", cell_hash(F.col("after")))
    tests = {
        "unexpected change": changed.exceptAll(wanted),
        "missing change": wanted.exceptAll(changed),
        "row set": ids,
        "audit gap": said.exceptAll(told),
        "audit surplus": told.exceptAll(said),
    }
    out = None
    for name, rows in tests.items():
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n", (F.col("n") == 0).alias("ok"))
        out = one if out is None else out.unionByName(one)
    return out


def dry_run(table: DataFrame, changes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``verify`` of a migration that is applied and taken back (M6), with a proof that it was: both hashes equal."""
    from .migration import rolled_back

    after, audit = apply_cells(table, changes, key, fields), audit_rows(changes, key)
    back = logical_hash(rolled_back(after, audit, key, fields)).select(F.col("sha256").alias("_b"))
    same = logical_hash(table).join(F.broadcast(back)).select(F.lit("rollback").alias("check"), F.when(F.col("sha256") == F.col("_b"), 0).otherwise(1).cast("long").alias("n"))  # one row each
    return verify(table, after, changes, audit, key).unionByName(same.withColumn("ok", F.col("n") == 0))


def current_version(spark: SparkSession, root: str) -> int:
    """The version in force; 0 if there is none."""
    return commits.current(spark, root)


def publish(spark: SparkSession, root: str, version: int) -> None:
    """Put a written version in force, in one step."""
    commits.publish(spark, root, version)


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(commits.version_path(root, version or current_version(spark, root)))


def _failed(told: DataFrame) -> list[str]:
    return sorted(r["check"] for r in told.where("not ok").collect())  # one row a check


def execute(spark: SparkSession, root: str, changes: DataFrame, key: str, fields: list[str], expected: int, protected: list[str] = (), excluded: DataFrame | None = None, rows: int | None = None, seals: dict[str, tuple[str, str]] | None = None) -> dict:
    """The migration for real (M8): checklist, new version, audit, verification of what was written, publication.

    Fails before writing if a check fails, and before publishing if the written version is not what it should be; the
    version in force then stays, and the number of the failed one is not used again.  If another writer publishes
    meanwhile, ``commits.Conflict`` is raised and the version in force is the other's.  Then what is in force is read and
    verified again; if that fails, it is taken back.  Gives the report, which the log keeps as well.
    """
    draft = commits.begin(spark, root)
    table = read_version(spark, root, draft.parent)
    if failed := _failed(checklist(changes, table, key, expected, list(protected), excluded, rows, seals)):
        raise ValueError(f"not migrated: {', '.join(failed)}")
    after = commits.write(draft, apply_cells(table, changes, key, fields))
    audit_path = f"{root}/audit={draft.number:06d}"
    audit_rows(changes, key).withColumn("migrated_at", F.current_timestamp()).write.mode("errorifexists").parquet(audit_path)
    audit = spark.read.parquet(audit_path)
    if failed := _failed(verify(table, after, changes, audit, key)):
        raise ValueError(f"not published: {', '.join(failed)}")
    before_hash, after_hash = (logical_hash(t).first() for t in (table, after))
    report = {"version": draft.number, "parent": draft.parent, "rows": after_hash.n_rows, "changes": expected, "before": before_hash.sha256, "after": after_hash.sha256}
    commits.commit(spark, draft, report=report)
    if logical_hash(read_version(spark, root, draft.number)).first().sha256 != report["after"]:
        commits.take_back(spark, root)
        raise ValueError("taken back: what is in force is not what was verified")
    return report


def take_back(spark: SparkSession, root: str) -> int:
    """The version that the one in force was made from is in force again (M7)."""
    return commits.take_back(spark, root)


def rebuilt_by_rank(table: DataFrame, key: str, rank: str) -> DataFrame:
    """The table with its ranks as ids (K7, W5); fails if a rank is missing or repeated."""
    twice = table.groupBy(rank).count().where(F.col("count") > 1).limit(1).count()
    if twice or table.where(F.col(rank).isNull()).limit(1).count():
        raise ValueError("ranks are not unique")
    return table.withColumn(key, F.col(rank).cast(table.schema[key].dataType))


def manifest_rows(items: DataFrame, key: str, field: Column, verdict: Column, value: Column) -> DataFrame:
    """Promotion manifest (M9): each item's fields with what is done about them, and the values to promote.

    One row a key: ``actions`` and ``values`` as maps by field.
    """
    from .contracts import promotion

    told = items.select(key, field.alias("_f"), promotion(field, verdict, value).alias("_a"), value.alias("_v"))
    held = told.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_f", "_a", "_v"))).alias("_x"))
    return held.select(key, F.map_from_entries(F.transform("_x", lambda x: F.struct(x["_f"], x["_a"]))).alias("actions"), F.map_from_entries(F.filter(F.transform("_x", lambda x: F.struct(x["_f"], F.when(x["_a"] == "promote", x["_v"]))), lambda x: x["_f"].isNotNull())).alias("values"))


def manifest_records(items: DataFrame, key: str, field: Column, verdict: Column, value: Column, identities: DataFrame, provenance: DataFrame) -> DataFrame:
    """Promotion manifest with what each record is and where its fields come from (M9), one row a key.

    ``actions`` and ``values`` as in ``manifest_rows``; ``identity`` (``lemma, pos, cefr``) from ``identities``, null where
    there is none, and ``cefr_drift`` where its level is not the ``master_cefr`` that stands beside it, in any case;
    ``field_provenance`` by field and ``artifact_pass`` from ``provenance`` (``field, source, artifact_pass``), which a
    record without any row lacks: its ``provenance_gap`` is true, and ``load_promotions`` leaves it out.
    ``value_empty`` tells by field whether there is nothing to promote.  An identity that comes twice fails.
    """
    own = items.select(key, field.alias("_f"), value.alias("_v"))
    empty = own.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("_f", F.coalesce(F.trim("_v") == "", F.lit(True)).alias("e"))))).alias("value_empty"))
    once = identities.groupBy(F.col(key).alias("_i")).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct("lemma", "pos", "cefr")).alias("_id"), F.first("master_cefr").alias("_level"))
    sources = provenance.groupBy(F.col(key).alias("_p")).agg(F.map_from_entries(F.sort_array(F.collect_set(F.struct("field", "source")))).alias("field_provenance"), F.bool_and(F.coalesce("artifact_pass", F.lit(False))).alias("_pass"))
    told = manifest_rows(items, key, field, verdict, value).join(empty, key).join(once, F.col(key) == F.col("_i"), "left").join(sources, F.col(key) == F.col("_p"), "left")
    identity = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("identity not unique: "), F.col(key).cast("string")))).otherwise(F.col("_id"))
    drift = F.coalesce(F.upper("_id.cefr") != F.upper("_level"), F.lit(False))
    return told.select(key, identity.alias("identity"), F.col("_level").alias("master_cefr"), drift.alias("cefr_drift"), "actions", "values", "value_empty", F.col("_p").isNull().alias("provenance_gap"), F.coalesce("_pass", F.lit(False)).alias("artifact_pass"), "field_provenance")


def manifest_summary(records: DataFrame) -> DataFrame:
    """``what, name, n``: cards, provenance gaps, drifts of level, unknown identities, actions in all and by field (``field=action``)."""
    one = lambda what, condition: F.struct(F.lit(what).alias("what"), F.lit("").alias("name"), F.count_if(condition).alias("n"))
    totals = records.agg(F.array(one("cards", F.lit(True)), one("provenance_gap", F.col("provenance_gap")), one("cefr_drift", F.col("cefr_drift")), one("no_identity", F.col("identity").isNull())).alias("_t"))
    acts = records.select(F.explode("actions").alias("_f", "_a"))
    in_all = acts.groupBy(F.lit("action").alias("what"), F.col("_a").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    by_field = acts.groupBy(F.lit("field").alias("what"), F.concat_ws("=", "_f", "_a").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return totals.select(F.inline("_t")).unionByName(in_all).unionByName(by_field)
