"""Readers and writers of the record formats: JSON lines, prediction logs, append logs, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line``: every non-blank line of one or many text files."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.input_file_name().alias("file"), F.col("value").alias("line"))


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, line`` of all non-blank lines of many files (S11), so that order is by name, then by place.

    A file is read whole: meant for shards of a batch's output, not for one huge file.
    """
    whole = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.posexplode(F.split("value", "\n")).alias("_at", "line"))
    return whole.where(F.trim("line") != "").select("file", (F.col("_at") + 1).alias("line_no"), "line")


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a declared schema; what cannot be read is kept in ``_malformed``."""
    return spark.read.schema(f"{schema}, _malformed string").option("columnNameOfCorruptRecord", "_malformed").json(path)


def read_record_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder with one JSON document a file, with the file's name."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def predictions(lines: DataFrame, key: str, text: str, order: str, key_pattern: str = r"-(\d+)$") -> DataFrame:
    """``id, body``: of each id, the last line; the id from its key, the body from the first { to the last }.

    ``body`` is null where that is not JSON.
    """
    told = lines.select(F.regexp_extract(key, key_pattern, 1).try_cast("long").alias("id"), F.regexp_extract(text, r"(?s)\{.*\}", 0).alias("_x"), F.col(order).alias("_o"))
    last = told.where("id is not null").groupBy("id").agg(F.max_by("_x", "_o").alias("_x"))
    return last.select("id", F.when(F.try_parse_json("_x").isNotNull() & (F.col("_x") != ""), F.col("_x")).alias("body"))


def with_lineage(rows: DataFrame) -> DataFrame:
    """Rows with ``raw_json``, their canonical form (sorted keys, nulls kept), and its SHA-256."""
    body = F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
    return rows.withColumn("raw_json", body).withColumn("source_hash", F.sha2("raw_json", 256))


def append_log(rows: DataFrame, path: str, sound: Column) -> DataFrame:
    """Append the sound rows to a log; gives those that were refused."""
    rows.where(F.coalesce(sound, F.lit(False))).write.mode("append").json(path)
    return rows.where(~F.coalesce(sound, F.lit(False)))


def append_numbered(rows: DataFrame, path: str, sound: Column, order: str, key: str, tries: int = 20) -> tuple[DataFrame, DataFrame]:
    """Append the sound rows to a log with the line each has in it, 1-based (K2); gives ``key, line`` and what was refused.

    The log is a store (``operators.commits``): each append is one commit that also says how many lines there are now, so
    nothing is counted again.  A writer that finds another one's commit in its place numbers its rows anew behind it;
    two writers never give the same line.
    """
    from ..operators import commits
    from ..operators.ranking import global_position

    spark = rows.sparkSession
    placed = global_position(rows.where(F.coalesce(sound, F.lit(False))), [F.col(order), F.col(key)], "line")
    n = placed.count()
    for _ in range(tries):
        draft = commits.begin(spark, path)
        held = commits.report_at(spark, path, draft.entries).get("lines", 0)
        numbered = placed.withColumn("line", F.col("line") + held)
        numbered.write.mode("errorifexists").json(draft.path)
        try:
            commits.commit(spark, draft, kind="append", report={"lines": held + n})
            return numbered.select(key, "line"), rows.where(~F.coalesce(sound, F.lit(False)))
        except commits.Conflict:
            continue
    raise commits.Conflict(f"{tries} times another writer was first")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All lines that were appended to a numbered log; what was given up before its commit is not among them."""
    from ..operators import commits

    parts = [commits.version_path(path, e["version"]) for e in commits.entries(spark, path) if e["kind"] == "append"]
    return spark.read.schema(schema).json(parts) if parts else spark.createDataFrame([], schema)


def write_sealed(rows: DataFrame, path: str, key: str) -> str:
    """JSON lines in a folder, and beside it a file with the hash of all of them (K1); gives the hash."""
    from ..operators.records import selection_hash

    spark = rows.sparkSession
    lines = rows.select(F.to_json(F.struct(*[F.col(c) for c in rows.columns]), {"ignoreNullFields": "false"}).alias("value"))
    lines.write.mode("errorifexists").text(path)
    seal = selection_hash(spark.read.text(path), "value").first().sha256
    out_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.sha256")
    out = out_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(out_path, False)
    out.write(bytearray(seal.encode()))
    out.close()
    return seal


def card(title: Column, lines: dict[str, Column]) -> Column:
    """A Markdown card (K9): a heading and one item a line that says something."""
    said = F.filter(F.array(*[F.when(F.coalesce(x.cast("string"), F.lit("")) != "", F.concat(F.lit(f"- {name}: "), x.cast("string"))) for name, x in lines.items()]), lambda x: x.isNotNull())
    return F.concat(F.lit("## "), title, F.lit("\n"), F.array_join(said, "\n"))


def html_card(title: Column, lines: dict[str, Column]) -> Column:
    """A card as HTML (K9): a section with a heading and a list of what says something; texts cannot break out of it."""
    safe = lambda x: F.replace(F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    said = F.filter(F.array(*[F.when(F.coalesce(x.cast("string"), F.lit("")) != "", F.concat(F.lit(f"<li><b>{name}</b> "), safe(x.cast("string")), F.lit("</li>"))) for name, x in lines.items()]), lambda x: x.isNotNull())
    return F.concat(F.lit("<section><h2>"), safe(F.coalesce(title, F.lit(""))), F.lit("</h2><ul>"), F.array_join(said, ""), F.lit("</ul></section>"))


def read_template(spark: SparkSession, path: str) -> tuple[str, str]:
    """A template's text and its SHA-256 (S13), from any file system; a template is a small file."""
    import hashlib

    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        raw = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()
    return raw.decode(), hashlib.sha256(raw).hexdigest()


def remapped(value: Column, moves: dict[str, str], known: list[str], default: str) -> Column:
    """A value under its new name; a known one stays, any other becomes the default (K4)."""
    table = F.create_map(*[F.lit(x) for kv in moves.items() for x in kv])
    return F.coalesce(F.try_element_at(table, value), F.when(value.isin(known), value), F.lit(default))


def updated(table: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The table with whole columns of some rows replaced (K3), nulls included."""
    new = changes.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    told = table.join(new, F.col(key) == F.col("_k"), "left")
    return told.select(*[F.when(F.col("_k").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns])


def insert_new(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or ignore: the table, and those rows whose key it lacks (one of each)."""
    return table.unionByName(rows.dropDuplicates(keys).join(table.select(*keys), keys, "left_anti"))


def replace_children(old: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """Children of every parent in ``new`` are replaced; others stay."""
    return old.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new)


def write_version(rows: DataFrame, root: str, version: int) -> str:
    """A table version in a folder of its own; nothing is overwritten."""
    path = f"{root}/v={version:06d}"
    rows.write.mode("errorifexists").parquet(path)
    return path
