"""A batch's output brought in whole or not at all: accounting first, then an artifact for every key."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits
from .batch import account, accounting


def parsed_outputs(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines with ``key, status, output, error_type, error_message`` of the envelopes that they hold.

    ``output`` is the answer's JSON as VARIANT writes it: sorted keys, no white space.  What keeps an answer from being a success, in
    order: an error of the batch, no response, no candidates, no parts, an answer that is no JSON.
    """
    v = F.try_parse_json(F.col(line))
    at = lambda path: F.try_variant_get("_v", path, "variant")
    kind = lambda path: F.schema_of_variant(at(path))
    told = lines.withColumn("_v", F.when(F.schema_of_variant(v).startswith("OBJECT"), v))
    text = F.coalesce(F.try_variant_get("_v", "$.response.candidates[0].content.parts[0].text", "string"), F.lit(""))
    part = at("$.response.candidates[0].content.parts[0]")
    error = (
        F.when(at("$.error").isNotNull(), "BatchAPIError")
        .when(at("$.response").isNull(), "UnknownShape")
        .when(~F.coalesce(kind("$.response").startswith("OBJECT"), F.lit(False)), "ParseError")
        .when(at("$.response.candidates[0]").isNull(), "NoCandidates")
        .when(part.isNull(), "MissingParts")
        .when(F.try_parse_json(text).isNull(), "JSONDecodeError")
    )
    message = F.when(F.col("error_type") == "BatchAPIError", F.coalesce(F.try_variant_get("_v", "$.error", "string"), F.to_json(at("$.error"))))
    told = told.withColumns({"key": F.try_variant_get("_v", "$.key", "string"), "error_type": error}).withColumn("_out", F.when(F.col("error_type").isNull(), F.try_parse_json(text)))
    return told.withColumns({"error_message": message, "status": F.when(F.col("error_type").isNull(), "success").otherwise("failed"), "output": F.to_json("_out"), "malformed": F.col("_v").isNull()}).drop("_v", "_out")


def artifacts(told: DataFrame, expected: DataFrame, key: str, entry: list[str], experiment: str, provenance: dict, at: Column) -> DataFrame:
    """``key, artifact, output_hash, status`` of every mapped line: one JSON document a key.

    The hash is that of the output's canonical JSON; an output that is null, false, zero, or empty has none.
    """
    own = expected.select(F.col(key).alias("_e"), F.struct(*entry).alias("_entry"))
    both = told.join(own, F.col("key") == F.col("_e"))
    empty = F.col("output").isin("null", "{}", "[]", '""', "0", "false") | F.col("output").isNull()
    digest = F.when(~empty, F.sha2("output", 256))
    known = F.to_json(F.from_json(F.lit(json.dumps(provenance)), "map<string,string>"))
    less = lambda x: F.substring(x, F.lit(2), F.length(x) - 2)
    error = F.when(F.col("error_type").isNotNull(), F.to_json(F.struct(F.col("error_type").alias("type"), F.col("error_message").alias("message"))))
    runtime = F.to_json(F.struct(F.col("status"), at.alias("generated_at"), F.lit(1).alias("attempt"), F.lit("batch").alias("execution_backend")))
    ids = F.to_json(F.struct(F.col("key").alias("candidate_id"), F.lit(experiment).alias("experiment_id"), F.col("_entry").alias("lexical_entry")), {"ignoreNullFields": "false"})
    body = F.concat(F.lit("{"), less(ids), F.lit(',"output":'), F.coalesce("output", F.lit("null")), F.lit(',"runtime":{'), less(runtime), F.lit(',"error":'), F.coalesce(error, F.lit("null")), F.lit('},"provenance":{'), less(known), F.lit("," if provenance else ""), F.lit('"output_hash":'), F.coalesce(F.concat(F.lit('"'), digest, F.lit('"')), F.lit("null")), F.lit("}}"))
    return both.select("key", body.alias("artifact"), digest.alias("output_hash"), "status")


def import_outputs(spark: SparkSession, root: str, lines: DataFrame, expected: DataFrame, key: str, entry: list[str], experiment: str, provenance: dict, order: str, line: str = "line") -> dict:
    """Both passes: count every line, then write all artifacts as one version of the store at ``root``; gives the counts.

    Unless every expected key came back exactly once and nothing else did, ``ValueError`` tells the counts and nothing
    is written.  The artifacts are in force in one step, after they were written and counted again; a crash before that
    leaves what was in force.
    """
    told = parsed_outputs(lines, line)
    counts = accounting(account(told, expected.select(F.col(key).alias("key")), "key", order, F.col("malformed"), F.col("status") == "failed"), expected.select(F.col(key).alias("key")), "key").first().asDict()
    if counts["aborts"]:
        raise ValueError("not imported: " + ", ".join(f"{n} {k}" for k, n in counts.items() if k in ("missing", "duplicate", "unknown", "malformed") and n))
    draft = commits.begin(spark, root)
    written = commits.write(draft, artifacts(told, expected, key, entry, experiment, provenance, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    n = written.count()
    if n != counts["expected"]:
        raise ValueError(f"not imported: {n} artifacts of {counts['expected']}")
    counts["version"] = commits.commit(spark, draft, kind="import", report={k: v for k, v in counts.items()})
    return counts
