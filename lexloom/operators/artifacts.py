"""Contracts of generated records: batch answers, artifacts and seeded candidates, with their real rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NULL_WORDS, contains_target, is_circular, norm, strip, strip_fences, tokens
from .contracts import checks, failed
from .schemas import violation

# The closed sets of a contract, and how many tags a sense has.
CATEGORIES = ["General / Common", "Social Life & Communication", "Work & Business", "Actions & Processes", "Objects & Tools", "Mind & Thinking", "Numbers, Time & Math", "Food & Drink", "Travel & Movement", "Nature & Science", "Feelings & Emotions", "Health & Senses"]
PRIMARY_SENSES = ["Action", "Process", "Movement", "State", "Condition", "Change", "Relation", "Time", "Event", "Quantity", "Measure", "Quality", "Attribute", "Emotion", "Concept", "Communication", "Object", "Tool", "Person", "Place"]
REGISTERS = ["Formal", "Neutral", "Informal", "Slang", "Technical", "Literary"]
LEAST_TAGS, MOST_TAGS = 3, 5
CONTRACT_FIELDS = ["lemma", "pos", "cefr", "definition_en", "explanation_ar", "senses", "examples", "translations", "relations", "mnemonic", "phonetic_us", "phonetic_uk", "syllables", "semantic_tags", "ai_confidence"]
MAY_BE_NULL = ["phonetic_uk", "mnemonic"]


def _codes(tests: dict[str, Column]) -> Column:
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in tests.items()]), lambda x: x.isNotNull())


def _missing(x: Column) -> Column:
    return F.coalesce(x == "", F.lit(True))


def _brackets(x: Column) -> Column:
    return F.coalesce(x.rlike(r"[()\[\]]"), F.lit(False))


def bad_tags(tags: Column) -> Column:
    """``NO_TAGS``, ``TAG_COUNT`` or ``TAG_FORMAT`` of a sense's tags."""
    return F.when(tags.isNull(), "NO_TAGS").when(~F.size(tags).between(LEAST_TAGS, MOST_TAGS), "TAG_COUNT").when(F.exists(tags, lambda t: ~F.coalesce(t.startswith("#"), F.lit(False))), "TAG_FORMAT")


def sense_issues(s: Column, registers: list[str] = REGISTERS, translit: bool = False) -> Column:
    """Codes of what a sense lacks; a missing closed value is an error here.  ``translit``: senses have that field, which must be null."""
    out = _codes(
        {
            "SENSE_NO": s["sense_no"].isNull() | (s["sense_no"] == 0),
            "DEFINITION_EN": _missing(s["definition_en"]),
            "DEFINITION_AR": _missing(s["definition_ar"]),
            "SHORT_DEF_EN": _missing(s["short_def_en"]),
            "REGISTER": ~F.coalesce(s["register"].isin(registers), F.lit(False)),
            "PRIMARY_SENSE": ~F.coalesce(s["primary_sense"].isin(PRIMARY_SENSES), F.lit(False)),
            "BRACKETS": _brackets(s["mnemonic_ar"]),
            **({"TRANSLIT": s["translit"].isNotNull()} if translit else {}),
        }
    )
    tags = bad_tags(s["semantic_tags"])
    return F.concat(out, F.when(tags.isNull(), F.array().cast("array<string>")).otherwise(F.array(tags)))


def response_issues(words: DataFrame, expected: DataFrame, key: str = "id") -> DataFrame:
    """``id, code`` of every issue of a batch answer against what was sent (C5): none means that it may be written.

    ``expected`` has the id and ``lemma, pos, cefr_level``; ``words`` the same and ``ai_confidence, category,
    phonetic_us, phonetic_uk, phonetic_ar, senses`` and, where a reader kept it, ``translit``.
    """
    sent = expected.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in ("lemma", "pos", "cefr_level")])
    both = words.join(sent, F.col(key) == F.col("_k"), "full_outer")
    here, known, c = F.col(key).isNotNull(), F.col("_k").isNotNull(), F.col
    in_senses = "translit" in words.schema["senses"].dataType.elementType.names
    per_sense = F.transform("senses", lambda s, i: F.transform(sense_issues(s, translit=in_senses), lambda code: F.concat(F.lit("sense "), (i + 1).cast("string"), F.lit(": "), code)))
    primary = F.size(F.filter("senses", lambda s: F.coalesce(s["is_primary"], F.lit(False))))
    some = F.size("senses") > 0
    own = _codes(
        {
            "LEMMA": known & ~c("lemma").eqNullSafe(c("_lemma")),
            "POS": known & ~c("pos").eqNullSafe(c("_pos")),
            "CEFR": known & ~c("cefr_level").eqNullSafe(c("_cefr_level")),
            "CONFIDENCE": ~F.coalesce(c("ai_confidence").between(0, 1), F.lit(False)),
            "CATEGORY": ~F.coalesce(c("category").isin(CATEGORIES), F.lit(False)),
            "TRANSLIT": c("translit").isNotNull() if "translit" in words.columns else F.lit(False),
            "US_MISSING": _missing(c("phonetic_us")),
            "US_SLASHES": c("phonetic_us").contains("/"),
            "UK_SLASHES": c("phonetic_uk").contains("/"),
            "AR_MISSING": _missing(c("phonetic_ar")),
            "NO_SENSES": ~F.coalesce(some, F.lit(False)),
            "PRIMARY_COUNT": some & (primary != 1),
        }
    )
    issues = F.when(~here, F.array(F.lit("MISSING_ID"))).otherwise(F.concat(F.when(~known, F.array(F.lit("EXTRA_ID"))).otherwise(F.array().cast("array<string>")), own, F.coalesce(F.flatten(per_sense), F.array().cast("array<string>"))))
    return both.select(F.coalesce(key, "_k").alias(key), F.explode(issues).alias("code"))


def count_issue(words: DataFrame, expected: DataFrame) -> DataFrame:
    """One row if the numbers of words sent and returned differ."""
    n = words.agg(F.count(F.lit(1)).alias("got")).join(F.broadcast(expected.agg(F.count(F.lit(1)).alias("sent"))))  # one row each
    return n.where("got <> sent")


def artifact_result(a: Column, output: Column, experiment: str, lemma: Column, pos: Column) -> Column:
    """``status, codes, checks`` of an artifact (C6), in order, with the early ends of the contract.

    ``a`` is the envelope: ``candidate_id, experiment_id, lexical_id, lemma, pos, cefr, status, output_hash,
    golden_set_hash, schema_version, computed_hash``; ``output`` its parsed output, null if there is none, with
    ``definition_en, explanation_ar, examples`` (texts), ``mnemonic_ar`` and ``schema_ok``.  A wrong structure,
    a failed run, a missing output or a broken schema end the checks; what comes after them adds up.  Doubts
    (circular definition, form of the definition against the part of speech) only flag.
    """
    structure = F.coalesce(
        (a["candidate_id"] != "") & (a["experiment_id"] == experiment) & a["lexical_id"].isNotNull() & a["lemma"].isNotNull() & a["pos"].isNotNull() & a["cefr"].isNotNull() & a["status"].isNotNull() & a["output_hash"].isNotNull() & a["golden_set_hash"].isNotNull() & a["schema_version"].isNotNull(),
        F.lit(False),
    )
    definition, examples, mnemonic = output["definition_en"], F.coalesce(output["examples"], F.array().cast("array<string>")), output["mnemonic_ar"]
    low = F.lower(strip(definition))
    said = F.lower(strip(mnemonic))
    hashed = ~F.coalesce(a["computed_hash"] == a["output_hash"], F.lit(False))
    errors = _codes(
        {
            "HASH_MISMATCH": hashed,
            "INVALID_DEFINITION": _missing(strip(definition)),
            "INVALID_EXPLANATION": ~_missing(strip(definition)) & _missing(strip(output["explanation_ar"])),
            "WRONG_EXAMPLE_COUNT": F.size(examples) != 3,
            "TARGET_WORD_MISSING": F.exists(examples, lambda x: ~F.coalesce(contains_target(x, lemma), F.lit(False))),
            "MNEMONIC_EMPTY": said == "",
            "MNEMONIC_GENERIC_NULL": said.isin(NULL_WORDS),
        }
    )
    to_form = low.startswith("to ")
    flags = _codes({"CIRCULAR_DEFINITION": is_circular(definition, lemma), "POS_HEURISTIC_SUSPICION": ((pos == "verb") & ~to_form) | (pos.isin("noun", "adjective") & to_form)})
    schema = F.concat(F.when(hashed, F.array(F.lit("HASH_MISMATCH"))).otherwise(F.array().cast("array<string>")), F.array(F.lit("SCHEMA_VIOLATION")))
    codes = (
        F.when(~structure, F.array(F.lit("INVALID_STRUCTURE")))
        .when(a["status"] != "success", F.array(F.lit("RUNTIME_FAILED")))
        .when(output.isNull(), F.array(F.lit("MISSING_OUTPUT")))
        .when(~F.coalesce(output["schema_ok"], F.lit(False)), schema)
        .otherwise(errors)
    )
    ended = ~structure | (a["status"] != "success") | output.isNull() | ~F.coalesce(output["schema_ok"], F.lit(False))
    doubts = F.when(ended, F.array().cast("array<string>")).otherwise(flags)
    status = F.when(F.size(codes) > 0, "ERROR").when(F.size(doubts) > 0, "FLAG").otherwise("PASS")
    return F.struct(status.alias("status"), codes.alias("errors"), doubts.alias("flags"))


def artifact_reports(rows: DataFrame, raw: str, experiment: str, schema: dict, into: str = "report") -> DataFrame:
    """``rows`` with ``into``: ``status, codes, flags, checks, violation`` of an artifact's JSON text.

    In order: the structure of its envelope, its run's status, that there is an output, the output's hash against that of
    its provenance, the output's schema, what must be in it, its examples, its mnemonic; then doubts (circular definition,
    form of the definition against the part of speech), which only flag.  A wrong structure, a failed run, a missing
    output and a broken schema end the checks, so the map ``checks`` has ``pass``, ``fail``, ``flag`` or
    ``unverified`` of those made.  ``violation`` is the path and rule of the first break of the schema.  Text that is no
    JSON, and null, are of wrong structure; what follows the first JSON value of a text is not read.  The hash is that of
    the output with sorted keys and no white space, of a text alone that of its characters; numbers are hashed as
    VARIANT writes them (1.0 as 1).
    """
    col, yes = F.col, lambda c: F.coalesce(c, F.lit(False))
    at = lambda path: F.try_variant_get("_v", path, "variant")
    kind = lambda path: F.schema_of_variant(at(path))
    text = lambda path: F.when(kind(path) == "STRING", F.try_variant_get("_v", path, "string"))
    held = [*(f"$.lexical_entry.{k}" for k in ("lexical_id", "lemma", "pos", "cefr")), *(f"$.provenance.{k}" for k in ("output_hash", "golden_set_hash", "schema_version"))]
    structure = yes(text("$.candidate_id") != "") & yes(text("$.experiment_id") == experiment) & at("$.runtime.status").isNotNull()
    for path in held:
        structure = structure & at(path).isNotNull()
    told = rows.withColumn("_v", F.try_parse_json(col(raw))).withColumns(
        {
            "_structure": structure,
            "_ran": yes(text("$.runtime.status") == "success"),
            "_there": yes(kind("$.output") != "VOID"),
            "_output": at("$.output"),
            "_promised": text("$.provenance.output_hash"),
            "_alone": text("$.output"),
            "_lemma": text("$.lexical_entry.lemma"),
            "_pos": text("$.lexical_entry.pos"),
            "_definition": text("$.output.definition_en"),
            "_explanation": text("$.output.explanation_ar"),
            "_mnemonic": F.lower(strip(text("$.output.mnemonic_ar"))),
            "_of_mnemonic": F.coalesce(kind("$.output.mnemonic_ar"), F.lit("VOID")),
            "_examples": F.transform(F.coalesce(F.try_variant_get("_v", "$.output.examples", "array<variant>"), F.array().cast("array<variant>")), lambda x: F.try_variant_get(x, "$.example_text", "string")),
        }
    )
    told = told.withColumn("_broken", F.when(col("_structure") & col("_ran") & col("_there"), violation(col("_output"), schema)))
    told = told.withColumns(
        {
            "_hashed": yes(col("_promised") == F.sha2(F.coalesce(col("_alone"), F.to_json("_output")), 256)),
            "_word": F.regexp_replace(F.lower("_lemma"), "[^a-z']", ""),
            "_low": F.lower(strip(col("_definition"))),
            "_deep": col("_structure") & col("_ran") & col("_there") & col("_broken").isNull(),
            "_circular": is_circular(col("_definition"), col("_lemma")),
        }
    )
    to_form = yes(col("_low").startswith("to "))
    doubtful = ((col("_pos") == "verb") & ~to_form) | (col("_pos").isin("noun", "adjective") & to_form)
    lacking = F.exists("_examples", lambda x: ~yes(F.array_contains(tokens(x), col("_word"))))

    def tell(name: str, made: Column, faults: dict[str, Column], bad: str = "fail", good: str = "pass") -> Column:
        fault = F.coalesce(*[F.when(yes(c), F.lit(code)) for code, c in faults.items()])
        return F.when(made, F.struct(F.lit(name).alias("check"), F.when(fault.isNull(), good).otherwise(bad).alias("status"), fault.alias("code")))

    deep, reached = col("_deep"), col("_structure") & col("_ran")
    made = F.array(
        tell("artifact_structure", F.lit(True), {"INVALID_STRUCTURE": ~col("_structure")}),
        tell("runtime_status", col("_structure"), {"RUNTIME_FAILED": ~col("_ran")}),
        tell("schema", reached & ~col("_there"), {"MISSING_OUTPUT": F.lit(True)}),
        tell("output_hash", reached & col("_there"), {"HASH_MISMATCH": ~col("_hashed")}),
        tell("schema", reached & col("_there"), {"SCHEMA_VIOLATION": col("_broken").isNotNull()}),
        tell("required_fields", deep, {"INVALID_DEFINITION": _missing(col("_low")), "INVALID_EXPLANATION": _missing(strip(col("_explanation")))}),
        tell("example_count", deep, {"WRONG_EXAMPLE_COUNT": F.size("_examples") != 3}),
        tell("target_word", deep, {"TARGET_WORD_MISSING": lacking}),
        tell("mnemonic", deep, {"MNEMONIC_INVALID_TYPE": ~col("_of_mnemonic").isin("STRING", "VOID"), "MNEMONIC_EMPTY": col("_mnemonic") == "", "MNEMONIC_GENERIC_NULL": col("_mnemonic").isin(NULL_WORDS)}),
        tell("circular_definition", deep, {"CIRCULAR_DEFINITION": col("_circular")}, "flag"),
        tell("pos_alignment", deep, {"POS_HEURISTIC_SUSPICION": doubtful}, "flag", "unverified"),
    )
    told = told.withColumn("_made", F.filter(made, lambda r: r.isNotNull()))
    codes = lambda status: F.transform(F.filter("_made", lambda x: x["status"] == status), lambda x: x["code"])
    status = F.when(F.exists("_made", lambda x: x["status"] == "fail"), "ERROR").when(F.exists("_made", lambda x: x["status"] == "flag"), "FLAG").otherwise("PASS")
    report = F.struct(status.alias("status"), codes("fail").alias("codes"), codes("flag").alias("flags"), F.map_from_entries(F.transform("_made", lambda x: F.struct(x["check"], x["status"]))).alias("checks"), col("_broken").alias("violation"))
    return told.select(*rows.columns, report.alias(into))


def validation_summary(rows: DataFrame, status: str) -> DataFrame:
    """One row: total, passed, failed, flagged."""
    return rows.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(status) == s).alias(n) for n, s in (("passed", "PASS"), ("failed", "ERROR"), ("flagged", "FLAG"))])


def candidate_cursor(raw: Column) -> Column:
    """The eight fields of a candidate in one shape (P14), from its JSON text.

    Relations may be nested or flat, a single text stands for a list; translations may be a text, a list or an
    object by language; the mnemonic may have either name.
    """
    v = F.try_parse_json(raw)
    text = lambda path: F.try_variant_get(v, path, "string")
    kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    none = F.array().cast("array<string>")

    def listed(path: str) -> Column:
        own = kind(path)
        return F.when(own.startswith("ARRAY"), F.try_variant_get(v, path, "array<string>")).when(own.startswith("OBJECT") | text(path).isNull() | (text(path) == ""), none).otherwise(F.array(text(path)))

    def relation(name: str) -> Column:
        nested = F.coalesce(listed(f"$.relations.{name}"), none)
        return F.when(F.size(nested) > 0, nested).otherwise(F.coalesce(listed(f"$.{name}"), none))

    by_key = F.coalesce(*[F.nullif(text(f"$.translations.{k}"), F.lit("")) for k in ("arabic_ar", "ar", "Arabic")], F.try_element_at(F.filter(F.map_values(F.try_variant_get(v, "$.translations", "map<string,string>")), lambda x: F.trim(x) != ""), F.lit(1)))
    translations = F.when(kind("$.translations").startswith("ARRAY"), F.array_join(F.filter(F.try_variant_get(v, "$.translations", "array<string>"), lambda x: F.trim(x) != ""), " ")).when(kind("$.translations").startswith("OBJECT"), by_key).otherwise(text("$.translations"))
    of_examples = kind("$.examples")
    examples = F.when(of_examples.startswith("ARRAY<OBJECT"), F.transform(F.try_variant_get(v, "$.examples", "array<struct<example_text:string>>"), lambda e: e["example_text"])).when(of_examples.startswith("ARRAY"), F.try_variant_get(v, "$.examples", "array<string>"))
    return F.struct(
        text("$.definition_en").alias("definition_en"),
        text("$.explanation_ar").alias("explanation_ar"),
        F.coalesce(examples, none).alias("examples"),
        F.coalesce(translations, F.lit("")).alias("translations"),
        *[relation(n).alias(n) for n in ("synonyms", "antonyms", "collocations")],
        F.coalesce(text("$.mnemonic"), text("$.mnemonic_ar")).alias("mnemonic"),
    )


def candidate_checks(raw: Column, cursor: Column, lemma: Column, pos: Column, cefr: Column) -> Column:
    """Checks of a seeded candidate (C7), in order: 15 fields of its contract, its identity, its content.

    ``raw`` is its JSON text, ``cursor`` what ``candidate_cursor`` makes of it.
    """
    keys, v = F.json_object_keys(raw), F.try_parse_json(raw)
    is_null = lambda f: F.is_variant_null(F.try_variant_get(v, f"$.{f}", "variant"))
    held = {f: F.array_contains(keys, f) & (F.lit(True) if f in MAY_BE_NULL else ~F.coalesce(is_null(f), F.lit(True))) for f in CONTRACT_FIELDS}
    same = lambda f, x: F.lower(strip(F.coalesce(F.try_variant_get(v, f"$.{f}", "string"), F.lit("")))) == F.lower(strip(F.coalesce(x, F.lit(""))))
    explanation, examples, mnemonic = norm(cursor["explanation_ar"]), cursor["examples"], norm(cursor["mnemonic"])
    number = F.schema_of_variant(F.try_variant_get(v, "$.ai_confidence", "variant"))
    definition = F.coalesce(strip(cursor["definition_en"]) != "", F.lit(False))
    return checks(
        held
        | {
            "identity_lemma": same("lemma", lemma),
            "identity_pos": same("pos", pos),
            "identity_cefr": same("cefr", cefr),
            "definition_nonempty": definition,
            "definition_not_circular": ~definition | ~is_circular(cursor["definition_en"], lemma),
            "explanation_nonempty": explanation != "",
            "explanation_not_generic": (explanation != "") & ~explanation.isin(NULL_WORDS) & ~explanation.startswith("[") & ~explanation.startswith("("),
            "examples_count": F.size(examples) == 3,
            "examples_all_nonempty": F.forall(examples, lambda x: F.coalesce(strip(x) != "", F.lit(False))),
            "examples_contain_target": F.forall(examples, lambda x: F.coalesce(contains_target(x, lemma), F.lit(False))),
            "translations_nonempty": strip(cursor["translations"]) != "",
            "relations_some_content": F.size(cursor["synonyms"]) + F.size(cursor["antonyms"]) + F.size(cursor["collocations"]) > 0,
            "mnemonic_null_or_useful": cursor["mnemonic"].isNull() | ((mnemonic != "") & ~mnemonic.isin(NULL_WORDS)),
            "ai_confidence_numeric": number.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"),
        }
    )


def write_value(field: str, raw: Column) -> Column:
    """The text that a promoted field of a candidate is written as (P15): a list of translations joined by `` / ``,
    other lists and objects as JSON, null as null."""
    v = F.try_parse_json(raw)
    path = f"$.relations.{field.removeprefix('relations_')}" if field.startswith("relations_") else f"$.{field}"
    own = F.try_variant_get(v, path, "variant")
    kind = F.schema_of_variant(own)
    plain = F.when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.to_json(own)).otherwise(F.try_variant_get(v, path, "string"))
    return F.when(kind.startswith("ARRAY"), F.array_join(F.try_variant_get(v, path, "array<string>"), " / ")).otherwise(F.try_variant_get(v, path, "string")) if field == "translations" else plain


def learner_texts(rows: DataFrame, key: str, senses: str, texts: list[str]) -> DataFrame:
    """``key, field, text`` of every text that a learner reads (Z12): definitions and examples of each sense, then ``texts``."""
    of_sense = lambda s, i: F.concat(F.array(*[F.struct(F.lit(f).alias("field"), s[f].alias("text")) for f in ("definition_en", "definition_ar")]), F.transform(s["examples"], lambda x, k: F.struct(F.concat(F.lit("examples["), k.cast("string"), F.lit("]")).alias("field"), x.alias("text"))))
    every = F.concat(F.coalesce(F.flatten(F.transform(senses, of_sense)), F.array().cast("array<struct<field:string,text:string>>")), F.array(*[F.struct(F.lit(t).alias("field"), F.col(t).alias("text")) for t in texts]))
    return rows.select(key, F.inline(every)).where("text <> ''")


def answer_class(response: Column, findings) -> Column:
    """``status, failure_class`` of a batch row (C14) from its response's JSON; ``findings(output)`` tells of defects.

    No payload is a fault of the infrastructure, never a verdict on the words; then comes what cannot be parsed,
    then what the validator finds.
    """
    text = F.try_variant_get(F.try_parse_json(response), "$.candidates[0].content.parts[0].text", "string")
    output = strip(text)
    parsed = F.try_parse_json(output)
    kind = F.when(F.coalesce(output == "", F.lit(True)), "infrastructure_empty_payload").when(parsed.isNull(), "unparseable_output").when(F.coalesce(findings(output), F.lit(False)), "validator_findings")
    return F.struct(F.when(kind.isNull(), "ok").when(kind == "validator_findings", "partial").otherwise("failed").alias("status"), kind.alias("failure_class"))


def structural_flags(rows: DataFrame, lemma: str, text: str) -> Column:
    """Words of a lemma (letters only, lower-cased) that its sentence lacks (R24): empty if it holds all."""
    words = lambda c: F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit("[A-Za-z]+"), F.lit(0)), F.lower))
    return F.array_except(words(lemma), words(text))


def import_candidates(lines: DataFrame, submitted: DataFrame, line: str) -> DataFrame:
    """Output lines of a generation batch (B6) as ``key, error, candidate, artifact_pass, failed``.

    ``submitted`` maps ``key`` to ``lemma, pos, cefr``.  ``error`` is the first of: malformed line, missing key,
    unknown key, an error of the batch, an answer that is no JSON; then nothing else is judged.
    """
    v = F.try_parse_json(F.col(line))
    told = lines.select(v.alias("_v"), F.try_variant_get(v, "$.key", "string").alias("key"))
    sent = submitted.withColumnRenamed("key", "_sent")
    told = told.join(sent, F.col("key") == F.col("_sent"), "left")
    text = F.coalesce(F.try_variant_get("_v", "$.response.candidates[0].content.parts[0].text", "string"), F.lit(""))
    told = told.withColumn("candidate", strip_fences(text)).withColumn("cursor", candidate_cursor(F.col("candidate")))
    error = F.when(F.col("_v").isNull(), "malformed line").when(F.coalesce(F.col("key") == "", F.lit(True)), "missing key").when(F.col("_sent").isNull(), "unknown key").when(F.array_contains(F.json_object_keys(F.to_json("_v")), "error"), "batch error").when(F.try_parse_json("candidate").isNull(), "parse failed")
    told = told.withColumn("error", error).withColumn("_checks", candidate_checks(F.col("candidate"), F.col("cursor"), F.col("lemma"), F.col("pos"), F.col("cefr")))
    fine = F.col("error").isNull()
    return told.select("key", "error", F.when(fine, F.col("candidate")).alias("candidate"), F.coalesce(fine & (F.size(failed(F.col("_checks"))) == 0), F.lit(False)).alias("artifact_pass"), F.when(fine, failed(F.col("_checks"))).alias("failed"))


def import_ballots(lines: DataFrame, expected: DataFrame, key: str, text: str, order: str, error: Column) -> DataFrame:
    """Ballot lines (B7) as ``key, outcome, problem, fields``: of a repeated key the last line counts.

    Lines with an error, or whose answer is no sound ballot, are rejects; keys that were not asked for are unknown.
    """
    from .contracts import parsed_ballot

    last = lines.withColumn("_error", F.coalesce(error, F.lit(False))).groupBy(key).agg(F.max_by(F.struct(text, "_error"), order).alias("_x"))
    asked = expected.select(F.col(key).alias("_asked")).distinct()
    told = last.join(asked, F.col(key) == F.col("_asked"), "full_outer").withColumn("_b", parsed_ballot(F.col(f"_x.{text}")))
    outcome = F.when(F.col("_asked").isNull(), "unknown").when(F.col("_x").isNull(), "missing").when(F.col("_x._error") | F.col("_b.problem").isNotNull(), "reject").otherwise("judgment")
    return told.select(F.coalesce(key, "_asked").alias(key), outcome.alias("outcome"), F.when(outcome == "reject", F.coalesce(F.when(F.col("_x._error"), "batch error"), F.col("_b.problem"))).alias("problem"), F.when(outcome == "judgment", F.col("_b.fields")).alias("fields"))


def machine_evaluation(raw: Column, lemma: Column, pos: Column, mnemonic: Column, uk: Column) -> Column:
    """``result`` of an answer's JSON against an earlier row (C4), and, if it passes, its four scores and what came or went.

    The first of: cannot be parsed, is no object, other word, other part of speech, no senses, a closed value that
    does not exist.  A missing closed value is no error here, other than in a batch answer.  A missing British
    transcription counts as the American one.
    """
    v = F.try_parse_json(raw)
    kind = F.schema_of_variant(v)
    text = lambda p: F.try_variant_get(v, p, "string")
    senses = F.try_variant_get(v, "$.senses", "array<struct<register:string,primary_sense:string,definition_en:string,mnemonic_ar:string>>")
    said = lambda x: F.coalesce(x != "", F.lit(False))
    held = lambda x: F.coalesce(strip(x) != "", F.lit(False))
    bad = F.exists(senses, lambda s: (said(s["register"]) & ~s["register"].isin(REGISTERS)) | (said(s["primary_sense"]) & ~s["primary_sense"].isin(PRIMARY_SENSES)))
    result = (
        F.when(kind.isNull(), "json_parse_failed")
        .when(~kind.startswith("OBJECT"), "schema_failed")
        .when(~text("$.lemma").eqNullSafe(lemma), "wrong_word")
        .when(~text("$.pos").eqNullSafe(pos), "wrong_pos")
        .when(~F.coalesce(F.size(senses) > 0, F.lit(False)), "missing_required")
        .when(bad, "invalid_enum")
        .otherwise("pass")
    )
    keys = F.json_object_keys(raw)
    number = lambda *flags: sum((F.when(f, 1.0).otherwise(0.0) for f in flags), F.lit(0.0))
    full = F.size(F.filter(senses, lambda s: F.coalesce(F.char_length(s["definition_en"]) > 5, F.lit(False))))
    had, has = (held(mnemonic), held(uk)), (F.exists(senses, lambda s: said(s["mnemonic_ar"])), held(F.when(held(text("$.phonetic_uk")), text("$.phonetic_uk")).otherwise(text("$.phonetic_us"))))
    names = ("mnemonic_ar", "phonetic_uk")
    some = lambda flags: F.filter(F.array(*[F.when(f, F.lit(n)) for n, f in flags]), lambda x: x.isNotNull())
    removals = some([(n, a & ~b) for n, a, b in zip(names, had, has, strict=True)])
    additions = F.concat(some([(n, ~a & b) for n, a, b in zip(names, had, has, strict=True)]), F.when(F.size(senses) > 1, F.array(F.concat(F.lit("senses +"), (F.size(senses) - 1).cast("string")))).otherwise(F.array().cast("array<string>")))
    kept = F.coalesce(F.try_divide(number(*[a & b for a, b in zip(had, has, strict=True)]), number(*had)), F.lit(1.0))
    fine = result == "pass"
    return F.struct(
        result.alias("result"),
        F.when(fine, number(*[F.array_contains(keys, k) for k in ("lemma", "pos", "phonetic_us", "phonetic_ar", "senses")]) / 5).alias("structural"),
        F.when(fine, number(said(text("$.phonetic_us")), said(text("$.phonetic_ar")), full > 0, full == F.size(senses)) / 4).alias("completeness"),
        F.when(fine, kept).alias("preservation"),
        F.when(fine, F.when(F.size(removals) > 0, 1.0).otherwise(0.0)).alias("loss"),
        F.when(fine, additions).alias("additions"),
        F.when(fine, removals).alias("removals"),
    )


# What an entry must hold, the levels of an example, the largest numbers of relations, the word family.
ENTRY_FIELDS = ["id", "lemma", "pos", "cefr_level", "difficulty_score", "category", "ai_confidence", "phonetic_us", "phonetic_uk", "phonetic_ar", "definition_en", "explanation_ar", "examples", "mnemonic_ar", "senses", "collocations", "synonyms", "antonyms", "related_words", "word_family", "translations"]
ENTRY_LEVELS = ["A1", "A2", "B1", "B2", "C1", "C2"]
ENTRY_BOUNDS = {"collocations": 5, "synonyms": 5, "antonyms": 3}
ENTRY_FAMILY = ["noun", "verb", "adj", "adv"]


def entry_issues(rows: DataFrame, raw: str, key: str, pos: str, level: str, into: str = "issues") -> DataFrame:
    """``rows`` with ``into``: codes of all that is structurally wrong with an entry's JSON text, in one pass.

    Against what was asked for: ``key``, part of speech and level (the latter two without regard to case); then fields,
    difficulty, category, the numbers and the one primary of its senses, the number, words and level of its examples
    (an example holds all words of its lemma, letters only), definitions and mnemonic that hold the lemma, bounds of
    relations, related words, the Arabic translation, the word family.  Codes of a list's item end with its index from 0.
    ``NO_PARSE`` alone for a text that is no JSON object.
    """
    col, yes = F.col, lambda c: F.coalesce(c, F.lit(False))
    v = F.try_parse_json(col(raw))
    at = lambda path: F.try_variant_get("_e", path, "variant")
    kind = lambda path: F.coalesce(F.schema_of_variant(at(path)), F.lit("VOID"))
    text = lambda path: F.try_variant_get("_e", path, "string")
    items = lambda path: F.coalesce(F.when(kind(path).startswith("ARRAY"), F.try_variant_get("_e", path, "array<variant>")), F.array().cast("array<variant>"))
    inner = lambda x, path, t="string": F.try_variant_get(x, path, t)
    words = lambda c: F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[A-Za-z]+"), F.lit(0)), F.lower))
    told = rows.withColumn("_e", F.when(F.schema_of_variant(v).startswith("OBJECT"), v)).withColumns(
        {
            "_lacking": F.array_except(F.array(*[F.lit(f) for f in ENTRY_FIELDS]), F.coalesce(F.map_keys(F.try_variant_get("_e", "$", "map<string,variant>")), F.array().cast("array<string>"))),
            "_lemma": F.lower(F.coalesce(text("$.lemma"), F.lit(""))),
            "_senses": items("$.senses"),
            "_examples": items("$.examples"),
        }
    )
    told = told.withColumns(
        {
            "_words": words(col("_lemma")),
            "_numbers": F.transform("_senses", lambda s: inner(s, "$.sense_no", "bigint")),
            "_primary": F.size(F.filter("_senses", lambda s: yes((F.schema_of_variant(inner(s, "$.is_primary", "variant")) == "BOOLEAN") & inner(s, "$.is_primary", "boolean")))),
            "_said": F.transform("_senses", lambda s: F.lower(F.coalesce(inner(s, "$.definition_en"), F.lit("")))),
            "_texts": F.transform("_examples", lambda x: F.struct(F.coalesce(inner(x, "$.example_text"), F.lit("")).alias("text"), inner(x, "$.intended_cefr").alias("level"))),
        }
    )
    none = F.array().cast("array<string>")
    one = lambda code, wrong: F.when(yes(wrong), F.array(code if not isinstance(code, str) else F.lit(code))).otherwise(none)
    holds = lambda c: (col("_lemma") != "") & yes(F.contains(c, col("_lemma")))
    indexed = lambda code, i: F.concat(F.lit(code + "["), i.cast("string"), F.lit("]"))
    difficulty = F.when(kind("$.difficulty_score") == "STRING", text("$.difficulty_score"))
    ordered = F.transform("_numbers", lambda n, i: yes(n == i + 1))
    example = lambda x, i: F.concat(
        F.when((F.size("_words") == 0) | (F.size(F.array_except("_words", words(x["text"]))) > 0), F.array(indexed("EXAMPLE_MISSING_LEMMA", i))).otherwise(none),
        F.when(~yes(x["level"].isin(ENTRY_LEVELS)), F.array(indexed("EXAMPLE_BAD_CEFR", i))).otherwise(none),
    )
    of_examples = F.flatten(F.transform("_texts", example))
    of_senses = F.filter(F.transform("_said", lambda s, i: F.when(holds(s), indexed("SENSE_DEF_CONTAINS_LEMMA", i))), lambda x: x.isNotNull())
    length = lambda f: F.when(kind(f"$.{f}").startswith("ARRAY"), F.size(items(f"$.{f}")))
    issues = F.concat(
        one(F.concat(F.lit("MISSING_FIELDS:"), F.array_join("_lacking", ",")), F.size("_lacking") > 0),
        one("ID_MISMATCH", ~text("$.id").eqNullSafe(col(key).cast("string"))),
        one("POS_MISMATCH", F.lower(F.trim(F.coalesce(text("$.pos"), F.lit("")))) != F.lower(F.trim(F.coalesce(col(pos), F.lit(""))))),
        one("CEFR_MISMATCH", F.upper(F.coalesce(text("$.cefr_level"), F.lit(""))) != F.upper(F.coalesce(col(level), F.lit("")))),
        one("DIFFICULTY_BAD", ~yes(difficulty.rlike("^([1-9]|10)$"))),
        one("CATEGORY_BAD", ~yes(text("$.category").isin(CATEGORIES))),
        one("NO_SENSES", F.size("_senses") == 0),
        one("SENSE_NO_NONSEQ", F.exists(ordered, lambda x: ~x)),
        one(F.concat(F.lit("PRIMARY_COUNT:"), col("_primary").cast("string")), col("_primary") != 1),
        one(F.concat(F.lit("EXAMPLES_COUNT:"), F.size("_examples").cast("string")), F.size("_examples") != 3),
        of_examples,
        one("DEFINITION_CONTAINS_LEMMA", holds(F.lower(text("$.definition_en")))),
        of_senses,
        one("MNEMONIC_CONTAINS_LEMMA", holds(F.lower(text("$.mnemonic_ar")))),
        *[one(f"{f.upper()}_BOUND", F.coalesce(length(f) > most, F.lit(True))) for f, most in ENTRY_BOUNDS.items()],
        one("RELATED_WORDS_MISSING_EN_AR", ~(kind("$.related_words.en").startswith("ARRAY") & kind("$.related_words.ar").startswith("ARRAY"))),
        one("ARABIC_TRANSLATION_EMPTY", _missing(strip(text("$.translations.arabic_ar")))),
        *[one(f"WF_MISSING_{k}", at(f"$.word_family.{k}").isNull()) for k in ENTRY_FAMILY],
    )
    return told.withColumn("_issues", F.when(col("_e").isNull(), F.array(F.lit("NO_PARSE"))).otherwise(issues)).select(*rows.columns, col("_issues").alias(into))
