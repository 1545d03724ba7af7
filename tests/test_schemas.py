import json

import pytest
from pyspark.sql import functions as F

from lexloom.operators import artifacts, schemas


def first(spark, schema, *values):
    rows = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=False)) for i, v in enumerate(values)], "i int, v string")
    got = rows.select("i", schemas.violation(F.parse_json("v"), schema).alias("x")).orderBy("i").collect()
    return [r.x and f"{r.x.path} {r.x.rule}" for r in got]


def test_types(spark):
    values = [None, True, 1, 1.0, 1.5, "x", [], {}, [1], {"a": 1}, 12345678901234567890123]
    want = {
        "null": [0],
        "boolean": [1],
        "integer": [2, 3, 10],
        "number": [2, 3, 4, 10],
        "string": [5],
        "array": [6, 8],
        "object": [7, 9],
    }
    for kind, fine in want.items():
        assert [i for i, x in enumerate(first(spark, {"type": kind}, *values)) if x is None] == fine, kind
    assert first(spark, {"type": ["string", "null"]}, None, "x", 1) == [None, None, "$ type"]
    assert first(spark, {"type": "STRING", "nullable": True}, None, "x", 1) == [None, None, "$ type"]


def test_enums_are_of_the_same_type(spark):
    assert first(spark, {"enum": ["a", 1, True, None, [1, "x"]]}, "a", 1, 1.0, True, None, [1, "x"], "1", False, "true", "null", 2, [1]) == [None] * 6 + ["$ enum"] * 6
    assert first(spark, {"const": "a"}, "a", "b") == [None, "$ const"]


def test_order_and_paths(spark):
    schema = {
        "type": "object",
        "additionalProperties": False,
        "required": ["b", "a"],
        "properties": {"a": {"type": "array", "minItems": 1, "items": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer", "minimum": 1, "maximum": 3}}}}, "b": {"type": ["string", "null"], "maxLength": 2}, "c d": {"type": "object", "additionalProperties": {"type": "string"}}},
    }
    told = first(
        spark,
        schema,
        {"a": [{"x": 1}], "b": None},
        {"a": [{"x": 1}]},
        {"b": "x"},
        {},
        {"a": [], "b": "xyz", "zz": 1, "aa": 2},
        {"a": [], "b": "xyz"},
        {"a": [{"x": 1}, {"x": 4}, {"x": 0}], "b": "xyz"},
        {"a": [{"x": 1}, {}], "b": ""},
        {"a": [{"x": 1}, 5], "b": ""},
        {"a": [{"x": 1}], "b": "xyz"},
        {"a": [{"x": 1}], "b": "éé", "c d": {"q": "x", "r": 1}},
        [],
    )
    assert told == [None, "$.b required", "$.a required", "$.b required", "$.aa additionalProperties", "$.a minItems", "$.a[1].x maximum", "$.a[1].x required", "$.a[1] type", "$.b maxLength", "$['c d'].r type", "$ type"]


def test_bounds_concern_their_types_only(spark):
    assert first(spark, {"minimum": 2, "exclusiveMaximum": 5, "multipleOf": 2}, 1, 2, 3, 4, 5, 6, "x", None) == ["$ minimum", None, "$ multipleOf", None, "$ exclusiveMaximum", "$ exclusiveMaximum", None, None]
    assert first(spark, {"minLength": 2, "pattern": "^a+$"}, "a", "aa", "ab", 5) == ["$ minLength", None, "$ pattern", None]
    assert first(spark, {"uniqueItems": True, "maxItems": 2}, [1, 1], [1, 2], [1, 2, 3], "x") == ["$ uniqueItems", None, "$ maxItems", None]
    assert first(spark, {"minProperties": 1, "maxProperties": 1}, {}, {"a": 1}, {"a": 1, "b": 2}) == ["$ minProperties", None, "$ maxProperties"]


def test_combinations_and_references(spark):
    schema = {"definitions": {"n": {"type": "integer"}}, "type": "object", "properties": {"a": {"anyOf": [{"$ref": "#/definitions/n"}, {"type": "null"}]}, "o": {"oneOf": [{"minimum": 1}, {"maximum": 3}]}, "x": {"not": {"$ref": "#/definitions/n"}}, "l": {"allOf": [{"minItems": 1}, {"items": {"$ref": "#/definitions/n"}}]}}}
    assert first(spark, schema, {"a": 1, "o": 5, "x": "s", "l": [1]}, {"a": "s"}, {"o": 2}, {"x": 3}, {"l": []}, {"l": [1, "x"]}) == [None, "$.a anyOf", "$.o oneOf", "$.x not", "$.l minItems", "$.l[1] type"]


def test_what_is_not_known_is_refused(spark):
    for schema in ({"dependentRequired": {}}, {"items": [{}]}, {"type": "thing"}, {"$ref": "http://x"}, {"properties": {"a'b": {"type": "null"}}}, {"definitions": {"r": {"properties": {"r": {"$ref": "#/definitions/r"}}}}, "$ref": "#/definitions/r"}):
        with pytest.raises(ValueError):
            schemas.violation(F.parse_json(F.lit("1")), schema)
    assert first(spark, {"description": "anything", "format": "date"}, 1, None) == [None, None]
    assert first(spark, {}, 1) == [None]


def test_null_and_broken_texts_break_nothing_themselves(spark):
    rows = spark.createDataFrame([(None,), ("{",)], "v string")
    assert [r[0] for r in rows.select(schemas.violation(F.try_parse_json("v"), {"type": "object"})).collect()] == [None, None]


SCHEMA = {"type": "object", "required": ["definition_en"], "properties": {"definition_en": {"type": "string"}}}


def artifact(**changes):
    import hashlib

    output = {"definition_en": "to say no", "explanation_ar": "يرفض", "examples": [{"example_text": t} for t in ("I refuse it.", "We refuse.", "They REFUSE!")], "mnemonic_ar": None} | changes.pop("output", {})
    digest = hashlib.sha256(json.dumps(output, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    base = {"candidate_id": "C1", "experiment_id": "E", "lexical_entry": {"lexical_id": 1, "lemma": "refuse", "pos": "verb", "cefr": "A2"}, "output": output, "runtime": {"status": "success"}, "provenance": {"output_hash": digest, "golden_set_hash": "g", "schema_version": "v"}}
    return json.dumps(base | changes, ensure_ascii=False)


CASES = [
    (artifact(), "PASS", [], [], 10),
    (None, "ERROR", ["INVALID_STRUCTURE"], [], 1),
    ("[]", "ERROR", ["INVALID_STRUCTURE"], [], 1),
    (artifact(candidate_id=5), "ERROR", ["INVALID_STRUCTURE"], [], 1),
    (artifact(experiment_id="F"), "ERROR", ["INVALID_STRUCTURE"], [], 1),
    (artifact(provenance={"output_hash": "x"}), "ERROR", ["INVALID_STRUCTURE"], [], 1),
    (artifact(runtime={"status": "failed"}), "ERROR", ["RUNTIME_FAILED"], [], 2),
    (artifact(output={"definition_en": 5}), "ERROR", ["SCHEMA_VIOLATION"], [], 4),
    (artifact(output={"definition_en": " ", "mnemonic_ar": " N/A "}), "ERROR", ["INVALID_DEFINITION", "MNEMONIC_GENERIC_NULL"], ["POS_HEURISTIC_SUSPICION"], 10),
    (artifact(output={"mnemonic_ar": 5, "explanation_ar": ""}), "ERROR", ["INVALID_EXPLANATION", "MNEMONIC_INVALID_TYPE"], [], 10),
    (artifact(output={"examples": [{"example_text": "refused"}]}), "ERROR", ["WRONG_EXAMPLE_COUNT", "TARGET_WORD_MISSING"], [], 10),
    (artifact(output={"definition_en": "To refuse"}), "FLAG", [], ["CIRCULAR_DEFINITION"], 10),
    (artifact(output={"definition_en": "a \"no\" \\ \n\t/ é"}, provenance={"output_hash": "0", "golden_set_hash": "g", "schema_version": "v"}), "ERROR", ["HASH_MISMATCH"], ["POS_HEURISTIC_SUSPICION"], 10),
    (artifact(output={"definition_en": "a \"no\" \\ \n\t/ \x01 é"}), "FLAG", [], ["POS_HEURISTIC_SUSPICION"], 10),
] + [(json.dumps({k: v for k, v in json.loads(artifact()).items() if k != "output"} | more), "ERROR", ["MISSING_OUTPUT"], [], 3) for more in ({}, {"output": None})]


def test_artifact_reports(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, raw string")
    told = artifacts.artifact_reports(rows, "raw", "E", SCHEMA).orderBy("i").collect()
    for (raw, *want), r in zip(CASES, told, strict=True):
        assert [r.report.status, r.report.codes, r.report.flags, len(r.report.checks)] == want, raw
    assert [r.report.violation and r.report.violation.path for r in told if "SCHEMA_VIOLATION" in r.report.codes] == ["$.definition_en"]
