"""Contracts on cases with a known outcome."""

import json

import pytest
from pyspark.sql import functions as F

from lexloom.operators import artifacts

WORDS = "id long, lemma string, pos string, cefr_level string, ai_confidence double, category string, phonetic_us string, phonetic_uk string, phonetic_ar string, senses array<struct<sense_no:int,definition_en:string,definition_ar:string,short_def_en:string,register:string,primary_sense:string,mnemonic_ar:string,semantic_tags:array<string>,is_primary:boolean>>"
SENSE = {"sense_no": 1, "definition_en": "d", "definition_ar": "ت", "short_def_en": "s", "register": "Formal", "primary_sense": "Object", "mnemonic_ar": None, "semantic_tags": ["#a", "#b", "#c"], "is_primary": True}
WORD = {"id": 1, "lemma": "sun", "pos": "noun", "cefr_level": "A1", "ai_confidence": 0.9, "category": "Food & Drink", "phonetic_us": "sʌn", "phonetic_uk": None, "phonetic_ar": "سن", "senses": [SENSE]}


def issues(spark, *words, expected=((1, "sun", "noun", "A1"),)):
    df = spark.createDataFrame([json.loads(json.dumps(w)) for w in words], WORDS)
    sent = spark.createDataFrame(list(expected), "id long, lemma string, pos string, cefr_level string")
    return sorted((r.id, r.code) for r in artifacts.response_issues(df, sent).collect())


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({}, None), ({"lemma": "moon"}, "LEMMA"), ({"pos": None}, "POS"), ({"cefr_level": "B1"}, "CEFR"), ({"ai_confidence": None}, "CONFIDENCE"), ({"ai_confidence": 1.5}, "CONFIDENCE"), ({"category": None}, "CATEGORY"), ({"phonetic_us": ""}, "US_MISSING"),
        ({"phonetic_us": "/x/"}, "US_SLASHES"), ({"phonetic_uk": "/x/"}, "UK_SLASHES"), ({"phonetic_ar": None}, "AR_MISSING"), ({"senses": []}, "NO_SENSES"), ({"senses": [SENSE, SENSE]}, "PRIMARY_COUNT"), ({"senses": [SENSE | {"register": None}]}, "sense 1: REGISTER"),
        ({"senses": [SENSE | {"register": "formal"}]}, "sense 1: REGISTER"), ({"senses": [SENSE | {"primary_sense": "Thing"}]}, "sense 1: PRIMARY_SENSE"), ({"senses": [SENSE, SENSE | {"is_primary": False, "mnemonic_ar": "a (b)"}]}, "sense 2: BRACKETS"),
        ({"senses": [SENSE | {"semantic_tags": ["#a"]}]}, "sense 1: TAG_COUNT"), ({"senses": [SENSE | {"semantic_tags": None}]}, "sense 1: NO_TAGS"), ({"senses": [SENSE | {"semantic_tags": ["#a", "b", "#c"]}]}, "sense 1: TAG_FORMAT"), ({"senses": [SENSE | {"short_def_en": ""}]}, "sense 1: SHORT_DEF_EN"),
    ],
)
def test_a_batch_answer(spark, change, code):
    assert issues(spark, WORD | change) == ([(1, code)] if code else [])


def test_senses_may_hold_no_transliteration(spark):
    words = spark.createDataFrame([json.loads(json.dumps(WORD | {"senses": [SENSE, SENSE | {"is_primary": False, "translit": "x"}]}))], WORDS.replace("is_primary:boolean", "is_primary:boolean,translit:string"))
    sent = spark.createDataFrame([(1, "sun", "noun", "A1")], "id long, lemma string, pos string, cefr_level string")
    assert [r.code for r in artifacts.response_issues(words, sent).collect()] == ["sense 2: TRANSLIT"]


def test_words_that_were_not_sent_or_did_not_come_back(spark):
    assert issues(spark, WORD | {"id": 2}) == [(1, "MISSING_ID"), (2, "EXTRA_ID")]
    df = spark.createDataFrame([(1,), (2,)], "id int")
    assert [tuple(r) for r in artifacts.count_issue(df, df.limit(1)).collect()] == [(2, 1)] and artifacts.count_issue(df, df).count() == 0


CANDIDATE = {"lemma": "Sun", "pos": "noun", "cefr": "a1", "definition_en": "a star", "explanation_ar": "نجم", "senses": [], "examples": [{"example_text": "The sun."}, {"example_text": "My sun!"}, {"example_text": "Sun."}], "translations": "شمس", "relations": {"synonyms": ["star"]}, "mnemonic": None, "phonetic_us": "x", "phonetic_uk": None, "syllables": "sun", "semantic_tags": [], "ai_confidence": 1}


@pytest.mark.parametrize(
    ("change", "failed"),
    [
        ({}, []), ({"mnemonic": "none"}, ["mnemonic_null_or_useful"]), ({"pos": "verb"}, ["identity_pos"]), ({"senses": None}, ["senses"]), ({"examples": ["The sun.", "My sun!", "Sun."]}, []), ({"examples": ["The suns.", "My sun!", "Sun."]}, ["examples_contain_target"]),
        ({"examples": []}, ["examples_count"]), ({"translations": {"en": "x", "arabic_ar": "شمس"}}, []), ({"translations": {}}, ["translations_nonempty"]), ({"translations": ["", "شمس"]}, []), ({"relations": {}, "antonyms": "moon"}, []), ({"relations": []}, ["relations_some_content"]),
        ({"definition_en": "to sun"}, ["definition_not_circular"]), ({"definition_en": ""}, ["definition_nonempty"]), ({"explanation_ar": "(x"}, ["explanation_not_generic"]), ({"ai_confidence": "high"}, ["ai_confidence_numeric"]),
    ],
)
def test_a_seeded_candidate(spark, change, failed):
    text = json.dumps(CANDIDATE | change, ensure_ascii=False)
    line = json.dumps({"key": "sun/noun", "response": {"candidates": [{"content": {"parts": [{"text": f"```json\n{text}\n```"}]}}]}})
    lines = spark.createDataFrame([(line,)], "line string")
    sent = spark.createDataFrame([("sun/noun", "sun", "noun", "A1")], "key string, lemma string, pos string, cefr string")
    got = artifacts.import_candidates(lines, sent, "line").first()
    assert (got.key, got.error, got.failed, got.artifact_pass) == ("sun/noun", None, failed, not failed)


def test_a_missing_field_is_told_from_a_null_one(spark):
    text = json.dumps({k: v for k, v in CANDIDATE.items() if k not in ("syllables", "phonetic_uk")})
    df = spark.createDataFrame([(text,)], "t string").select("t", artifacts.candidate_cursor(F.col("t")).alias("c"))
    got = df.select(artifacts.failed(artifacts.candidate_checks(F.col("t"), F.col("c"), F.lit("sun"), F.lit("noun"), F.lit("A1"))).alias("x")).first().x
    assert got == ["phonetic_uk", "syllables"]


@pytest.mark.parametrize(
    ("envelope", "output", "status", "codes"),
    [
        ({}, {}, "PASS", []), ({"experiment_id": "E2"}, {}, "ERROR", ["INVALID_STRUCTURE"]), ({"status": "failed"}, {}, "ERROR", ["RUNTIME_FAILED"]), ({}, None, "ERROR", ["MISSING_OUTPUT"]), ({"computed_hash": "x"}, {"schema_ok": False}, "ERROR", ["HASH_MISMATCH", "SCHEMA_VIOLATION"]),
        ({"computed_hash": "x"}, {"examples": ["sun"]}, "ERROR", ["HASH_MISMATCH", "WRONG_EXAMPLE_COUNT"]), ({}, {"mnemonic_ar": " "}, "ERROR", ["MNEMONIC_EMPTY"]), ({}, {"mnemonic_ar": "لا توجد وسيلة"}, "ERROR", ["MNEMONIC_GENERIC_NULL"]), ({}, {"definition_en": "the sun"}, "FLAG", ["CIRCULAR_DEFINITION"]),
        ({}, {"definition_en": "to shine"}, "FLAG", ["POS_HEURISTIC_SUSPICION"]), ({}, {"explanation_ar": None}, "ERROR", ["INVALID_EXPLANATION"]),
    ],
)
def test_an_artifact(spark, envelope, output, status, codes):
    a = {"candidate_id": "C", "experiment_id": "E1", "lexical_id": "1", "lemma": "sun", "pos": "noun", "cefr": "A1", "status": "success", "output_hash": "h", "golden_set_hash": "g", "schema_version": "1", "computed_hash": "h"} | envelope
    o = None if output is None else {"definition_en": "a star", "explanation_ar": "نجم", "examples": ["sun", "The sun.", "sun!"], "mnemonic_ar": None, "schema_ok": True} | output
    schema = "a struct<" + ",".join(f"{k}:string" for k in a) + ">, o struct<definition_en:string,explanation_ar:string,examples:array<string>,mnemonic_ar:string,schema_ok:boolean>"
    got = spark.createDataFrame([(a, o)], schema).select(artifacts.artifact_result(F.col("a"), F.col("o"), "E1", F.col("a.lemma"), F.col("a.pos")).alias("r")).first().r
    assert (got.status, [*got.errors, *got.flags]) == (status, codes)


def test_a_missing_closed_value_is_an_error_in_a_batch_but_not_to_a_machine(spark):
    sense = SENSE | {"register": None}
    assert issues(spark, WORD | {"senses": [sense]}) == [(1, "sense 1: REGISTER")]
    of = lambda word: spark.createDataFrame([(json.dumps(word),)], "t string").select(artifacts.machine_evaluation(F.col("t"), F.lit("sun"), F.lit("noun"), F.lit("m"), F.lit(None).cast("string")).alias("e")).first().e
    told = of(WORD | {"senses": [sense]})
    assert (told.result, told.structural, told.loss, told.removals, told.additions) == ("pass", 1.0, 1.0, ["mnemonic_ar"], ["phonetic_uk"])
    assert of(WORD | {"senses": [SENSE | {"register": "odd"}]}).result == "invalid_enum" and of(WORD | {"lemma": "moon"}).result == "wrong_word"
