import json

from pyspark.sql import functions as F

from lexloom.operators import preservation

DEFINITION = "to say no to something you do not want to do"
EXAMPLES = ["I refuse to go outside.", "We refuse to pay the fine.", "They refuse to stay quiet."]


def reports(spark, cases, word="refuse"):
    texts = [(i, *[None if x is None else json.dumps(x, ensure_ascii=False) for x in case], word) for i, case in enumerate(cases)]
    rows = spark.createDataFrame(texts, "i int, s string, c string, d string, w string")
    told = preservation.preserved_fields(rows, "s", "c", "d", "w").withColumn("report", preservation.field_report(F.col("fields")))
    return told.orderBy("i").collect()


CASES = [
    ("definition_en", DEFINITION, DEFINITION, {"action": "preserve"}, "preserved"),
    ("definition_en", DEFINITION, "  To SAY no to something you do not want to do", {}, "preserved"),
    ("definition_en", DEFINITION, DEFINITION, {"action": "replace", "reason": "a better tone"}, "redundant_replace"),
    ("mnemonic", None, "hard R like someone", {"action": "improve", "reason": ""}, "fill"),
    ("mnemonic", None, None, {"action": "null"}, "remain_null"),
    ("mnemonic", None, "   ", {"action": "null"}, "remain_null"),
    ("translations", "", "يرفض", {"action": "improve"}, "fill"),
    ("translations", "", "", {"action": "null"}, "remain_null"),
    ("definition_en", DEFINITION, "to decline firmly", {"action": "improve", "reason": "cleaner phrasing", "replacement_superiority": True}, "changed"),
    ("definition_en", DEFINITION, "to decline firmly", {"action": "improve/replace", "reason": "cleaner phrasing", "replacement_superiority": True}, "changed"),
    ("definition_en", DEFINITION, "to decline firmly", {"action": "improve", "reason": "cleaner phrasing"}, "unjustified_change"),
    ("definition_en", DEFINITION, "to decline firmly", {"action": "improve", "reason": "cleaner phrasing", "replacement_superiority": "true"}, "unjustified_change"),
    ("definition_en", DEFINITION, "to decline firmly", {"action": "improve"}, "unjustified_change"),
    ("definition_en", DEFINITION, "to decline firmly", {}, "unjustified_change"),
    ("definition_en", DEFINITION, "to decline firmly", {"action": "preserve"}, "field_decision_conflict"),
    ("mnemonic", "a decent hook", None, {"action": "null", "legacy_defect": True, "evidence": "the hook claims bucket comes from Arabic", "legacy_state": "non_null"}, "justified_nullification"),
    ("mnemonic", "a decent hook", None, {"action": "null", "legacy_state": "Non-Null "}, "unjustified_nullification"),
    *[("mnemonic", "a decent hook", None, {"action": "null", "legacy_defect": True, "evidence": e}, "unjustified_nullification") for e in ("the mnemonic is not ideal", "I cannot improve it", "I prefer NULL", "cleaner", "")],
    ("mnemonic", "a decent hook", None, {}, "unjustified_nullification"),
    ("mnemonic", "a decent hook", None, {"action": "null", "legacy_defect": True, "evidence": "concrete defect named here", "legacy_state": "NULL"}, "field_decision_conflict"),
    ("mnemonic", None, None, {"action": "null", "legacy_state": "non-null"}, "field_decision_conflict"),
    ("mnemonic", "a decent hook", "another hook", {"action": "null", "legacy_state": "non_null"}, "field_decision_conflict"),
    ("definition_en", DEFINITION, None, {"action": "improve", "reason": "rewritten"}, "unjustified_nullification"),
    ("examples", EXAMPLES, ["wrong"], {"action": "improve", "reason": "new ones"}, "regression"),
    ("mnemonic", "لا يوجد", "think of 'no' in French", {"action": "improve", "reason": "generic"}, "repair"),
    ("examples", {str(i): e for i, e in enumerate(EXAMPLES)}, EXAMPLES, {"action": "preserve"}, "preserved"),
    ("examples", {"z": EXAMPLES[0], "a": EXAMPLES[1], "10": EXAMPLES[2]}, EXAMPLES, {}, "preserved"),
    ("examples", EXAMPLES, [{"example_text": EXAMPLES[0]}, {"text": EXAMPLES[1]}, EXAMPLES[2]], {}, "preserved"),
    ("examples", EXAMPLES, EXAMPLES[::-1], {}, "unjustified_change"),
    ("synonyms", ["a", "b"], ["b", "a"], {}, "unjustified_change"),
    ("synonyms", "a", ["a"], {}, "preserved"),
    ("synonyms", ["a", None], ["a"], {}, "unjustified_change"),
    ("synonyms", [5], ["5"], {}, "unjustified_change"),
    ("antonyms", [5], [5], {}, "preserved"),
    ("collocations", [" "], ["x"], {}, "fill"),
    ("definition_en", 5, "to decline", {}, "fill"),
    ("definition_en", "to refuse", "a refuse", {}, "changed_defective"),
]
def test_classes(spark):
    told = reports(spark, [({f: old}, {f: new}, {f: say} if say else None) for f, old, new, say, _ in CASES])
    got = [next(x.category for x in r.fields if x.field == case[0]) for r, case in zip(told, CASES, strict=True)]
    for case, category in zip(CASES, got, strict=True):
        assert category == case[-1], case


SEED = {"definition_en": DEFINITION, "explanation_ar": "يرفض", "examples": EXAMPLES, "translations": "يرفض", "synonyms": ["decline", "reject"], "antonyms": ["accept"], "collocations": [], "mnemonic": "لا يوجد"}


def test_pools_and_rates(spark):
    hook = {"mnemonic_ar": "Say it like a firm no: ref-use"}
    mixed = SEED | {"examples": ["only one refuse here"], "synonyms": ["decline"], "mnemonic": "firm refusal hook"}
    decisions = {
        "definition_en": {"action": "preserve", "legacy_state": "non_null", "legacy_defect": False},
        "explanation_ar": {"action": "improve", "reason": "clearer phrasing", "legacy_state": "non_null", "replacement_superiority": True},
        "mnemonic": {"action": "null", "reason": "removed", "legacy_state": "non_null", "legacy_defect": True, "evidence": "the hook asserts a false etymology"},
    }
    fine, worse, both, none = reports(
        spark,
        [
            (SEED, SEED | hook, {"mnemonic": {"action": "improve", "reason": "generic placeholder"}}),
            (SEED, SEED | hook | {"definition_en": None}, None),
            (mixed, mixed | {"explanation_ar": "يرفض بصيغة أوضح", "examples": EXAMPLES, "mnemonic": None}, decisions),
            (None, [1], "x"),
        ],
    )
    assert (fine.report.legacy_valid_pool, fine.report.legacy_defective_pool, fine.report.preservation_precision, fine.report.repair_recall) == (6, 1, 1.0, 1.0)
    assert (worse.report.preservation_precision, worse.report.regression_rate, worse.report.counts.unjustified_nullification) == (5 / 6, 1 / 6, 1)
    kinds = {x.field: (x.category, x.source) for x in both.fields}
    assert kinds["explanation_ar"] == ("changed", "llm_changed") and kinds["mnemonic"] == ("justified_nullification", "null") and kinds["examples"] == ("repair", "deterministic_repair")
    r = both.report
    assert (r.legacy_valid_pool, r.legacy_defective_pool, r.preservation_precision, r.repair_recall, r.justified_change_rate, r.unjustified_change_rate, r.nullification_rate, r.regression_rate) == (6, 1, 4 / 6, 1.0, 2 / 6, 0.0, 1 / 6, 0.0)
    assert {x.category for x in none.fields} == {"remain_null"} and none.report.preservation_precision is None


def test_decision_lines(spark):
    seed, candidate = json.dumps(SEED, ensure_ascii=False), json.dumps(SEED | {"mnemonic": "hook"}, ensure_ascii=False)
    sent = spark.createDataFrame([("a", "refuse", "verb", "A2", seed, candidate)], "key string, lemma string, pos string, cefr string, seed string, candidate string")
    line = lambda text, key="a": json.dumps({"key": key, "response": {"candidates": [{"content": {"parts": [{"text": text}]}}]}})
    lines = ["", "  ", "{", "[1]", json.dumps({"response": {}}), line("{}", "zz"), json.dumps({"key": "a", "error": "quota"}), line("nope"), line("[]"), line("{}"), line('{"mnemonic": {"action": "improve"}}'), json.dumps({"key": "a", "response": {"candidates": []}})]
    got = preservation.import_decisions(spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1), sent).collect()
    assert sorted((r.error or "", r.decisions_status or "", r.fields is not None) for r in got) == sorted(
        [("malformed_line", "", False)] * 2 + [("missing_key", "", False), ("unknown_key", "", False), ("batch_api_error", "error: batch_api_error", True)] + [("decisions_parse_failed", "error: decisions_parse_failed", True)] * 3 + [("", "missing", True), ("", "ok", True)]
    )
    assert preservation.import_decisions(spark.createDataFrame([], "line string"), sent).count() == 0
