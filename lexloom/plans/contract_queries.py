"""Queries over raw JSON records: artifacts against a schema, decisions about fields; their SQL parses the same texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import artifacts, preservation
from .base import cut
from .queries import _WORDS_SQL, _words, query
from .rule_queries import _NULLS, _circular_sql, _quoted, _tokens_sql

# ---- artifacts

LEVELS = ["A1", "A2", "B1", "B2", "C1", "C2"]
#: A schema in the dialect with upper-case types, for the outputs below.
OUTPUT_SCHEMA = {
    "type": "OBJECT",
    "description": "one entry",
    "additionalProperties": False,
    "required": ["definition_en", "explanation_ar", "examples"],
    "properties": {
        "ai_confidence": {"type": "NUMBER", "minimum": 0, "maximum": 1},
        "definition_en": {"type": "STRING", "maxLength": 60},
        "explanation_ar": {"type": "STRING"},
        "examples": {
            "type": "ARRAY",
            "minItems": 2,
            "maxItems": 4,
            "items": {"type": "OBJECT", "required": ["example_text"], "properties": {"example_text": {"type": "STRING"}, "level": {"type": "STRING", "enum": LEVELS}}},
        },
        "mnemonic_ar": {"description": "anything"},
        "pos": {"type": "STRING", "nullable": True, "enum": ["noun", "verb", "adj", None]},
    },
}

_PARTS_SQL = rf"""WITH p AS ({_WORDS_SQL}),
f AS (SELECT id, noun AS w, level, CASE pos WHEN 'adj' THEN 'adjective' ELSE pos END AS pos,
  CASE id % 11 WHEN 3 THEN '1.5' WHEN 4 THEN '"high"' WHEN 5 THEN NULL ELSE '0.25' END AS f1,
  CASE id % 6 WHEN 0 THEN '" "' WHEN 1 THEN '"to ' || noun || '"' WHEN 2 THEN '"to go"' WHEN 3 THEN '"' || repeat('long ', 13) || '"' ELSE '"a thing"' END AS f2,
  '[' || array_to_string(list_transform(range(CASE id % 8 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 3 END),
    lambda k: CASE WHEN k = 1 AND id % 9 = 4 THEN '{{"level":"A1"}}' WHEN k = 2 AND id % 9 = 5 THEN '{{"example_text":"' || noun || '","level":"X9"}}' WHEN k = 1 AND id % 9 = 6 THEN '{{"example_text":"no such word"}}' ELSE '{{"example_text":"A ' || noun || '/.","level":"' || level || '"}}' END), ',') || ']' AS f3,
  CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN '""' ELSE '"ش"' END AS f4,
  CASE id % 5 WHEN 0 THEN '""' WHEN 1 THEN '"N/A"' WHEN 2 THEN 'null' WHEN 3 THEN '5' ELSE '"m"' END AS f5,
  CASE id % 10 WHEN 1 THEN 'null' WHEN 2 THEN '"other"' ELSE '"noun"' END AS f6, CASE WHEN id % 15 = 8 THEN '[1]' END AS f7 FROM p),
o AS (SELECT *, '{{' || concat_ws(',', '"ai_confidence":' || f1, '"definition_en":' || f2, '"examples":' || f3, '"explanation_ar":' || f4, '"mnemonic_ar":' || f5, '"pos":' || f6, '"zz":' || f7) || '}}' AS o FROM f),
v AS (SELECT *, id % 19 = 0 OR id % 23 = 1 OR id % 29 = 2 AS broken, id % 17 = 1 AS failed, id % 13 = 2 AS missing, CASE WHEN id % 12 = 4 THEN 'other' ELSE sha256(o) END <> sha256(o) AS badhash,
  o->>'$.definition_en' AS d, o->>'$.explanation_ar' AS e, json_extract(o, '$.examples[*]') AS x, json_type(o, '$.mnemonic_ar') AS mt, o->>'$.mnemonic_ar' AS m,
  list_filter(json_keys(o), lambda k: k NOT IN ('ai_confidence', 'definition_en', 'explanation_ar', 'examples', 'mnemonic_ar', 'pos'))[1] AS strange,
  list_transform(json_extract(o, '$.examples[*]'), lambda j: CASE WHEN json_type(j) <> 'OBJECT' THEN ' type' WHEN json_type(j, '$.example_text') IS NULL THEN '.example_text required' WHEN json_type(j, '$.example_text') <> 'VARCHAR' THEN '.example_text type'
    WHEN json_type(j, '$.level') <> 'VARCHAR' THEN '.level type' WHEN (j->>'$.level') NOT IN ({_quoted(LEVELS)}) THEN '.level enum' END) AS odd FROM o),
s AS (SELECT *, list_filter(range(len(odd)), lambda k: odd[k + 1] IS NOT NULL)[1] AS first_odd FROM v),
w AS (SELECT *, CASE WHEN json_type(o, '$.definition_en') IS NULL THEN '$.definition_en required' WHEN json_type(o, '$.explanation_ar') IS NULL THEN '$.explanation_ar required' WHEN json_type(o, '$.examples') IS NULL THEN '$.examples required'
  WHEN strange IS NOT NULL THEN '$.' || strange || ' additionalProperties' WHEN json_type(o, '$.ai_confidence') NOT IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN '$.ai_confidence type' WHEN (o->>'$.ai_confidence')::DOUBLE < 0 THEN '$.ai_confidence minimum' WHEN (o->>'$.ai_confidence')::DOUBLE > 1 THEN '$.ai_confidence maximum'
  WHEN json_type(o, '$.definition_en') <> 'VARCHAR' THEN '$.definition_en type' WHEN len(d) > 60 THEN '$.definition_en maxLength' WHEN json_type(o, '$.explanation_ar') <> 'VARCHAR' THEN '$.explanation_ar type' WHEN json_type(o, '$.examples') <> 'ARRAY' THEN '$.examples type'
  WHEN len(x) < 2 THEN '$.examples minItems' WHEN len(x) > 4 THEN '$.examples maxItems' WHEN first_odd IS NOT NULL THEN '$.examples[' || first_odd || ']' || odd[first_odd + 1] WHEN json_type(o, '$.pos') NOT IN ('VARCHAR', 'NULL') THEN '$.pos type' WHEN coalesce(o->>'$.pos', 'noun') NOT IN ('noun', 'verb', 'adj') THEN '$.pos enum' END AS bad FROM s),
c AS (SELECT *, broken OR failed OR missing AS early, broken OR failed OR missing OR bad IS NOT NULL AS ended,
  CASE WHEN trim(d) = '' THEN 'INVALID_DEFINITION' WHEN coalesce(trim(e), '') = '' THEN 'INVALID_EXPLANATION' END AS c1, CASE WHEN len(x) <> 3 THEN 'WRONG_EXAMPLE_COUNT' END AS c2,
  CASE WHEN list_contains([list_contains({_tokens_sql("coalesce(j->>'$.example_text', '')")}, w) for j in x], false) THEN 'TARGET_WORD_MISSING' END AS c3,
  CASE WHEN mt NOT IN ('VARCHAR', 'NULL') THEN 'MNEMONIC_INVALID_TYPE' WHEN mt = 'VARCHAR' AND trim(m) = '' THEN 'MNEMONIC_EMPTY' WHEN mt = 'VARCHAR' AND lower(trim(m)) IN ({_NULLS}) THEN 'MNEMONIC_GENERIC_NULL' END AS c4,
  CASE WHEN {_circular_sql('d', 'w')} THEN 'CIRCULAR_DEFINITION' END AS g1, CASE WHEN (pos = 'verb' AND d NOT LIKE 'to %') OR (pos IN ('noun', 'adjective') AND d LIKE 'to %') THEN 'POS_HEURISTIC_SUSPICION' END AS g2 FROM w),
t AS (SELECT id, CASE WHEN broken THEN 'INVALID_STRUCTURE' WHEN failed THEN 'RUNTIME_FAILED' WHEN missing THEN 'MISSING_OUTPUT' WHEN bad IS NOT NULL THEN concat_ws(',', CASE WHEN badhash THEN 'HASH_MISMATCH' END, 'SCHEMA_VIOLATION') ELSE concat_ws(',', CASE WHEN badhash THEN 'HASH_MISMATCH' END, c1, c2, c3, c4) END AS codes,
  CASE WHEN ended THEN '' ELSE concat_ws(',', g1, g2) END AS flags, CASE WHEN NOT early THEN bad END AS violation,
  concat_ws(',', 'artifact_structure=' || CASE WHEN broken THEN 'fail' ELSE 'pass' END, CASE WHEN NOT ended THEN concat_ws(',', 'circular_definition=' || CASE WHEN g1 IS NULL THEN 'pass' ELSE 'flag' END, 'example_count=' || CASE WHEN c2 IS NULL THEN 'pass' ELSE 'fail' END, 'mnemonic=' || CASE WHEN c4 IS NULL THEN 'pass' ELSE 'fail' END) END,
    CASE WHEN NOT early THEN 'output_hash=' || CASE WHEN badhash THEN 'fail' ELSE 'pass' END END, CASE WHEN NOT ended THEN concat_ws(',', 'pos_alignment=' || CASE WHEN g2 IS NULL THEN 'unverified' ELSE 'flag' END, 'required_fields=' || CASE WHEN c1 IS NULL THEN 'pass' ELSE 'fail' END) END,
    CASE WHEN NOT broken THEN 'runtime_status=' || CASE WHEN failed THEN 'fail' ELSE 'pass' END END, CASE WHEN NOT broken AND NOT failed THEN 'schema=' || CASE WHEN missing OR bad IS NOT NULL THEN 'fail' ELSE 'pass' END END, CASE WHEN NOT ended THEN 'target_word=' || CASE WHEN c3 IS NULL THEN 'pass' ELSE 'fail' END END) AS checks FROM c)
SELECT id, CASE WHEN codes <> '' THEN 'ERROR' WHEN flags <> '' THEN 'FLAG' ELSE 'PASS' END AS status, codes, flags, checks, violation FROM t"""


def _quote(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _pick(index: Column, *values) -> Column:
    out = F.lit(None).cast("string")
    for k, v in reversed(list(enumerate(values))):
        out = F.when(index == k, v if isinstance(v, Column) else F.lit(v).cast("string")).otherwise(out)
    return out


def _object(parts: dict[str, Column], comma: str = ", ", colon: str = ": ") -> Column:
    """A JSON object of those parts that are there, in this order."""
    return F.concat(F.lit("{"), F.concat_ws(comma, *[F.concat(F.lit(f'"{k}"{colon}'), v) for k, v in parts.items()]), F.lit("}"))


@query(_PARTS_SQL)
def artifact_reports(spark, sf):
    i, w = F.col("id"), F.col("noun")
    pos = F.when(F.col("pos") == "adj", "adjective").otherwise(F.col("pos"))
    one = lambda k: F.when((k == 1) & (i % 9 == 4), '{"level":"A1"}').when((k == 2) & (i % 9 == 5), F.concat(F.lit('{"example_text":"'), w, F.lit('","level":"X9"}'))).when((k == 1) & (i % 9 == 6), '{"example_text":"no such word"}').otherwise(F.concat(F.lit('{"example_text":"A '), w, F.lit('/.","level":"'), F.col("level"), F.lit('"}')))
    count = F.when(i % 8 == 0, 2).when(i % 8 == 1, 1).otherwise(3)
    parts = {
        "ai_confidence": F.when(i % 11 == 3, "1.5").when(i % 11 == 4, '"high"').when(i % 11 != 5, "0.25"),
        "definition_en": F.coalesce(_pick(i % 6, '" "', _quote(F.concat(F.lit("to "), w)), '"to go"', _quote(F.lit("long " * 13))), F.lit('"a thing"')),
        "examples": F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(0), count - 1), one), ","), F.lit("]")),
        "explanation_ar": F.when(i % 7 == 1, '""').when(i % 7 != 0, '"ش"'),
        "mnemonic_ar": F.coalesce(_pick(i % 5, '""', '"N/A"', "null", "5"), F.lit('"m"')),
        "pos": F.when(i % 10 == 1, "null").when(i % 10 == 2, '"other"').otherwise('"noun"'),
        "zz": F.when(i % 15 == 8, "[1]"),
    }
    digest = F.when(i % 12 == 4, "other").otherwise(F.sha2(_object(parts, ",", ":"), 256))
    raw = _object(
        {
            "output": F.when(i % 13 == 2, "null").otherwise(_object(dict(reversed(parts.items())))),
            "candidate_id": _quote(F.when(i % 19 == 0, "").otherwise(F.concat(F.lit("C-"), i.cast("string")))),
            "experiment_id": F.lit('"E1"'),
            "lexical_entry": _object({"lexical_id": i.cast("string"), "lemma": _quote(w), "pos": _quote(pos), "cefr": _quote(F.col("level"))}),
            "runtime": _object({"status": _quote(F.when(i % 17 == 1, "failed").otherwise("success"))}),
            "provenance": _object({"output_hash": _quote(digest), "golden_set_hash": F.lit('"g"'), "schema_version": F.when(i % 23 != 1, '"v1"')}),
        }
    )
    raw = F.when(i % 29 == 2, F.concat(F.lit("{"), raw)).otherwise(raw)
    rows = artifacts.artifact_reports(_words(spark, sf).select("id", raw.alias("raw")), "raw", "E1", OUTPUT_SCHEMA, "r")
    pairs = F.array_sort(F.transform(F.map_entries("r.checks"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return rows.select("id", "r.status", F.array_join("r.codes", ",").alias("codes"), F.array_join("r.flags", ",").alias("flags"), F.array_join(pairs, ",").alias("checks"), F.concat("r.violation.path", F.lit(" "), "r.violation.rule").alias("violation"))


# ---- decisions about fields

_TEXT_OLD = ["null", '""', '"N/A"', '"to %"', '"a  Thing"', '"a thing"', "5", '"(x)"']
_LIST_OLD = ["null", "[]", '[" "]', '"one"', '["one"]', '{"b": "one", "a": "two"}', '["one", "two"]', '["none", null]']
_EXAMPLES = ["null", '["%", "The %.", "% x"]', '{"2": "%", "10": "The %.", "1": "% x"}', '[{"example_text": "%"}, {"text": "The %."}, {"example_text": "% x"}]', '["The %.", "%", "% x"]', '["%"]', '["x", "y", "z"]', '"%"']
_TEXT_NEW = ["null", '""', '"N/A"', '"to %"', '"a thing"', '"A thing "']
_LIST_NEW = ["null", "[]", '["one"]', '["one", "two"]']
_TRANSLATION_NEW = ["null", '""', '"one"', '"two / one"']
_EXAMPLES_NEW = ["null", _EXAMPLES[1], '[{"example_text": "%"}, {"example_text": "The %."}, {"example_text": "% x"}]', _EXAMPLES[4], _EXAMPLES[5], _EXAMPLES[6]]
_DECISIONS = [
    None,
    '{"action": "preserve"}',
    '{"action": "replace", "reason": "r", "replacement_superiority": true}',
    '{"action": "improve", "reason": "r"}',
    '{"action": "null", "legacy_defect": true, "evidence": "the hook claims a false origin"}',
    '{"action": "null", "legacy_defect": true, "evidence": "it is  Not Ideal at all"}',
    '{"action": "improve/replace", "reason": "r", "replacement_superiority": true, "legacy_state": " Non-null"}',
    '{"action": "preserve", "legacy_state": "NULL"}',
    '"none"',
]
_FIELDS = list(preservation.KINDS)
_OLD = {"examples": _EXAMPLES, "definition_en": _TEXT_OLD, "explanation_ar": _TEXT_OLD, "mnemonic": _TEXT_OLD}
_NEW = {"examples": _EXAMPLES_NEW, "definition_en": _TEXT_NEW, "explanation_ar": _TEXT_NEW, "mnemonic": _TEXT_NEW, "translations": _TRANSLATION_NEW}


def _index(field_no: int, what: str, n: int) -> str:
    return {"old": f"(id + {3 * field_no}) % {n}", "new": f"(id // 8 + {field_no}) % {n}", "say": f"(id + id // 9 + {field_no}) % {n}"}[what]


def _case(k: int, what: str, values: list) -> str:
    texts = "".join(f" WHEN {j} THEN {'NULL' if v is None else chr(39) + v + chr(39)}" for j, v in enumerate(values))
    return f"replace(CASE {_index(k, what, len(values))}{texts} END, '%', w)"


_values_sql = " UNION ALL ".join(
    f"SELECT id, w, {k} AS k, '{f}' AS field, '{kind}' AS kind, {_case(k, 'old', _OLD.get(f, _LIST_OLD))}::JSON AS o, {_case(k, 'new', _NEW.get(f, _LIST_NEW))}::JSON AS n, CASE WHEN l IN (3, 4, 5) THEN NULL ELSE {_case(k, 'say', _DECISIONS)}::JSON END AS d FROM p"
    for k, (f, kind) in enumerate(preservation.KINDS.items())
)
_norm_sql = lambda x: f"lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"


def _judged_sql(j: str, a: str) -> str:
    """Texts, levelled text, presence and validity of a value."""
    items = f"CASE WHEN {j} IS NULL OR json_type({j}) = 'NULL' THEN [] WHEN json_type({j}) = 'ARRAY' THEN {j}->'$[*]' WHEN json_type({j}) = 'OBJECT' THEN list_transform(json_keys({j}), lambda q: json_extract({j}, '$.\"' || q || '\"')) ELSE [{j}] END"
    own = "CASE json_type(x) WHEN 'OBJECT' THEN coalesce(nullif(x->>'$.example_text', ''), nullif(x->>'$.text', ''), '') WHEN 'NULL' THEN '(null)' ELSE x->>'$' END"
    return f"CASE WHEN json_type({j}) = 'VARCHAR' THEN {_norm_sql(f'({j}->>{chr(39)}${chr(39)})')} END AS {a}t, list_filter(list_transform({items}, lambda x: {own}), lambda s: kind <> 'examples' OR s <> '') AS {a}x"


def _valid_sql(a: str) -> str:
    some = f"len(list_filter({a}x, lambda s: trim(s) <> '')) > 0"
    return f"""CASE kind WHEN 'definition' THEN coalesce({a}t <> '' AND NOT {_circular_sql(a + 't', 'w')}, false) WHEN 'explanation' THEN coalesce({a}t <> '' AND {a}t NOT IN ({_NULLS}) AND {a}t NOT LIKE '[%' AND {a}t NOT LIKE '(%', false) WHEN 'mnemonic' THEN coalesce({a}t <> '' AND {a}t NOT IN ({_NULLS}), false)
    WHEN 'examples' THEN len({a}x) = 3 AND NOT list_contains([trim(s) <> '' AND list_contains({_tokens_sql('s')}, w) for s in {a}x], false) WHEN 'translations' THEN {some} AND list_contains([lower(trim(s)) NOT IN ({_NULLS}) for s in list_filter({a}x, lambda s: trim(s) <> '')], true) ELSE {some} END AS {a}v,
  CASE WHEN kind IN ('definition', 'explanation', 'mnemonic') THEN coalesce({a}t <> '', false) ELSE {some} END AS {a}h"""


_DECIDED_SQL = rf"""WITH p AS (SELECT id, noun AS w, id % 12 AS l FROM ({_WORDS_SQL})),
f AS ({_values_sql}),
g AS (SELECT *, {_judged_sql('o', 'o')}, {_judged_sql('n', 'n')}, d->>'$.action' AS act, coalesce((d->>'$.reason') <> '', false) AS rea, coalesce((d->'$.replacement_superiority') = 'true', false) AS sup, coalesce((d->'$.legacy_defect') = 'true', false) AS def, {_norm_sql("(d->>'$.evidence')")} AS ev, replace({_norm_sql("(d->>'$.legacy_state')")}, '-', '_') AS st FROM f),
h AS (SELECT *, {_valid_sql('o')}, {_valid_sql('n')}, coalesce(len(ev) >= {V.LEAST_REASON} AND NOT list_contains([contains(ev, s) for s in [{_quoted(V.VAGUE)}]], true), false) AS arg, coalesce(CASE WHEN kind IN ('definition', 'explanation', 'mnemonic') THEN ot = nt ELSE ox = nx END, false) AS same FROM g),
k AS (SELECT *, CASE WHEN coalesce(st = 'null' AND oh, false) OR coalesce(st = 'non_null' AND NOT oh, false) OR coalesce(act = 'null' AND nv, false) THEN 'field_decision_conflict'
  WHEN NOT oh THEN CASE WHEN nv THEN 'fill' ELSE 'remain_null' END WHEN same THEN CASE WHEN act IN ('replace', 'improve', 'improve/replace') THEN 'redundant_replace' ELSE 'preserved' END
  WHEN NOT ov THEN CASE WHEN nv THEN 'repair' ELSE 'changed_defective' END WHEN NOT nv AND NOT nh THEN CASE WHEN act = 'null' AND def AND arg THEN 'justified_nullification' ELSE 'unjustified_nullification' END
  WHEN NOT nv THEN 'regression' WHEN act IN ('replace', 'improve', 'improve/replace') AND rea AND sup THEN 'changed' WHEN act = 'preserve' THEN 'field_decision_conflict' ELSE 'unjustified_change' END AS cat FROM h),
r AS (SELECT id, string_agg(cat, ',' ORDER BY k) AS categories, string_agg(CASE WHEN cat IN ('preserved', 'redundant_replace') THEN 'legacy_preserved' WHEN cat = 'repair' THEN 'deterministic_repair' WHEN cat IN ('justified_nullification', 'unjustified_nullification', 'remain_null') THEN 'null' ELSE 'llm_changed' END, ',' ORDER BY k) AS sources,
  count(*) FILTER (oh AND ov)::INT AS valid_pool, count(*) FILTER (oh AND NOT ov)::INT AS defective_pool, count(*) FILTER (oh AND ov AND cat = 'preserved') AS kept, count(*) FILTER (oh AND NOT ov AND cat = 'repair') AS mended, count(*) FILTER (oh AND ov AND cat IN ('regression', 'unjustified_nullification')) AS lost FROM k GROUP BY id)"""


def _decisions(spark, sf):
    i, w = F.col("id"), F.col("noun")
    at = lambda k, what, n: F.expr(_index(k, what, n).replace("id // ", "id div "))
    filled = lambda k, what, values: F.replace(_pick(at(k, what, len(values)), *values), F.lit("%"), w)
    seed = _object({f: filled(k, "old", _OLD.get(f, _LIST_OLD)) for k, f in enumerate(_FIELDS)})
    candidate = _object({f: filled(k, "new", _NEW.get(f, _LIST_NEW)) for k, f in enumerate(_FIELDS)})
    said = _object({f: filled(k, "say", _DECISIONS) for k, f in enumerate(_FIELDS)})
    kind = i % 12
    text = F.when(kind == 4, "no json").when(kind == 5, " {} ").otherwise(F.concat(F.lit("\n"), said, F.lit(" ")))
    key = F.concat(F.lit("k-"), i.cast("string"))
    answer = F.struct(F.array(F.struct(F.struct(F.array(F.struct(text.alias("text"))).alias("parts")).alias("content"))).alias("candidates"))
    line = F.when(kind == 0, F.concat(F.lit("{"), key)).when(kind == 1, F.to_json(F.struct(answer.alias("response")))).when(kind == 3, F.to_json(F.struct(key.alias("key"), F.lit("quota").alias("error")))).when(kind == 6, "  ").otherwise(F.to_json(F.struct(key.alias("key"), answer.alias("response"))))
    p = _words(spark, sf)
    sent = p.where("id % 12 <> 2").select(key.alias("key"), w.alias("lemma"), "pos", F.col("level").alias("cefr"), seed.alias("seed"), candidate.alias("candidate"))
    return preservation.import_decisions(p.select(line.alias("line")), sent)


@query(_DECIDED_SQL + """ SELECT CASE WHEN l > 1 THEN 'k-' || p.id END AS key, CASE l WHEN 0 THEN 'malformed_line' WHEN 1 THEN 'missing_key' WHEN 2 THEN 'unknown_key' WHEN 3 THEN 'batch_api_error' WHEN 4 THEN 'decisions_parse_failed' END AS error,
  CASE WHEN l IN (3, 4) THEN 'error: ' || CASE l WHEN 3 THEN 'batch_api_error' ELSE 'decisions_parse_failed' END WHEN l = 5 THEN 'missing' WHEN l > 5 THEN 'ok' END AS decisions_status,
  CASE WHEN l > 2 THEN categories END AS categories, CASE WHEN l > 2 THEN sources END AS sources, CASE WHEN l > 2 THEN valid_pool END AS valid_pool, CASE WHEN l > 2 THEN defective_pool END AS defective_pool,
  CASE WHEN l > 2 THEN round(kept / nullif(valid_pool, 0), 6) END AS preservation_precision, CASE WHEN l > 2 THEN round(mended / nullif(defective_pool, 0), 6) END AS repair_recall, CASE WHEN l > 2 THEN round(lost / nullif(valid_pool, 0), 6) END AS regression_rate
FROM p JOIN r USING (id) WHERE l <> 6""")
def decision_import(spark, sf):
    told = _decisions(spark, sf)
    names = lambda k: F.array_join(F.transform("fields", lambda x: x[k]), ",").alias({"category": "categories", "source": "sources"}[k])
    rate = lambda c: F.round(f"report.{c}", 6).alias(c)
    return told.select("key", "error", "decisions_status", names("category"), names("source"), F.col("report.legacy_valid_pool").alias("valid_pool"), F.col("report.legacy_defective_pool").alias("defective_pool"), rate("preservation_precision"), rate("repair_recall"), rate("regression_rate"))


@query(_DECIDED_SQL + " SELECT field, cat AS category, count(*) AS n FROM k WHERE l_ok GROUP BY ALL".replace("l_ok", "id % 12 > 2 AND id % 12 <> 6"))
def decision_classes(spark, sf):
    told = cut(_decisions(spark, sf).where("fields IS NOT NULL").select("fields"))
    return told.select(F.inline("fields")).groupBy("field", "category").agg(F.count(F.lit(1)).alias("n"))


_FEATURES_SQL = """, q AS (SELECT id, noun, pos FROM (""" + _WORDS_SQL + """)), m AS (SELECT noun FROM q GROUP BY noun HAVING count(DISTINCT pos) > 1),
y AS (SELECT id, max(CASE WHEN field = 'mnemonic' THEN NOT oh END) AS mnemonic_null, max(CASE WHEN field = 'examples' THEN ov END) AS examples_contract, max(CASE WHEN field = 'examples' THEN len(ox) = 3 AND NOT list_contains([list_contains(TOKENS, w) for s in ox], false) END) AS examples_target_all, max(CASE WHEN field = 'examples' THEN len(ox) END)::INT AS examples_count,
  max(CASE WHEN field = 'translations' THEN regexp_matches(CASE json_type(o) WHEN 'VARCHAR' THEN o->>'$' WHEN 'NULL' THEN '' ELSE o::VARCHAR END, '[;/,]') END) AS translations_multi, sum(len(list_filter(ox, lambda s: trim(s) <> ''))) FILTER (field IN ('synonyms', 'antonyms', 'collocations'))::INT AS relations_total,
  max(CASE WHEN field = 'definition_en' THEN ov END) AS definition_valid, max(CASE WHEN field = 'definition_en' THEN CASE json_type(o) WHEN 'NULL' THEN 0 ELSE len(o->>'$') END END)::INT AS definition_len FROM h GROUP BY id)
SELECT id, noun || '/' || pos AS key, CASE WHEN pos IN ('noun', 'verb', 'adj', 'adv') THEN pos ELSE 'function' END AS pos_group, mnemonic_null, examples_contract, examples_target_all, examples_count, translations_multi, relations_total, relations_total <= 5 AS relations_poor, definition_valid, definition_len, noun IN (SELECT noun FROM m) AS multi_pos, id % 3 = 0 AS technical FROM y JOIN q USING (id)"""


@query(_DECIDED_SQL + _FEATURES_SQL.replace("TOKENS", _tokens_sql("s")))
def seed_features(spark, sf):
    i, w = F.col("id"), F.col("noun")
    at = lambda k, n: F.expr(_index(k, "old", n))
    parts = {f: F.replace(_pick(at(k, len(_OLD.get(f, _LIST_OLD))), *_OLD.get(f, _LIST_OLD)), F.lit("%"), w) for k, f in enumerate(_FIELDS)}
    seed = _object(parts | {"category": F.when(i % 3 == 0, '"Health & Senses"').otherwise('"Work & Business"')})
    rows = _words(spark, sf).select("id", w.alias("w"), "pos", seed.alias("seed"))
    return preservation.seed_features(rows, "seed", "w", "pos", ["Nature & Science", "Health & Senses"], ["؛", ";", "/", "،", ","]).drop("w", "pos", "seed")


# ---- structural flags of entries

_ENTRY_SQL = rf"""WITH p AS ({_WORDS_SQL}),
e AS (SELECT id, noun AS w, word, pos, level, id % 13 = 0 AS broken, concat_ws(',', '"id":' || CASE WHEN id % 11 = 1 THEN id + 1 ELSE id END, '"lemma":"' || noun || '"', '"pos":"' || CASE WHEN id % 7 = 1 THEN 'other' ELSE upper(pos) END || '"', '"cefr_level":"' || lower(level) || '"',
  CASE id % 5 WHEN 0 THEN '"difficulty_score":"11"' WHEN 1 THEN '"difficulty_score":7' WHEN 2 THEN NULL ELSE '"difficulty_score":"10"' END, CASE WHEN id % 4 = 0 THEN '"category":"None"' ELSE '"category":"Work & Business"' END,
  '"definition_en":"' || CASE WHEN id % 6 = 0 THEN 'the ' || upper(noun) || 's' ELSE 'a thing' END || '"', CASE id % 8 WHEN 0 THEN '"senses":[]' WHEN 1 THEN '"senses":[{{"sense_no":1,"is_primary":true,"definition_en":"x"}},{{"sense_no":3,"is_primary":true,"definition_en":"my ' || noun || '"}}]' WHEN 2 THEN NULL ELSE '"senses":[{{"sense_no":1,"is_primary":true,"definition_en":"x"}}]' END,
  CASE id % 9 WHEN 0 THEN NULL WHEN 1 THEN '"examples":[{{"example_text":"A ' || noun || '.","intended_cefr":"A1"}},{{"example_text":"none","intended_cefr":"B9"}}]' ELSE '"examples":[{{"example_text":"A ' || noun || '.","intended_cefr":"A1"}},{{"example_text":"' || upper(noun) || '!","intended_cefr":"C2"}},{{"example_text":"x-' || noun || '","intended_cefr":"B1"}}]' END,
  CASE id % 3 WHEN 0 THEN '"mnemonic_ar":null' WHEN 1 THEN '"mnemonic_ar":"like ' || noun || '"' END, CASE WHEN id % 5 = 3 THEN '"synonyms":[1,2,3,4,5,6]' ELSE '"synonyms":[]' END, CASE WHEN id % 5 = 4 THEN '"antonyms":"x"' ELSE '"antonyms":["a","b","c"]' END, '"collocations":[]',
  CASE WHEN id % 6 = 1 THEN '"related_words":{{"en":[]}}' ELSE '"related_words":{{"en":[],"ar":[]}}' END, CASE WHEN id % 10 = 3 THEN '"translations":{{"arabic_ar":" "}}' ELSE '"translations":{{"arabic_ar":"x"}}' END, CASE WHEN id % 12 = 5 THEN '"word_family":{{"noun":"","adv":null}}' ELSE '"word_family":{{"noun":"","verb":"","adj":"","adv":""}}' END) AS body FROM p)"""
_ENTRY_RULES = rf"""
o AS (SELECT *, ('{{' || body || '}}')::JSON AS o FROM e),
x AS (SELECT *, list_filter([{_quoted(artifacts.ENTRY_FIELDS)}], lambda f: NOT list_contains(json_keys(o), f)) AS lacking, coalesce(json_extract(o, '$.senses[*]'), []) AS s, coalesce(json_extract(o, '$.examples[*]'), []) AS ex FROM o),
i AS (SELECT id, broken, list_concat(list_concat([CASE WHEN len(lacking) > 0 THEN 'MISSING_FIELDS:' || array_to_string(lacking, ',') END, CASE WHEN (o->>'$.id') <> id::VARCHAR THEN 'ID_MISMATCH' END, CASE WHEN lower(o->>'$.pos') <> pos THEN 'POS_MISMATCH' END, CASE WHEN upper(o->>'$.cefr_level') <> level THEN 'CEFR_MISMATCH' END,
  CASE WHEN NOT coalesce(json_type(o, '$.difficulty_score') = 'VARCHAR' AND regexp_full_match(o->>'$.difficulty_score', '[1-9]|10'), false) THEN 'DIFFICULTY_BAD' END, CASE WHEN coalesce(o->>'$.category', '') NOT IN ({_quoted(artifacts.CATEGORIES)}) THEN 'CATEGORY_BAD' END, CASE WHEN len(s) = 0 THEN 'NO_SENSES' END,
  CASE WHEN list_transform(s, lambda q: (q->>'$.sense_no')::BIGINT) <> range(1, len(s) + 1) THEN 'SENSE_NO_NONSEQ' END, CASE WHEN len(list_filter(s, lambda q: (q->>'$.is_primary') = 'true')) <> 1 THEN 'PRIMARY_COUNT:' || len(list_filter(s, lambda q: (q->>'$.is_primary') = 'true')) END, CASE WHEN len(ex) <> 3 THEN 'EXAMPLES_COUNT:' || len(ex) END],
  flatten(list_transform(range(len(ex)), lambda k: [CASE WHEN NOT list_contains({_tokens_sql("replace(json_extract_string(ex[k + 1], '$.example_text'), '''', ' ')")}, w) THEN 'EXAMPLE_MISSING_LEMMA[' || k || ']' END, CASE WHEN json_extract_string(ex[k + 1], '$.intended_cefr') NOT IN ({_quoted(LEVELS)}) THEN 'EXAMPLE_BAD_CEFR[' || k || ']' END]))),
  list_concat(list_concat([CASE WHEN contains(lower(o->>'$.definition_en'), w) THEN 'DEFINITION_CONTAINS_LEMMA' END], list_transform(range(len(s)), lambda k: CASE WHEN contains(lower(json_extract_string(s[k + 1], '$.definition_en')), w) THEN 'SENSE_DEF_CONTAINS_LEMMA[' || k || ']' END)),
  [CASE WHEN contains(lower(coalesce(o->>'$.mnemonic_ar', '')), w) THEN 'MNEMONIC_CONTAINS_LEMMA' END, CASE WHEN NOT coalesce(json_type(o, '$.collocations') = 'ARRAY' AND json_array_length(o, '$.collocations') <= 5, false) THEN 'COLLOCATIONS_BOUND' END, CASE WHEN NOT coalesce(json_type(o, '$.synonyms') = 'ARRAY' AND json_array_length(o, '$.synonyms') <= 5, false) THEN 'SYNONYMS_BOUND' END,
  CASE WHEN NOT coalesce(json_type(o, '$.antonyms') = 'ARRAY' AND json_array_length(o, '$.antonyms') <= 3, false) THEN 'ANTONYMS_BOUND' END, CASE WHEN json_type(o, '$.related_words.ar') IS NULL THEN 'RELATED_WORDS_MISSING_EN_AR' END, CASE WHEN trim(o->>'$.translations.arabic_ar') = '' THEN 'ARABIC_TRANSLATION_EMPTY' END,
  CASE WHEN json_type(o, '$.word_family.noun') IS NULL THEN 'WF_MISSING_noun' END, CASE WHEN json_type(o, '$.word_family.verb') IS NULL THEN 'WF_MISSING_verb' END, CASE WHEN json_type(o, '$.word_family.adj') IS NULL THEN 'WF_MISSING_adj' END, CASE WHEN json_type(o, '$.word_family.adv') IS NULL THEN 'WF_MISSING_adv' END])) AS issues FROM x)
SELECT id, CASE WHEN broken THEN 'NO_PARSE' ELSE array_to_string(list_filter(issues, lambda q: q IS NOT NULL), ';') END AS issues FROM i"""


@query(_ENTRY_SQL + "," + _ENTRY_RULES)
def entry_issues(spark, sf):
    i, w = F.col("id"), F.col("noun")
    say = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    sense = '{"sense_no":1,"is_primary":true,"definition_en":"x"}'
    parts = [
        say('"id":', F.when(i % 11 == 1, i + 1).otherwise(i).cast("string")),
        say('"lemma":"', w, '"'),
        say('"pos":"', F.when(i % 7 == 1, "other").otherwise(F.upper("pos")), '"'),
        say('"cefr_level":"', F.lower("level"), '"'),
        _pick(i % 5, '"difficulty_score":"11"', '"difficulty_score":7', None, '"difficulty_score":"10"', '"difficulty_score":"10"'),
        F.when(i % 4 == 0, '"category":"None"').otherwise('"category":"Work & Business"'),
        say('"definition_en":"', F.when(i % 6 == 0, say("the ", F.upper(w), "s")).otherwise("a thing"), '"'),
        F.when(i % 8 == 0, '"senses":[]').when(i % 8 == 1, say('"senses":[', sense, ',{"sense_no":3,"is_primary":true,"definition_en":"my ', w, '"}]')).when(i % 8 != 2, f'"senses":[{sense}]'),
        F.when(i % 9 == 1, say('"examples":[{"example_text":"A ', w, '.","intended_cefr":"A1"},{"example_text":"none","intended_cefr":"B9"}]')).when(i % 9 > 1, say('"examples":[{"example_text":"A ', w, '.","intended_cefr":"A1"},{"example_text":"', F.upper(w), '!","intended_cefr":"C2"},{"example_text":"x-', w, '","intended_cefr":"B1"}]')),
        F.when(i % 3 == 0, '"mnemonic_ar":null').when(i % 3 == 1, say('"mnemonic_ar":"like ', w, '"')),
        F.when(i % 5 == 3, '"synonyms":[1,2,3,4,5,6]').otherwise('"synonyms":[]'),
        F.when(i % 5 == 4, '"antonyms":"x"').otherwise('"antonyms":["a","b","c"]'),
        F.lit('"collocations":[]'),
        F.when(i % 6 == 1, '"related_words":{"en":[]}').otherwise('"related_words":{"en":[],"ar":[]}'),
        F.when(i % 10 == 3, '"translations":{"arabic_ar":" "}').otherwise('"translations":{"arabic_ar":"x"}'),
        F.when(i % 12 == 5, '"word_family":{"noun":"","adv":null}').otherwise('"word_family":{"noun":"","verb":"","adj":"","adv":""}'),
    ]
    raw = F.concat(F.when(i % 13 == 0, "{{").otherwise("{"), F.concat_ws(",", *parts), F.lit("}"))
    rows = _words(spark, sf).select("id", "pos", "level", raw.alias("raw"))
    return artifacts.entry_issues(rows, "raw", "id", "pos", "level").select("id", F.array_join("issues", ";").alias("issues"))
