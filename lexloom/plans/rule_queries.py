"""Queries over rules and contracts: triage, validity of fields, batch answers, artifacts, candidates, ballots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import artifacts, contracts, rules
from .base import table
from .queries import _CLOSURE_SQL, _WORDS_SQL, _words, query

_quoted = lambda items: ", ".join("'" + x.replace("'", "''") + "'" for x in items)
_NULLS = _quoted(T.NULL_WORDS)
_norm_phrase_sql = lambda x: f"trim(regexp_replace(replace(lower({x}), '-', ' '), '\\s+', ' ', 'g'))"
_plain_sql = lambda x: f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"
_circular_sql = lambda d, w: f"({_plain_sql(w)} <> '' AND {_plain_sql(d)} IN ({_plain_sql(w)}, 'a ' || {_plain_sql(w)}, 'the ' || {_plain_sql(w)}, 'to ' || {_plain_sql(w)}, 'the act of ' || {_plain_sql(w)}, 'the act of ' || {_plain_sql(w)} || 'ing'))"
_tokens_sql = lambda x: f"[lower(t) for t in regexp_extract_all({x}, '[A-Za-z'']+')]"

# Cards made of the parts: every field takes every shape that the rules tell apart.
_CARDS_SQL = rf"""WITH p AS ({_WORDS_SQL}),
b AS (SELECT id, noun AS w, pos, word,
  CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN ' N/A' WHEN 3 THEN 'The act of ' || noun || 'ing.' WHEN 4 THEN 'لا يوجد' ELSE 'a kind of ' || pos END AS definition,
  CASE id % 5 WHEN 0 THEN '' WHEN 1 THEN 'None' WHEN 2 THEN pos ELSE 'شرح ' || noun END AS explanation,
  CASE id % 9 WHEN 0 THEN '{{broken' WHEN 1 THEN '[]' WHEN 2 THEN '["", "x"]' WHEN 3 THEN '["Nothing here."]' WHEN 4 THEN '["The ' || noun || '-x runs.", "the ' || noun || ' x  runs."]' WHEN 5 THEN '["the ' || noun || '", "A ' || noun || ' now."]'
    WHEN 6 THEN '{{"A1": "The ' || noun || 's run.", "B1": "My ' || noun || '."}}' WHEN 7 THEN '[1, "a"]' ELSE '{{"A1": 5}}' END AS examples,
  CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN ' / ' WHEN 2 THEN 'a/ A ' ELSE 'قط/ كلب' END AS translations,
  CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'NONE ' ELSE noun END AS mnemonic,
  CASE id % 9 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN '{{"a": 1}}' WHEN 3 THEN '["a", 1]' WHEN 4 THEN '["' || upper(noun) || '"]' WHEN 5 THEN '["a-b", "A  b"]' WHEN 6 THEN '["quick", "fast"]' WHEN 7 THEN '["Hot"]' ELSE '["big"' END AS synonyms,
  CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN '["Fast"]' WHEN 2 THEN '["hot", "cold"]' ELSE '[]' END AS antonyms,
  CASE id % 3 WHEN 0 THEN '["' || noun || ' x"]' WHEN 1 THEN '["y", "y"]' ELSE NULL END AS collocations FROM p),
l AS (SELECT *, left(w, -1) AS st, w || right(w, 1) AS tw, regexp_matches(w, '[^aeiou]y$') AS cy, w LIKE '%e' AS fe, regexp_matches(w, '[^aeiou][aeiou][^aeiouwyx]$') AS dbl FROM b),
c AS (SELECT *, {_CLOSURE_SQL} AS forms,
  CASE WHEN NOT json_valid(examples) THEN NULL WHEN json_type(examples) = 'ARRAY' AND json_array_length(examples) > 0 AND len(list_filter(json_extract(examples, '$[*]'), lambda e: json_type(e) <> 'VARCHAR')) = 0 THEN [e ->> '$' for e in json_extract(examples, '$[*]')]
    WHEN json_type(examples) = 'OBJECT' AND len(json_keys(examples)) > 0 THEN [CASE WHEN json_type(e) = 'VARCHAR' THEN e ->> '$' END for e in json_extract(examples, '$.*')] END AS bands FROM l),"""
_rel_sql = lambda f: f"""CASE WHEN {f} IS NULL THEN NULL WHEN NOT json_valid({f}) OR json_type({f}) <> 'ARRAY' THEN 'REL_MALFORMED_JSON'
    WHEN len(list_filter(json_extract(CASE WHEN json_valid({f}) THEN {f} END, '$[*]'), lambda e: json_type(e) <> 'VARCHAR')) > 0 THEN 'REL_INVALID_ITEM'
    WHEN list_contains([{_norm_phrase_sql("e ->> '$'")} for e in json_extract(CASE WHEN json_valid({f}) THEN {f} END, '$[*]')], {_norm_phrase_sql('w')}) THEN 'REL_SELF_REFERENCE'
    WHEN len(list_distinct([{_norm_phrase_sql("e ->> '$'")} for e in json_extract(CASE WHEN json_valid({f}) THEN {f} END, '$[*]')])) < json_array_length(CASE WHEN json_valid({f}) THEN {f} END) THEN 'REL_DUPLICATES' END"""  # noqa: E731
_items_sql = lambda f: f"[{_norm_phrase_sql(chr(101) + ' ->> ' + chr(39) + '$' + chr(39))} for e in json_extract(CASE WHEN json_valid({f}) THEN {f} END, '$[*]')]"
_TRIAGE_SQL = _CARDS_SQL + rf"""
r AS (SELECT *, {_rel_sql('synonyms')} AS sc, {_rel_sql('antonyms')} AS ac, {_rel_sql('collocations')} AS cc FROM c),
o AS (SELECT *, sc IS NULL AND ac IS NULL AND synonyms IS NOT NULL AND antonyms IS NOT NULL AND list_has_any({_items_sql('synonyms')}, {_items_sql('antonyms')}) AS shared FROM r),
f AS (SELECT id,
  CASE WHEN definition IS NULL OR trim(definition) = '' THEN 'DEF_EMPTY' WHEN lower(trim(definition)) IN ({_NULLS}) THEN 'DEF_GENERIC_NULL' WHEN {_circular_sql('definition', 'w')} THEN 'DEF_CIRCULAR' END AS definition_en,
  CASE WHEN trim(explanation) = '' THEN 'AR_EMPTY' WHEN lower(trim(explanation)) IN ({_NULLS}) THEN 'AR_GENERIC_NULL' WHEN NOT regexp_matches(explanation, '[؀-ۿ]') THEN 'AR_NO_ARABIC_SCRIPT' END AS explanation_ar,
  CASE WHEN bands IS NULL THEN 'EX_MALFORMED_JSON' WHEN list_contains([coalesce(trim(s) = '', true) for s in bands], true) THEN 'EX_EMPTY_BAND'
    WHEN list_contains([list_has_any({_tokens_sql('s')}, forms) for s in bands], false) THEN 'EX_NO_LEMMA_TOKEN'
    WHEN len(list_distinct([{_norm_phrase_sql('s')} for s in bands])) < len(bands) THEN 'EX_DUPLICATE_BANDS'
    WHEN list_contains([regexp_matches(trim(s), '[.!?؟۔]$') for s in bands], false) AND list_contains([regexp_matches(trim(s), '^\p{{Ll}}') for s in bands], true) THEN 'EX_SOFT_ESCALATION' END AS examples,
  CASE WHEN translations IS NULL OR len(list_filter(string_split(translations, '/'), lambda s: trim(s) <> '')) = 0 THEN 'TR_EMPTY'
    WHEN len(list_distinct([lower(trim(s)) for s in string_split(translations, '/')])) < len(string_split(translations, '/')) THEN 'TR_DUPLICATE_SLOTS' END AS translations,
  CASE WHEN mnemonic IS NULL THEN NULL WHEN trim(mnemonic) = '' THEN 'MNE_EMPTY_STRING' WHEN lower(trim(mnemonic)) IN ({_NULLS}) THEN 'MNE_GENERIC_NULL' END AS mnemonic,
  CASE WHEN shared THEN 'REL_SYN_ANT_OVERLAP' ELSE sc END AS relations_synonyms, CASE WHEN shared THEN 'REL_SYN_ANT_OVERLAP' ELSE ac END AS relations_antonyms, cc AS relations_collocations FROM o),
t AS (SELECT id, unnest(['definition_en','explanation_ar','examples','translations','mnemonic','relations_synonyms','relations_antonyms','relations_collocations','sense_separation']) AS field,
  unnest([definition_en, explanation_ar, examples, translations, mnemonic, relations_synonyms, relations_antonyms, relations_collocations, NULL]) AS code FROM f),
s AS (SELECT *, CASE WHEN field = 'sense_separation' THEN 'MANUAL_REVIEW' WHEN code IS NULL THEN 'KEEP' WHEN code LIKE 'MNE%' THEN 'DETERMINISTIC_REPAIR' ELSE 'LLM_REVIEW' END AS status FROM t)"""


def _cards(spark, sf):
    i, w = F.col("id"), F.col("noun")
    case = lambda n, *values: F.coalesce(*[F.when(i % n == k, v) for k, v in enumerate(values)]) if len(values) == n else None
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    null = F.lit(None).cast("string")
    other = text("a kind of ", F.col("pos"))
    return _words(spark, sf).select(
        "id",
        w.alias("w"),
        "pos",
        case(7, null, F.lit("  "), F.lit(" N/A"), text("The act of ", w, "ing."), F.lit("لا يوجد"), other, other).alias("definition"),
        case(5, F.lit(""), F.lit("None"), F.col("pos"), text("شرح ", w), text("شرح ", w)).alias("explanation"),
        case(
            9, F.lit("{broken"), F.lit("[]"), F.lit('["", "x"]'), F.lit('["Nothing here."]'), text('["The ', w, '-x runs.", "the ', w, ' x  runs."]'), text('["the ', w, '", "A ', w, ' now."]'),
            text('{"A1": "The ', w, 's run.", "B1": "My ', w, '."}'), F.lit('[1, "a"]'), F.lit('{"A1": 5}'),
        ).alias("examples"),
        case(6, null, F.lit(" / "), F.lit("a/ A "), *[F.lit("قط/ كلب")] * 3).alias("translations"),
        case(5, null, F.lit(""), F.lit("NONE "), w, w).alias("mnemonic"),
        case(9, null, F.lit("[]"), F.lit('{"a": 1}'), F.lit('["a", 1]'), text('["', F.upper(w), '"]'), F.lit('["a-b", "A  b"]'), F.lit('["quick", "fast"]'), F.lit('["Hot"]'), F.lit('["big"')).alias("synonyms"),
        case(4, null, F.lit('["Fast"]'), F.lit('["hot", "cold"]'), F.lit("[]")).alias("antonyms"),
        case(3, text('["', w, ' x"]'), F.lit('["y", "y"]'), null).alias("collocations"),
        F.lit("Object").alias("primary_sense"),
    )


@query(_TRIAGE_SQL + " SELECT id, field, status, code, status = 'LLM_REVIEW' AS requires_llm, status = 'MANUAL_REVIEW' AS requires_human FROM s")
def field_triage_records(spark, sf):
    return rules.triage(_cards(spark, sf), "id", "w", "pos")


_MARKS_SQL = rf""",
m AS (SELECT *, CASE WHEN json_valid(examples) THEN CASE WHEN json_type(examples) = 'OBJECT' THEN json_keys(examples) ELSE ['arr' || i for i in range(len(bands))] END END AS names FROM o),
n AS (SELECT *, list_filter(range(len(bands)), lambda i: coalesce(trim(bands[i + 1]) = '', true)) AS blank, list_filter(range(len(bands)), lambda i: coalesce(trim(bands[i + 1]) <> '', false)) AS texted FROM m),
u AS (SELECT *, list_filter(texted, lambda i: NOT list_has_any({_tokens_sql('bands[i + 1]')}, forms)) AS failing, flatten([list_filter([CASE WHEN NOT regexp_matches(trim(bands[i + 1]), '[.!?؟۔]$') THEN names[i + 1] || ':EX_NO_TERMINAL_PUNCT' END, CASE WHEN regexp_matches(trim(bands[i + 1]), '^\p{{Ll}}') THEN names[i + 1] || ':EX_LEADING_LOWERCASE' END], lambda q: q IS NOT NULL) for i in texted]) AS softs FROM n)"""


@query(_TRIAGE_SQL + _MARKS_SQL + rf""",
z AS (SELECT u.*, s.field, s.code FROM u JOIN s USING (id))
SELECT id, field, code,
  CASE code WHEN 'EX_EMPTY_BAND' THEN array_to_string([names[i + 1] for i in blank], ',') WHEN 'EX_NO_LEMMA_TOKEN' THEN array_to_string([names[i + 1] for i in failing], ',') END AS bands,
  CASE WHEN field = 'examples' AND coalesce(code, 'EX_SOFT_ESCALATION') = 'EX_SOFT_ESCALATION' AND len(softs) > 0 THEN array_to_string(softs, ',') WHEN field = 'translations' AND code IS NULL AND NOT regexp_matches(translations, '[؀-ۿ]') THEN ':TR_NO_ARABIC_SCRIPT'
    WHEN field = 'relations_collocations' AND code IS NULL AND collocations IS NOT NULL AND len(list_filter({_items_sql('collocations')}, lambda q: NOT contains(q, {_norm_phrase_sql('w')}))) > 0 THEN ':REL_COLLOCATION_NO_TARGET' END AS softs,
  CASE WHEN field = 'translations' AND (code IS NULL OR code = 'TR_DUPLICATE_SLOTS') THEN len(list_filter(string_split(translations, '/'), lambda q: trim(q) <> '')) WHEN field LIKE 'relations%' AND (code IS NULL OR code = 'REL_DUPLICATES')
    THEN CASE field WHEN 'relations_synonyms' THEN len({_items_sql('synonyms')}) WHEN 'relations_antonyms' THEN len({_items_sql('antonyms')}) ELSE len({_items_sql('collocations')}) END END AS n,
  CASE WHEN code LIKE 'MNE%' THEN 'normalize_to_null' END AS fix, CASE WHEN code = 'REL_SYN_ANT_OVERLAP' THEN array_to_string(list_sort(list_intersect({_items_sql('synonyms')}, {_items_sql('antonyms')})), ',') END AS shared FROM z""")
def triage_evidence(spark, sf):
    told = rules.triage(_cards(spark, sf).withColumn("primary_sense", F.lit("x")), "id", "w", "pos", evidence=True)
    e = F.from_json("evidence", "empty_bands array<string>, failing_bands array<string>, soft_signals array<struct<band:string,signal:string>>, slot_count int, item_count int, overlap array<string>, proposed_fix string")
    softs = F.array_join(F.transform("e.soft_signals", lambda s: F.concat(F.coalesce(s["band"], F.lit("")), F.lit(":"), s["signal"])), ",")
    return told.withColumn("e", e).select("id", "field", "code", F.array_join(F.coalesce("e.empty_bands", "e.failing_bands"), ",").alias("bands"), softs.alias("softs"), F.coalesce("e.slot_count", "e.item_count").cast("long").alias("n"), F.col("e.proposed_fix").alias("fix"), F.array_join("e.overlap", ",").alias("shared"))


@query(_TRIAGE_SQL + """,
q AS (SELECT field, count(*) AS total, count(*) FILTER (status <> 'KEEP') AS flagged, CASE WHEN field = 'examples' THEN 0.35 WHEN field LIKE 'relations%' OR field = 'translations' THEN 0.3 ELSE 0.2 END::DOUBLE AS quota FROM s WHERE field <> 'sense_separation' GROUP BY field)
SELECT field, total, flagged, round(flagged / total, 4) AS rate, quota, flagged / total > quota AS breached FROM q""")
def triage_quota_report(spark, sf):
    return rules.quota_report(rules.triage(_cards(spark, sf), "id", "w", "pos"))


@query(rf"""WITH p AS ({_WORDS_SQL}), l AS (SELECT id, pos, noun AS w, left(noun, -1) AS st, noun || right(noun, 1) AS tw, regexp_matches(noun, '[^aeiou]y$') AS cy, noun LIKE '%e' AS fe, regexp_matches(noun, '[^aeiou][aeiou][^aeiouwyx]$') AS dbl,
  CASE id % 4 WHEN 0 THEN 'The ' || noun || 's.' WHEN 1 THEN 'He gives-' || noun || ' away' WHEN 2 THEN 'gave ' || noun ELSE upper(noun) || '!' END AS t FROM p)
SELECT id, list_has_any({_tokens_sql('t')}, {_CLOSURE_SQL}) AS word, list_contains([contains({_norm_phrase_sql('t')}, v) for v in list_concat(['give ' || w, 'gives ' || w, 'gived ' || w, 'giving ' || w, 'gived ' || w, 'give ' || w], ['give ' || f for f in list_transform([{{'w': w, 'st': st, 'tw': tw, 'cy': cy, 'fe': fe, 'dbl': dbl}}], lambda x: x.w || 's')])], true) AS phrase FROM l""")
def target_presence(spark, sf):
    i, w = F.col("id") % 4, F.col("noun")
    t = F.when(i == 0, F.concat(F.lit("The "), w, F.lit("s."))).when(i == 1, F.concat(F.lit("He gives-"), w, F.lit(" away"))).when(i == 2, F.concat(F.lit("gave "), w)).otherwise(F.concat(F.upper(w), F.lit("!")))
    return _words(spark, sf).select("id", T.target_present(t, w, F.col("pos")).alias("word"), T.target_present(t, F.concat(F.lit("Give "), w), F.lit("verb")).alias("phrase"))


_VALID_SQL = rf"""WITH b AS (SELECT p_partkey AS id, p_partkey AS i, string_split(p_name, ' ')[-1] AS w, p_name, p_type FROM part),
v AS (SELECT id, w, CASE i % 4 WHEN 0 THEN NULL WHEN 1 THEN 'To ' || w WHEN 2 THEN '  ' ELSE 'a thing' END AS d,
  CASE i % 5 WHEN 0 THEN '' WHEN 1 THEN ' None ' WHEN 2 THEN '[شرح]' WHEN 3 THEN '(x' ELSE 'شرح' END AS e,
  CASE i % 5 WHEN 0 THEN NULL WHEN 1 THEN ['A ' || w, w, ''] WHEN 2 THEN [w || '.', ' ', w] WHEN 3 THEN [w, w || 's', w] ELSE ['One ' || w, upper(w) || '!', w] END AS x,
  CASE i % 4 WHEN 0 THEN NULL WHEN 1 THEN ['none', 'N/A'] WHEN 2 THEN [' ', ''] ELSE ['null', 'قط'] END AS t,
  CASE i % 3 WHEN 0 THEN [] WHEN 1 THEN [' '] ELSE [p_type] END AS r,
  CASE i % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'لا  شيء' WHEN 3 THEN 'NULL' ELSE w END AS m FROM b),
y AS (SELECT id, unnest(['definition', 'explanation', 'examples', 'translations', 'relations', 'mnemonic']) AS field, unnest([
  CASE WHEN coalesce(trim(d), '') = '' THEN 'empty' WHEN {_circular_sql('d', 'w')} THEN 'circular' ELSE '' END,
  CASE WHEN trim(e) = '' THEN 'empty' WHEN lower(trim(e)) IN ({_NULLS}) THEN 'generic_null' WHEN e LIKE '[%' OR e LIKE '(%' THEN 'bracket_placeholder' ELSE '' END,
  CASE WHEN x IS NULL OR len(list_filter(x, lambda s: s <> '')) <> 3 THEN 'count!=3' WHEN list_contains([trim(s) = '' for s in x], true) THEN 'empty_example' WHEN list_contains([list_contains({_tokens_sql('s')}, w) for s in x], false) THEN 'target_missing' ELSE '' END,
  CASE WHEN t IS NULL OR len(list_filter(t, lambda s: trim(s) <> '')) = 0 THEN 'empty' WHEN len(list_filter(t, lambda s: trim(s) <> '' AND lower(trim(s)) NOT IN ({_NULLS}))) = 0 THEN 'generic_null' ELSE '' END,
  CASE WHEN len(list_filter(r, lambda s: trim(s) <> '')) = 0 THEN 'empty' ELSE '' END,
  CASE WHEN m IS NULL THEN 'null' WHEN m = '' THEN 'empty' WHEN trim(regexp_replace(lower(m), '\s+', ' ', 'g')) IN ({_NULLS}) THEN 'generic_null' ELSE '' END]) AS why FROM v)"""


@query(_VALID_SQL + " SELECT id, field, why = '' AS valid, why FROM y")
def field_validity(spark, sf):
    i, w = F.col("p_partkey"), F.element_at(F.split("p_name", " "), -1)
    texts = lambda *xs: F.array(*[x if not isinstance(x, str) else F.lit(x) for x in xs])
    fields = {
        "definition": F.when(i % 4 == 1, F.concat(F.lit("To "), w)).when(i % 4 == 2, "  ").when(i % 4 == 3, "a thing"),
        "explanation": F.when(i % 5 == 0, "").when(i % 5 == 1, " None ").when(i % 5 == 2, "[شرح]").when(i % 5 == 3, "(x").otherwise("شرح"),
        "examples": F.when(i % 5 == 1, texts(F.concat(F.lit("A "), w), w, "")).when(i % 5 == 2, texts(F.concat(w, F.lit(".")), " ", w)).when(i % 5 == 3, texts(w, F.concat(w, F.lit("s")), w)).when(i % 5 == 4, texts(F.concat(F.lit("One "), w), F.concat(F.upper(w), F.lit("!")), w)),
        "translations": F.when(i % 4 == 1, texts("none", "N/A")).when(i % 4 == 2, texts(" ", "")).when(i % 4 == 3, texts("null", "قط")),
        "relations": F.when(i % 3 == 0, F.array().cast("array<string>")).when(i % 3 == 1, texts(" ")).otherwise(texts(F.col("p_type"))),
        "mnemonic": F.when(i % 5 == 1, "").when(i % 5 == 2, "لا  شيء").when(i % 5 == 3, "NULL").when(i % 5 == 4, w),
    }
    told = F.inline(F.array(*[F.struct(F.lit(k).alias("field"), V.field_validity(k, v, w).alias("x")) for k, v in fields.items()]))
    return table(spark, sf, "part").select(i.alias("id"), told).select("id", "field", "x.valid", "x.why")


@query(f"""WITH x AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' || source WHEN 2 THEN 'wrong because the sense belongs to another headword' WHEN 3 THEN 'Not  ideal for ' || lang WHEN 4 THEN 'the example is UNCERTAIN here' ELSE 'no better way in ' || lang END AS x FROM documents),
n AS (SELECT doc_id, coalesce(trim(regexp_replace(lower(x), '\\s+', ' ', 'g')), '') AS s FROM x)
SELECT doc_id, s <> '' AND length(s) >= 10 AND NOT list_contains([contains(s, p) for p in [{_quoted(V.VAGUE)}]], true) AS suffices FROM n""".replace("\\\\", "\\"))
def argument_suffices(spark, sf):
    i = F.col("doc_id") % 6
    x = F.when(i == 1, F.concat(F.lit(" "), "source")).when(i == 2, "wrong because the sense belongs to another headword").when(i == 3, F.concat(F.lit("Not  ideal for "), "lang")).when(i == 4, "the example is UNCERTAIN here").when(i == 5, F.concat(F.lit("no better way in "), "lang"))
    return table(spark, sf, "documents").select("doc_id", V.reason_suffices(x).alias("r")).select("doc_id", "r.suffices")


# ---- batch answers: words and senses from orders and their lines

_SENSE_SQL = f"""(SELECT l_orderkey AS word_id, l_linenumber AS sense_no, l_returnflag, l_linestatus, l_quantity::INT AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS place FROM lineitem)"""


@query(f"""WITH s AS (SELECT word_id, place, sense_no, CASE WHEN q % 9 = 0 THEN '' ELSE 'd' END AS en, CASE WHEN q % 7 = 0 THEN NULL ELSE 'ت' END AS ar, 's' AS short, CASE l_returnflag WHEN 'R' THEN 'Formal' WHEN 'A' THEN 'neutral' ELSE 'Slang' END AS reg, CASE WHEN q % 5 = 0 THEN 'Thing' ELSE 'Object' END AS ps, CASE WHEN q % 11 = 0 THEN 'a (b)' END AS mn, q % 4 AS tags FROM {_SENSE_SQL}),
i AS (SELECT word_id AS id, 'sense ' || place || ': ' AS pre, [CASE WHEN sense_no = 0 THEN 'SENSE_NO' END, CASE WHEN en = '' THEN 'DEFINITION_EN' END, CASE WHEN ar IS NULL THEN 'DEFINITION_AR' END, CASE WHEN reg NOT IN ({_quoted(artifacts.REGISTERS)}) THEN 'REGISTER' END,
  CASE WHEN ps NOT IN ({_quoted(artifacts.PRIMARY_SENSES)}) THEN 'PRIMARY_SENSE' END, CASE WHEN mn IS NOT NULL THEN 'BRACKETS' END, CASE tags WHEN 0 THEN 'NO_TAGS' WHEN 1 THEN 'TAG_COUNT' WHEN 2 THEN 'TAG_FORMAT' END] AS codes FROM s),
e AS (SELECT o_orderkey AS id, o_orderpriority AS lemma FROM orders WHERE o_orderkey % 13 <> 5),
w AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 17 = 3 THEN 'x' ELSE o_orderpriority END AS lemma, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice / 450000 END AS conf, CASE o_orderstatus WHEN 'F' THEN 'Food & Drink' WHEN 'O' THEN 'Objects & Tools' ELSE 'Other' END AS cat, CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN '/x/' ELSE 'x' END AS us FROM orders WHERE o_orderkey % 11 <> 4),
n AS (SELECT l_orderkey AS id, count(*) AS n, count(*) FILTER (l_linestatus = 'O') AS p FROM lineitem GROUP BY 1),
a AS (SELECT w.id, [CASE WHEN e.id IS NULL THEN 'EXTRA_ID' END, CASE WHEN e.id IS NOT NULL AND w.lemma <> e.lemma THEN 'LEMMA' END, CASE WHEN conf IS NULL OR conf > 1 THEN 'CONFIDENCE' END, CASE WHEN cat = 'Other' THEN 'CATEGORY' END, CASE WHEN us = '' THEN 'US_MISSING' WHEN us LIKE '%/%' THEN 'US_SLASHES' END,
  CASE WHEN n IS NULL THEN 'NO_SENSES' END, CASE WHEN n > 0 AND p <> 1 THEN 'PRIMARY_COUNT' END] AS codes FROM w LEFT JOIN e USING (id) LEFT JOIN n ON n.id = w.id),
u AS (SELECT id, unnest(codes) AS code FROM a UNION ALL SELECT id, pre || unnest(codes) FROM i WHERE id IN (SELECT id FROM w) UNION ALL SELECT id, 'MISSING_ID' FROM e WHERE id NOT IN (SELECT id FROM w))
SELECT code, count(*) AS n, min(id) AS first_id FROM u WHERE code IS NOT NULL GROUP BY code""")
def response_issues(spark, sf):
    from pyspark.sql import Window

    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    q = F.col("l_quantity").cast("int")
    tags = F.when(q % 4 == 1, F.array(F.lit("#a"))).when(q % 4 == 2, F.array(F.lit("#a"), F.lit("b"), F.lit("#c"))).when(q % 4 == 3, F.array(F.lit("#a"), F.lit("#b"), F.lit("#c")))
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    sense = F.struct(
        place.alias("place"), F.col("l_linenumber").alias("sense_no"), F.when(q % 9 == 0, "").otherwise("d").alias("definition_en"), F.when(q % 7 != 0, "ت").alias("definition_ar"), F.lit("s").alias("short_def_en"),
        F.when(F.col("l_returnflag") == "R", "Formal").when(F.col("l_returnflag") == "A", "neutral").otherwise("Slang").alias("register"), F.when(q % 5 == 0, "Thing").otherwise("Object").alias("primary_sense"),
        F.when(q % 11 == 0, "a (b)").alias("mnemonic_ar"), tags.alias("semantic_tags"), (F.col("l_linestatus") == "O").alias("is_primary"),
    )
    senses = li.select("l_orderkey", sense.alias("s")).groupBy("l_orderkey").agg(F.sort_array(F.collect_list("s")).alias("senses"))
    key, one = F.col("o_orderkey"), F.lit("noun").alias("pos")
    base = o.join(senses, key == F.col("l_orderkey"), "left")
    words = base.where("o_orderkey % 11 <> 4").select(
        key.alias("id"), F.when(key % 17 == 3, "x").otherwise(F.col("o_orderpriority")).alias("lemma"), one, F.lit("A1").alias("cefr_level"), F.when(key % 10 != 0, F.col("o_totalprice") / 450000).alias("ai_confidence"),
        F.when(F.col("o_orderstatus") == "F", "Food & Drink").when(F.col("o_orderstatus") == "O", "Objects & Tools").otherwise("Other").alias("category"), F.when(key % 6 == 0, "").when(key % 6 == 1, "/x/").otherwise("x").alias("phonetic_us"),
        F.lit(None).cast("string").alias("phonetic_uk"), F.lit("ا").alias("phonetic_ar"), "senses",
    )
    sent = o.where("o_orderkey % 13 <> 5").select(key.alias("id"), F.col("o_orderpriority").alias("lemma"), one, F.lit("A1").alias("cefr_level"))
    return artifacts.response_issues(words, sent).groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


_ART_SQL = rf"""WITH p AS ({_WORDS_SQL}),
a AS (SELECT id, noun AS w, CASE pos WHEN 'adj' THEN 'adjective' ELSE pos END AS pos, id % 19 = 0 AS broken, id % 17 = 1 AS failed, id % 13 = 2 AS missing, id % 11 = 3 AS noschema, id % 10 = 4 AS badhash,
  CASE id % 6 WHEN 0 THEN ' ' WHEN 1 THEN 'to ' || noun WHEN 2 THEN 'to go' ELSE 'a thing' END AS d, CASE WHEN id % 7 = 0 THEN NULL ELSE 'ش' END AS e,
  CASE id % 4 WHEN 0 THEN [noun, noun] WHEN 1 THEN [noun, noun || 's', noun] ELSE [noun, 'A ' || noun, noun] END AS x, CASE id % 5 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN NULL ELSE 'm' END AS m FROM p),
c AS (SELECT *, [CASE WHEN badhash THEN 'HASH_MISMATCH' END, CASE WHEN d = ' ' THEN 'INVALID_DEFINITION' WHEN e IS NULL THEN 'INVALID_EXPLANATION' END, CASE WHEN len(x) <> 3 THEN 'WRONG_EXAMPLE_COUNT' END,
  CASE WHEN list_contains([list_contains({_tokens_sql('s')}, w) for s in x], false) THEN 'TARGET_WORD_MISSING' END, CASE WHEN m = '' THEN 'MNEMONIC_EMPTY' WHEN m = 'N/A' THEN 'MNEMONIC_GENERIC_NULL' END] AS errs,
  [CASE WHEN {_circular_sql('d', 'w')} THEN 'CIRCULAR_DEFINITION' END, CASE WHEN (pos = 'verb' AND d NOT LIKE 'to %') OR (pos IN ('noun', 'adjective') AND d LIKE 'to %') THEN 'POS_HEURISTIC_SUSPICION' END] AS flgs FROM a),
r AS (SELECT id, CASE WHEN broken THEN 'INVALID_STRUCTURE' WHEN failed THEN 'RUNTIME_FAILED' WHEN missing THEN 'MISSING_OUTPUT' WHEN noschema THEN concat_ws(',', CASE WHEN badhash THEN 'HASH_MISMATCH' END, 'SCHEMA_VIOLATION') ELSE array_to_string(list_filter(errs, lambda q: q IS NOT NULL), ',') END AS errors,
  CASE WHEN broken OR failed OR missing OR noschema THEN '' ELSE array_to_string(list_filter(flgs, lambda q: q IS NOT NULL), ',') END AS flags FROM c),
t AS (SELECT id, CASE WHEN errors <> '' THEN 'ERROR' WHEN flags <> '' THEN 'FLAG' ELSE 'PASS' END AS status, errors, flags FROM r)"""


def _artifacts(spark, sf):
    i, w = F.col("id"), F.col("noun")
    texts = lambda *xs: F.array(*xs)
    plain = lambda x: F.lit(x)
    pos = F.when(F.col("pos") == "adj", "adjective").otherwise(F.col("pos"))
    envelope = F.struct(
        F.when(i % 19 == 0, "").otherwise(F.concat(F.lit("C-"), i.cast("string"))).alias("candidate_id"), plain("E1").alias("experiment_id"), i.alias("lexical_id"), w.alias("lemma"), pos.alias("pos"), F.col("level").alias("cefr"),
        F.when(i % 17 == 1, "failed").otherwise("success").alias("status"), plain("h").alias("output_hash"), plain("g").alias("golden_set_hash"), plain("v1.1").alias("schema_version"), F.when(i % 10 == 4, "other").otherwise("h").alias("computed_hash"),
    )
    output = F.struct(
        F.when(i % 6 == 0, " ").when(i % 6 == 1, F.concat(F.lit("to "), w)).when(i % 6 == 2, "to go").otherwise("a thing").alias("definition_en"), F.when(i % 7 != 0, "ش").alias("explanation_ar"),
        F.when(i % 4 == 0, texts(w, w)).when(i % 4 == 1, texts(w, F.concat(w, F.lit("s")), w)).otherwise(texts(w, F.concat(F.lit("A "), w), w)).alias("examples"), F.when(i % 5 == 0, "").when(i % 5 == 1, "N/A").when(i % 5 > 2, "m").alias("mnemonic_ar"), (i % 11 != 3).alias("schema_ok"),
    )
    rows = _words(spark, sf).select("id", envelope.alias("a"), F.when(i % 13 != 2, output).alias("o"), w.alias("w"), pos.alias("pos"))
    return rows.select("id", artifacts.artifact_result(F.col("a"), F.col("o"), "E1", F.col("w"), F.col("pos")).alias("r")).select("id", "r.status", F.array_join("r.errors", ",").alias("errors"), F.array_join("r.flags", ",").alias("flags"))


@query(_ART_SQL + " SELECT * FROM t")
def artifact_validation(spark, sf):
    return _artifacts(spark, sf)


@query(_ART_SQL + " SELECT count(*) AS total, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'ERROR') AS failed, count(*) FILTER (status = 'FLAG') AS flagged FROM t")
def validation_summary(spark, sf):
    return artifacts.validation_summary(_artifacts(spark, sf), "status")


# ---- seeded candidates as batch lines

_CAND_SQL = rf"""WITH p AS ({_WORDS_SQL}),
k AS (SELECT id, noun AS w, pos, level, word, id % 8 AS f, CASE id % 6 WHEN 0 THEN '' WHEN 1 THEN 'to ' || noun ELSE 'a thing' END AS d, CASE id % 5 WHEN 0 THEN 'None' WHEN 1 THEN '(x)' ELSE 'ش' END AS e,
  CASE id % 4 WHEN 0 THEN [noun, noun] WHEN 1 THEN [noun, 'none', noun] ELSE [noun, 'A ' || noun, noun] END AS x, id % 7 AS t, id % 3 AS r, CASE id % 5 WHEN 2 THEN 'null' WHEN 3 THEN NULL ELSE 'm' END AS m FROM p),
c AS (SELECT id, f, [CASE WHEN f = 5 THEN 'syllables' END, CASE WHEN f = 6 THEN 'senses' END, CASE WHEN f = 7 THEN 'identity_lemma' END, CASE WHEN d = '' THEN 'definition_nonempty' END, CASE WHEN {_circular_sql('d', 'w')} THEN 'definition_not_circular' END,
  CASE WHEN e IN ('None', '(x)') THEN 'explanation_not_generic' END, CASE WHEN len(x) <> 3 THEN 'examples_count' END, CASE WHEN list_contains([list_contains({_tokens_sql('s')}, w) for s in x], false) THEN 'examples_contain_target' END,
  CASE WHEN t = 0 THEN 'translations_nonempty' END, CASE WHEN r = 0 THEN 'relations_some_content' END, CASE WHEN m = 'null' THEN 'mnemonic_null_or_useful' END] AS bad FROM k),
o AS (SELECT id, CASE f WHEN 0 THEN 'malformed line' WHEN 1 THEN 'missing key' WHEN 2 THEN 'unknown key' WHEN 3 THEN 'batch error' WHEN 4 THEN 'parse failed' END AS error, list_filter(bad, lambda q: q IS NOT NULL) AS bad FROM c)"""


def _candidate_lines(spark, sf):
    i, w, null = F.col("id"), F.col("noun"), F.lit(None).cast("string")
    f, t, r = i % 8, i % 7, i % 3
    examples = F.when(i % 4 == 0, F.array(w, w)).when(i % 4 == 1, F.array(w, F.lit("none"), w)).otherwise(F.array(w, F.concat(F.lit("A "), w), w))
    relations = F.when(r == 1, F.to_json(F.struct(F.array(F.lit("s")).alias("synonyms")))).otherwise("{}")
    flat = F.when(r == 2, ', "antonyms": "one"').otherwise("")
    translations = F.when(t == 0, '" "').when(t == 1, '["قط", " "]').when(t == 2, '{"en": "", "ar": "قط"}').otherwise('"قط"')
    mnemonic = F.when(i % 5 == 2, '"null"').when(i % 5 == 3, "null").otherwise('"m"')
    quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    body = F.concat(
        F.lit('{"lemma": '), quote(F.when(f == 7, "other").otherwise(F.concat(F.lit(" "), F.upper(w)))), F.lit(', "pos": '), quote(F.col("pos")), F.lit(', "cefr": '), quote(F.lower("level")),
        F.lit(', "definition_en": '), quote(F.when(i % 6 == 0, "").when(i % 6 == 1, F.concat(F.lit("to "), w)).otherwise("a thing")), F.lit(', "explanation_ar": '), quote(F.when(i % 5 == 0, "None").when(i % 5 == 1, "(x)").otherwise("ش")),
        F.lit(', "senses": '), F.when(f == 6, "null").otherwise("[]"), F.lit(', "examples": '), F.when(i % 2 == 0, F.to_json(F.transform(examples, lambda x: F.struct(x.alias("example_text"))))).otherwise(F.to_json(examples)), F.lit(', "translations": '), translations,
        F.lit(', "relations": '), relations, flat, F.lit(', "mnemonic": '), mnemonic, F.lit(', "phonetic_us": "x", "phonetic_uk": null, '), F.when(f == 5, "").otherwise('"syllables": "x", '), F.lit('"semantic_tags": [], "ai_confidence": 0.5}'),
    )
    text = F.when(f == 4, "not json").when(i % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    answer = F.struct(F.array(F.struct(F.struct(F.array(F.struct(text.alias("text"))).alias("parts")).alias("content"))).alias("candidates"))
    key = F.concat(F.lit("k-"), i.cast("string"))
    line = F.when(f == 0, F.concat(F.lit("{"), key)).when(f == 1, F.to_json(F.struct(answer.alias("response")))).when(f == 3, F.to_json(F.struct(key.alias("key"), F.lit("quota").alias("error")))).otherwise(F.to_json(F.struct(key.alias("key"), answer.alias("response"))))
    p = _words(spark, sf)
    sent = p.where("id % 8 <> 2").select(key.alias("key"), w.alias("lemma"), "pos", F.col("level").alias("cefr"))
    return artifacts.import_candidates(p.select(line.alias("line")), sent, "line")


@query(_CAND_SQL + " SELECT CASE WHEN error IN ('malformed line', 'missing key') THEN NULL ELSE 'k-' || id END AS key, error, error IS NULL AND len(bad) = 0 AS artifact_pass, CASE WHEN error IS NULL THEN array_to_string(bad, ',') END AS failed FROM o")
def candidate_import(spark, sf):
    return _candidate_lines(spark, sf).select("key", "error", "artifact_pass", F.array_join("failed", ",").alias("failed"))


# ---- ballots

_verdicts_sql = f"[{_quoted(contracts.FIELDS)}]"


@query(f"""WITH d AS (SELECT doc_id, doc_id % 9 AS f FROM labels WHERE doc_id % 5 < 4 AND doc_id IS NOT NULL), g AS (SELECT DISTINCT doc_id, f FROM d),
e AS (SELECT DISTINCT doc_id FROM labels WHERE doc_id % 5 > 0),
o AS (SELECT coalesce(g.doc_id, e.doc_id) AS doc_id, CASE WHEN e.doc_id IS NULL THEN 'unknown' WHEN g.doc_id IS NULL THEN 'missing' WHEN f IN (0, 1, 2, 3, 4, 5) THEN 'reject' ELSE 'judgment' END AS outcome, f FROM g FULL JOIN e USING (doc_id))
SELECT doc_id, outcome, CASE WHEN outcome = 'reject' THEN CASE f WHEN 0 THEN 'malformed JSON' WHEN 1 THEN 'not an object' WHEN 2 THEN 'no fields' WHEN 3 THEN 'defects: verdict:examples' WHEN 4 THEN 'unjudged field' ELSE 'batch error' END END AS problem FROM o""")
def ballot_import(spark, sf):
    i = F.col("doc_id")
    lab = table(spark, sf, "labels").where("doc_id is not null").select("doc_id").distinct()
    f = i % 9
    fields = F.to_json(F.create_map(*[x for k in contracts.FIELDS for x in (F.lit(k), F.when((f == 3) & (F.lit(k) == "examples"), "A").when((f == 4) & (F.lit(k) == "mnemonic"), "unjudged").otherwise("A-better"))]))
    sides = F.lit("{" + ", ".join(f'"{k}": {{"side": null, "evidence": ""}}' for k in contracts.CRITICAL) + "}")
    ballot = F.concat(F.lit('{"fields": '), fields, F.lit(', "critical_errors": '), sides, F.lit(', "note": ""}'))
    text = F.when(f == 0, "{x").when(f == 1, "[1]").when(f == 2, '{"note": "x"}').when(f == 6, F.concat(F.lit('{"ballot": '), ballot, F.lit("}"))).when(f == 7, F.concat(F.lit("```json\n"), ballot, F.lit("\n```"))).otherwise(ballot)
    lines = lab.where("doc_id % 5 < 4").select("doc_id", F.explode(F.array(F.struct(F.lit(1).alias("line"), F.lit("{old").alias("text")), F.struct(F.lit(2).alias("line"), text.alias("text")))).alias("x")).select("doc_id", "x.line", "x.text")
    return artifacts.import_ballots(lines, lab.where("doc_id % 5 > 0"), "doc_id", "text", "line", f == 5).select("doc_id", "outcome", "problem")
