"""Queries over blind packages, prompts, envelopes, samples with wanted rows, imports and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import adjudication, artifacts, batch, contracts, levels, packages, quality, sampling
from ..sources import files
from ..streaming import drops
from .base import scratch, table
from .queries import _BALLOT_SQL, _LEVEL_SQL, _SIDE_SQL, _WORDS_SQL, _ballots, _words, query

_ITEMS_SQL = f"""WITH p AS ({_WORDS_SQL}), i AS (SELECT id, noun, pos, row_number() OVER (ORDER BY id) AS n, {_SIDE_SQL.format("id").replace("ab:", "blind:")} AS a FROM p WHERE id % 3 > 0)"""


def _items(spark, sf):
    i, noun = F.col("id"), F.col("noun")
    w = _words(spark, sf)
    raw = F.concat(F.lit('{"definition_en": "new '), noun, F.lit('", "examples": [{"example_text": "A '), noun, F.lit('."}], "translations": {"arabic_ar": "قط"}, "synonyms": ["s"], "mnemonic_ar": null}'))
    new = w.where(i % 3 > 0).select("id", packages.candidate_arm(raw).alias("candidate"))
    text = lambda x: F.lit(x).cast("string")
    old = w.select("id", packages.legacy_arm(F.concat(F.lit("old "), noun), text(None), F.concat(F.lit('{"A1": "My '), noun, F.lit('."}')), text("كلب"), text('["t", "u"]'), text("{x"), text(None), F.col("pos")).alias("legacy"))
    return packages.items(new, old, w.select("id", noun.alias("lemma"), "pos"), "id")


@query(_ITEMS_SQL + """ SELECT printf('EV-%04d', n) AS eval_id, noun AS lemma, CASE a WHEN 'candidate' THEN 'new ' ELSE 'old ' END || noun AS a_definition, CASE a WHEN 'candidate' THEN 'A ' ELSE 'My ' END || noun || '.' AS a_examples, CASE a WHEN 'candidate' THEN 't,u' ELSE 's' END AS b_synonyms, CASE a WHEN 'candidate' THEN 'كلب' ELSE 'قط' END AS b_translations FROM i""")
def blind_package(spark, sf):
    told = packages.blind_package(_items(spark, sf), "id", "EV", "blind")[0]
    return told.select("eval_id", "lemma", F.col("armA.definition").alias("a_definition"), F.array_join("armA.examples", ",").alias("a_examples"), F.array_join("armB.relations.synonyms", ",").alias("b_synonyms"), F.col("armB.translations").alias("b_translations"))


@query(_ITEMS_SQL + " SELECT printf('EV-%04d', n) AS eval_id, CASE a WHEN 'candidate' THEN 'A' ELSE 'B' END AS candidate_side, id AS candidate_key FROM i")
def blind_map(spark, sf):
    return packages.blind_package(_items(spark, sf), "id", "EV", "blind")[1]


@query(_ITEMS_SQL + " SELECT printf('EV-%04d', n) AS eval_id, true AS opens, true AS whole FROM i")
def judge_prompts(spark, sf):
    told = packages.judge_prompts(packages.blind_package(_items(spark, sf), "id", "EV", "blind")[0], "RUBRIC", "JUDGE the two sides below; answer with one JSON object.")
    view = F.substring_index("prompt", "\n", -1)
    return told.select("eval_id", F.startswith("prompt", F.lit("RUBRIC\n\nJUDGE")).alias("opens"), (F.array_join(F.json_object_keys(view), ",") == "armA,armB,eval_id,lemma,pos").alias("whole"))


@query(_ITEMS_SQL + " SELECT printf('EV-%04d', n) AS eval_id, 'EXP-2026' AS leaks FROM i WHERE id % 10 = 4")
def leaking_items(spark, sf):
    rows = _items(spark, sf).withColumn("lemma", F.when(F.col("id") % 10 == 4, F.concat("lemma", F.lit(" EXP-2026"))).otherwise(F.col("lemma")))
    return packages.leaking_items(packages.blind_package(rows, "id", "EV", "blind")[0]).withColumn("leaks", F.array_join("leaks", ","))


@query(f"""WITH p AS ({_WORDS_SQL}) SELECT 'GEN-CAND-' || id AS key, '{{"key":"GEN-CAND-' || id || '","request":{{"contents":[{{"role":"user","parts":[{{"text":"Say {{pos}} ' || noun || ' (' || pos || ', ' || level || ', ' || id || ')"}}]}}],"generationConfig":{{"maxOutputTokens": 64, "temperature": 0.2}}}}}}' AS line FROM p""")
def envelopes(spark, sf):
    w = _words(spark, sf)
    master = w.select("id", F.concat(F.lit("{pos} "), "noun").alias("lemma"), "pos")
    return packages.envelopes(w.select("id", F.concat(F.lit("{pos} "), "noun").alias("lemma"), "pos", F.col("level").alias("cefr")), master, "id", "Say {lemma} ({pos}, {cefr}, {id})", "GEN", {"temperature": 0.2, "maxOutputTokens": 64})


@query("""SELECT doc_id, '{"model":{"lang":"' || lang || '"},"run":{"source":"' || source || '"},"integrity":{"output_hash":"' || sha256(source) || '","status":"ok"}}' AS record FROM documents""")
def generation_records(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.struct("lang").alias("model"), F.struct("source").alias("run"), F.col("source").alias("out"), F.lit("ok").alias("status"))
    return packages.generation_records(d, "doc_id", {"model": ["lang"], "run": ["source"]}, "out", "status", ["ok", "partial", "failed"])


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END::INT AS attempts, CASE WHEN event_id % 4 < 2 THEN 'A' || event_id END AS answer FROM events WHERE event_type <> 'view'""")
def remaining_runs(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("prompt"))
    tries: dict[str, int] = {}

    def generate(prompt):
        tries[prompt] = tries.get(prompt, 0) + 1
        n = int(prompt[1:]) % 4
        if n == 1 and tries[prompt] < 2:
            raise TimeoutError
        return "" if n == 2 else "x" if n == 3 else f"A{prompt[1:]}"

    return packages.run_remaining(e, e.where("event_type = 'view'"), "event_id", "prompt", generate, lambda a: a.startswith("A"))


@query("""WITH c AS (SELECT lang || '/' || source AS cell, count(*) AS size FROM documents GROUP BY 1), e AS (SELECT *, 300 * size / (SELECT sum(size) FROM c)::DOUBLE AS exact FROM c), b AS (SELECT *, least(floor(exact), size)::BIGINT AS base FROM e),
r AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN base < size THEN exact - base END DESC NULLS LAST, cell DESC) AS n FROM b)
SELECT cell, size, base + CASE WHEN base < size AND n <= least(300, (SELECT sum(size) FROM c)) - (SELECT sum(base) FROM b) THEN 1 ELSE 0 END AS quota FROM r""")
def proportional_allocation(spark, sf):
    sizes = table(spark, sf, "documents").groupBy(F.concat_ws("/", "lang", "source").alias("cell")).agg(F.count(F.lit(1)).alias("size"))
    return sampling.proportional(sizes, "cell", "size", 300)


@query("""WITH c AS (SELECT doc_id FROM documents WHERE doc_id % 4 = 1), f AS (SELECT doc_id, n_chars > 6000 AS long, coalesce(md5('sw:' || doc_id), '') AS k, doc_id % 4 = 1 AS inn FROM documents),
h AS (SELECT count(*) FILTER (inn AND long) AS have FROM f), w AS (SELECT greatest(0, least(have + 12 - have, (SELECT count(*) FROM f WHERE long AND NOT inn), (SELECT count(*) FROM f WHERE inn AND NOT long))) AS n FROM h WHERE have < 100000),
i AS (SELECT doc_id, row_number() OVER (ORDER BY k, doc_id) AS r FROM f WHERE long AND NOT inn), o AS (SELECT doc_id, row_number() OVER (ORDER BY k, doc_id) AS r FROM f WHERE inn AND NOT long)
SELECT doc_id FROM c WHERE doc_id NOT IN (SELECT doc_id FROM o, w WHERE r <= n) UNION ALL SELECT doc_id FROM i, w WHERE r <= n""")
def swapped_sample(spark, sf):
    d = table(spark, sf, "documents").withColumn("long", F.col("n_chars") > 6000)
    have = d.where("doc_id % 4 = 1 and long").count()
    return sampling.swapped_in(d.where("doc_id % 4 = 1"), d, "doc_id", {"long": have + 12}, "sw")


@query(f"""WITH p AS ({_WORDS_SQL}), m AS (SELECT lower(word) AS w, count(DISTINCT pos) > 1 AS multi FROM p GROUP BY 1)
SELECT id, CASE WHEN pos IN ('noun', 'verb', 'adj', 'adv') THEN pos ELSE 'function' END AS pos_group, multi AS multi_pos, id % 3 = 0 AS translations_multi, (id % 4 + (id % 5 > 0)::INT)::INT AS relations_total, id % 4 + (id % 5 > 0)::INT <= 2 AS relations_poor, id % 6 = 0 AS mnemonic_null, length(word) AS definition_len FROM p JOIN m ON lower(word) = m.w""")
def sampling_features(spark, sf):
    i = F.col("id")
    some = F.slice(F.array(*map(F.lit, "abc")), F.lit(1), (i % 4).cast("int"))
    rows = _words(spark, sf).select("id", "word", "pos", some.alias("synonyms"), F.when(i % 5 > 0, F.array(F.lit("x"), F.lit(" "))).alias("antonyms"), F.when(i % 3 == 0, "a، b").otherwise("ab").alias("translations"), F.when(i % 6 == 0, " ").otherwise("m").alias("mnemonic"), F.col("word").alias("definition"))
    told = sampling.sampling_features(rows, "word", "pos", ["synonyms", "antonyms"], "؛;/،,", 2)
    return told.select("id", "pos_group", "multi_pos", "translations_multi", "relations_total", "relations_poor", "mnemonic_null", "definition_len")


@query("""WITH e AS (SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN 'candidate' WHEN 1 THEN 'legacy' WHEN 2 THEN 'cannot-judge' END AS v, CASE event_id % 3 WHEN 0 THEN 'llm_changed' WHEN 1 THEN 'legacy_preserved' ELSE 'null' END AS s, event_id % 5 = 0 AS b FROM events),
t AS (SELECT id, [CASE WHEN v IN ('candidate', 'legacy') THEN 'translations=' || concat_ws('+', v, CASE s WHEN 'llm_changed' THEN 'changed' WHEN 'legacy_preserved' THEN 'preserved' END) END, CASE WHEN b OR s = 'legacy_preserved' OR v = 'candidate' THEN 'relations=' || concat_ws('+', CASE WHEN b THEN 'emptied' END, CASE WHEN s = 'legacy_preserved' THEN 'legacy_preserved' END, CASE WHEN v = 'candidate' THEN 'candidate' END) END,
  CASE WHEN v = 'cannot-judge' OR b THEN 'sense_separation=' || concat_ws('+', CASE WHEN v = 'cannot-judge' THEN 'abstain' END, CASE WHEN b THEN 'multi_pos' END) END, CASE WHEN v IS NOT NULL THEN 'examples=' || concat_ws('+', v, CASE WHEN b THEN 'critical_related' END) END,
  CASE WHEN v IN ('candidate', 'legacy') AND s = 'llm_changed' THEN 'definition_arabic=semantic_change+' || v END, CASE WHEN s IN ('llm_changed', 'null') THEN 'mnemonic=' || concat_ws('+', s, CASE WHEN b THEN 'indirect' END) END] AS x FROM e)
SELECT id, array_to_string(list_sort(list_filter(x, lambda q: q IS NOT NULL)), ';') AS strata FROM t""")
def reviewer_eligibility(spark, sf):
    i = F.col("event_id")
    v = F.when(i % 4 == 0, "candidate").when(i % 4 == 1, "legacy").when(i % 4 == 2, "cannot-judge")
    s = F.when(i % 3 == 0, "llm_changed").when(i % 3 == 1, "legacy_preserved").otherwise("null")
    of = lambda names, x: F.create_map(*[y for n in names for y in (F.lit(n), x)])
    told = sampling.eligibility(of(["translations", "relations", "sense_separation", "examples", "definition"], v), of(["translations", "synonyms", "antonyms", "collocations", "definition_en", "explanation_ar", "mnemonic"], s), i % 5 == 0, i % 5 == 0, i % 5 == 0, i % 5 == 0)
    said = F.transform(F.map_entries(told), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], "+")))
    return table(spark, sf, "events").select(i.alias("id"), F.array_join(F.sort_array(said), ";").alias("strata"))


@query(f"""WITH p AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 9 = 0 THEN ' ' ELSE ' ' || p_name END AS w, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS pos, CASE WHEN p_partkey % 5 = 0 THEN 'D1' ELSE {_LEVEL_SQL} END AS lv FROM part)
SELECT id, lower(trim(w)) AS normalized, 0.0::DOUBLE AS frequency, NULL AS reason FROM p WHERE trim(w) <> '' AND pos IS NOT NULL AND lv <> 'D1' UNION ALL
SELECT id, NULL, NULL, CASE WHEN pos IS NULL THEN 'missing part of speech' ELSE 'bad level' END FROM p WHERE trim(w) <> '' AND (pos IS NULL OR lv = 'D1')""")
def staged_import(spark, sf):
    i = F.col("p_partkey")
    size = F.col("p_size")
    level = F.when(i % 5 == 0, "D1").when(size <= 8, "A1").when(size <= 16, "A2").when(size <= 25, "B1").when(size <= 33, "B2").when(size <= 41, "C1").otherwise("C2")
    rows = table(spark, sf, "part").select(i.alias("id"), F.when(i % 9 == 0, " ").otherwise(F.concat(F.lit(" "), "p_name")).alias("w"), F.when(i % 7 != 0, F.col("p_type")).alias("pos"), level.alias("lv"), F.lit(None).cast("int").alias("frequency"))
    fine, not_fine = quality.imported(rows, "w", "pos", "lv", ["A1", "A2", "B1", "B2", "C1", "C2"], {"frequency": 0.0})
    return fine.select("id", "normalized", "frequency", F.lit(None).cast("string").alias("reason")).unionByName(not_fine.select("id", "reason"), allowMissingColumns=True)


@query(_BALLOT_SQL + ", m AS (SELECT count(*) FILTER (status = 'agree') AS agree, count(*) FILTER (status = 'flip') AS flip, count(*) FILTER (status = 'abstain') AS abstain, count(*) FILTER (status = 'mismatch') AS mismatch FROM s) SELECT *, round(agree / nullif(agree + flip + mismatch, 0), 4) AS ratio FROM m")
def overall_agreement(spark, sf):
    return adjudication.overall_agreement(_ballots(spark, sf), "status")


@query("""WITH j AS (SELECT conv_id, conv_id % 3 AS f FROM conversations), n AS (SELECT count(*) AS n FROM j) SELECT unnest(['key', 'error', 'response']) AS key, unnest([count(*), count(*) FILTER (f = 0), count(*) FILTER (f > 0)]) AS n, round(unnest([count(*), count(*) FILTER (f = 0), count(*) FILTER (f > 0)]) / count(*), 4) AS share FROM j""")
def envelope_presence(spark, sf):
    n = F.col("conv_id") % 3
    line = F.when(n == 0, F.to_json(F.struct(F.col("conv_id").alias("key"), F.lit("e").alias("error")))).otherwise(F.to_json(F.struct(F.col("conv_id").alias("key"), F.lit("r").alias("response"))))
    return batch.envelope_presence(table(spark, sf, "conversations").select(line.alias("line")), "line", ["key", "error", "response"])


@query("SELECT conv_id::VARCHAR AS key, count(*) AS n FROM conversations GROUP BY conv_id HAVING count(*) > 1")
def repeated_line_keys(spark, sf):
    return batch.repeated_line_keys(table(spark, sf, "conversations").select(F.to_json(F.struct(F.col("conv_id").alias("key"))).alias("line")), "line", "key")


@query(f"""WITH p AS ({_WORDS_SQL}), s AS (SELECT id, level, CASE WHEN id % 6 = 0 THEN 'x' ELSE (id % 11)::VARCHAR END AS score FROM p)
SELECT id, score FROM s WHERE NOT coalesce(try_cast(score AS DOUBLE) BETWEEN CASE level WHEN 'A1' THEN 2 WHEN 'A2' THEN 3 WHEN 'B1' THEN 4 WHEN 'B2' THEN 5 WHEN 'C1' THEN 7 ELSE 8 END AND CASE level WHEN 'A1' THEN 5 WHEN 'A2' THEN 6 WHEN 'B1' THEN 7 WHEN 'B2' THEN 7 WHEN 'C1' THEN 9 ELSE 10 END, false)""")
def scores_out_of_bounds(spark, sf):
    w = _words(spark, sf).withColumn("score", F.when(F.col("id") % 6 == 0, "x").otherwise((F.col("id") % 11).cast("string")))
    return levels.out_of_bounds(w, "score", "level", "pos", "rank", "noun").select("id", "score")


@query("""SELECT '## ' || n_name || chr(10) || '- key: ' || n_nationkey || CASE WHEN n_regionkey > 1 THEN chr(10) || '- region: ' || n_regionkey ELSE '' END AS card, n_nationkey FROM nation""")
def markdown_cards(spark, sf):
    return table(spark, sf, "nation").select(files.card(F.col("n_name"), {"key": F.col("n_nationkey"), "region": F.when(F.col("n_regionkey") > 1, F.col("n_regionkey"))}).alias("card"), "n_nationkey")


@query("""SELECT doc_id, '<section><h2>' || coalesce(replace(replace(replace(replace(source, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '') || '</h2><ul>' || coalesce('<li><b>language</b> ' || lang || '</li>', '') || coalesce('<li><b>text</b> ' || nullif(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '') || '</li>', '') || '</ul></section>' AS card FROM documents""")
def html_cards(spark, sf):
    return table(spark, sf, "documents").select("doc_id", files.html_card(F.col("source"), {"language": F.col("lang"), "text": F.col("text")}).alias("card"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS c_name, CASE WHEN c_custkey % 4 = 0 THEN 'moved' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def updated_columns(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    changes = c.where("c_custkey % 4 = 0").select("c_custkey", F.lit(None).cast("string").alias("c_name"), F.lit("moved").alias("c_mktsegment"))
    return files.updated(c, changes, "c_custkey", ["c_name", "c_mktsegment"])


@query("""SELECT doc_id, coalesce(trim(regexp_replace(lower(CASE WHEN doc_id % 3 = 0 THEN NULL ELSE ' ' || source || '  X' END), '\\s+', ' ', 'g')), '') AS normal, doc_id % 3 = 0 OR doc_id % 5 = 0 AS empty FROM documents""".replace("\\\\", "\\"))
def loose_texts(spark, sf):
    i = F.col("doc_id")
    x = F.when(i % 3 != 0, F.concat(F.lit(" "), "source", F.lit("  X")))
    return table(spark, sf, "documents").select("doc_id", F.coalesce(T.norm(x), F.lit("")).alias("normal"), V.is_empty(F.when(i % 5 == 0, "[]").otherwise(x)).alias("empty"))


@query("""SELECT event_id, event_id % 3 <> 1 AS same FROM events""")
def equal_values(spark, sf):
    i, kind = F.col("event_id"), F.col("event_type")
    a = F.when(i % 3 == 0, F.concat(F.lit('["'), kind, F.lit('","b"]'))).otherwise(kind)
    b = F.when(i % 3 == 0, F.concat(F.lit('["'), kind, F.lit('", "b"]'))).when(i % 3 == 1, F.concat(kind, F.lit(" "))).otherwise(kind)
    return table(spark, sf, "events").select("event_id", T.value_equal(a, b).alias("same"))


@query(f"""WITH p AS ({_WORDS_SQL}), u AS (SELECT level, noun AS unit, count(*) AS n FROM p GROUP BY ALL) SELECT level, unit, row_number() OVER (ORDER BY level, unit) AS position FROM u""")
def plain_unit_path(spark, sf):
    u = _words(spark, sf).groupBy("level", F.col("noun").alias("unit")).agg(F.count(F.lit(1)).alias("n")).withColumn("none", F.lit(0))
    return levels.order_units(u, "level", {"plain": "none"}, "unit").select("level", "unit", "position")


@query("""WITH v AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) SELECT doc_id, 'card' AS kind, 'A-better' AS definition, 'unjudged' AS examples FROM v WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 'unknown', NULL, NULL FROM v WHERE doc_id % 2 = 1""")
def recorded_verdicts(spark, sf):
    v = table(spark, sf, "labels").where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    said = v.withColumns({f: F.when(F.lit(f) == "definition", "A-better") for f in contracts.FIELDS})
    known, lost = packages.recorded_verdicts(said, "doc_id", contracts.FIELDS, v.where("doc_id % 2 = 0"))
    return known.select("doc_id", F.lit("card").alias("kind"), F.col("fields.definition").alias("definition"), F.col("fields.examples").alias("examples")).unionByName(lost.withColumn("kind", F.lit("unknown")), allowMissingColumns=True)


@query(f"""WITH p AS ({_WORDS_SQL}),
x AS (SELECT id, id % 11 AS f, id % 3 AS n, id % 4 AS u, id % 5 AS m, CASE WHEN id % 2 = 0 THEN 'old' ELSE ' ' END AS om, CASE WHEN id % 7 < 3 THEN 'uk' END AS ok FROM p),
r AS (SELECT *, CASE f WHEN 0 THEN 'json_parse_failed' WHEN 1 THEN 'schema_failed' WHEN 2 THEN 'wrong_word' WHEN 3 THEN 'wrong_pos' WHEN 4 THEN 'missing_required' WHEN 5 THEN 'invalid_enum' ELSE 'pass' END AS result, om = 'old' AS hm, ok IS NOT NULL AS hu, m = 1 AS nm, u <> 0 AS nu FROM x)
SELECT id, result, CASE WHEN result = 'pass' THEN CASE WHEN u = 0 THEN 0.8 ELSE 1.0 END::DOUBLE END AS structural,
  CASE WHEN result = 'pass' THEN ((u NOT IN (0, 3))::INT + 1 + 1 + (n = 0)::INT) / 4 END AS completeness,
  CASE WHEN result = 'pass' THEN CASE WHEN hm OR hu THEN ((hm AND nm)::INT + (hu AND nu)::INT) / (hm::INT + hu::INT) ELSE 1.0 END::DOUBLE END AS preservation,
  CASE WHEN result = 'pass' THEN CASE WHEN (hm AND NOT nm) OR (hu AND NOT nu) THEN 1.0 ELSE 0.0 END::DOUBLE END AS loss,
  CASE WHEN result = 'pass' THEN concat_ws(',', CASE WHEN NOT hm AND nm THEN 'mnemonic_ar' END, CASE WHEN NOT hu AND nu THEN 'phonetic_uk' END, CASE WHEN n > 0 THEN 'senses +' || n END) END AS additions FROM r""")
def machine_evaluation(spark, sf):
    i, w, p = F.col("id"), F.col("noun"), F.col("pos")
    f, n, u = i % 11, (i % 3).cast("int"), i % 4
    one = F.when(f == 5, '{"register": "odd", "definition_en": "a long one"}').otherwise('{"register": "", "primary_sense": null, "definition_en": "a long one"}')
    more = F.when(n > 0, F.concat(F.lit(', {"definition_en": "short"}'))).otherwise("")
    last = F.when(n > 1, ', {"definition_en": null}').otherwise("")
    mnemonic = F.when(i % 5 == 1, ', "mnemonic_ar": "m"').otherwise("")
    first = F.concat(F.expr("left(x, length(x) - 1)"), mnemonic, F.lit("}"))
    senses = F.when(f == 4, "[]").otherwise(F.concat(F.lit("["), first, more, last, F.lit("]")))
    us = F.when(u == 0, "").when(u == 3, '"phonetic_us": "", ').otherwise('"phonetic_us": "x", ')
    uk = F.when(u == 3, '"phonetic_uk": "y", ').otherwise('"phonetic_uk": " ", ')
    raw = F.when(f == 0, "{x").when(f == 1, "[1]").otherwise(F.concat(F.lit('{"lemma": "'), F.when(f == 2, "other").otherwise(w), F.lit('", "pos": "'), F.when(f == 3, "other").otherwise(p), F.lit('", '), us, uk, F.lit('"phonetic_ar": "a", "senses": '), senses, F.lit("}")))
    rows = _words(spark, sf).withColumn("x", one)
    told = rows.select("id", artifacts.machine_evaluation(raw, w, p, F.when(i % 2 == 0, "old").otherwise(" "), F.when(i % 7 < 3, "uk")).alias("e"))
    return told.select("id", "e.result", "e.structural", "e.completeness", "e.preservation", "e.loss", F.array_join("e.additions", ",").alias("additions"))


@query("""WITH s AS (SELECT doc_id, unnest(string_split(text, '. ')) AS s, generate_subscripts(string_split(text, '. '), 1) AS i FROM documents), b AS (SELECT *, len(regexp_extract_all(s, '\\S+')) AS n FROM s),
l AS (SELECT doc_id, CASE WHEN n <= 6 THEN 'A1' WHEN n <= 9 THEN 'A2' WHEN n <= 13 THEN 'B1' WHEN n <= 18 THEN 'B2' WHEN n <= 24 THEN 'C1' ELSE 'C2' END AS band, s, i FROM b)
SELECT doc_id, band, count(*)::INT AS n, md5(string_agg(s, '|' ORDER BY i)) AS sentences FROM l GROUP BY doc_id, band""".replace("\\\\", "\\"))
def sentences_by_band(spark, sf):
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", F.explode(T.by_band(F.split("text", r"\. "))).alias("band", "s"))
    return d.select("doc_id", "band", F.size("s").alias("n"), F.md5(F.array_join("s", "|")).alias("sentences"))


@query("""SELECT event_type, count(DISTINCT event_id) AS n, count(DISTINCT user_id) AS users, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def streamed_first_events(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    drop = scratch(spark, "drops")
    e.unionByName(e.where("event_id % 5 = 0")).write.json(f"{drop}/in")  # some events arrive twice
    kind = "event_id long, user_id long, event_type string, value double, ts timestamp"
    arriving = drops.read_drops(spark, f"{drop}/in", kind, 1)
    drops.land_first(arriving, f"{drop}/out", f"{drop}/state", "event_id", "ts").awaitTermination()
    return drops.read_first(spark, f"{drop}/out", kind).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("total"))
