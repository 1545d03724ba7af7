"""Queries over joins with what belongs to a record, reports, gates, audits of runs and the migration protocol."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import adjudication, artifacts, audits, contracts, evidence, lookups, migration, protocol, quality, ranking, records, sampling
from .base import table
from .queries import _BALLOT_SQL, _WORDS_SQL, _ballots, _words, query


@query("""SELECT c_custkey, c_name, 'row' AS kind FROM customer WHERE c_custkey IN (SELECT s_suppkey * 7 FROM supplier) UNION ALL
SELECT k, NULL, 'missing' FROM (SELECT DISTINCT s_suppkey * 7 AS k FROM supplier) WHERE k NOT IN (SELECT c_custkey FROM customer)""")
def rows_by_ids(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    found, lost = lookups.by_ids(c, table(spark, sf, "supplier").select((F.col("s_suppkey") * 7).alias("c_custkey")), "c_custkey")
    return found.withColumn("kind", F.lit("row")).unionByName(lost.withColumn("kind", F.lit("missing")), allowMissingColumns=True)


@query(f"WITH p AS ({_WORDS_SQL}), m AS (SELECT word, min(id) AS id FROM p GROUP BY word) SELECT p.id, p.word, p.pos, p.level FROM p JOIN m USING (id, word)")
def first_row_per_word(spark, sf):
    return lookups.first_per_group(_words(spark, sf), "word", "id").select("id", "word", "pos", "level")


@query("SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'")
def children_of_run(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lookups.children_of_run(lines, table(spark, sf, "orders"), "l_orderkey", "o_orderkey", F.col("l_returnflag") == "R", ["o_custkey", "o_orderpriority"]).select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "o_orderpriority")


@query("""WITH g AS (SELECT c_custkey AS k, coalesce(CASE WHEN c_custkey % 5 = 0 THEN lower(c_mktsegment) END, c_mktsegment) AS gold_seg FROM customer WHERE c_custkey % 7 <> 1)
SELECT o_orderkey, o_custkey AS k, gold_seg FROM orders LEFT JOIN g ON o_custkey = g.k""")
def gold_with_corrections(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("k"))
    return lookups.with_overlay(rows, c.where("k % 7 <> 1"), c.where("k % 5 = 0").select("k", F.lower("seg").alias("seg")), "k", ["seg"])


@query("""SELECT o_orderkey, o_custkey AS k, c_name AS customer_c_name, s_name AS supplier_s_name, s_acctbal AS supplier_s_acctbal FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN supplier ON s_suppkey = o_custkey""")
def chained_lookups(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("k"))
    customer = table(spark, sf, "customer").withColumnRenamed("c_custkey", "k")
    supplier = table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "k")
    return lookups.chained(rows, "k", {"customer": (customer, ["c_name"]), "supplier": (supplier, ["s_name", "s_acctbal"])})


@query("""WITH a AS (SELECT o_orderkey::VARCHAR AS id, o_orderstatus AS s, o_totalprice AS v FROM orders WHERE o_orderkey % 3 > 0), b AS (SELECT l_orderkey::VARCHAR AS id, max(l_linestatus) AS s, sum(l_quantity) AS v FROM lineitem GROUP BY 1)
SELECT id, a.s AS s_a, b.s AS s_b, round(a.v, 2) AS v_a, round(b.v, 2) AS v_b FROM a JOIN b USING (id)""")
def reports_by_trailing_id(spark, sf):
    a = table(spark, sf, "orders").where("o_orderkey % 3 > 0").select(F.concat(F.lit("EXP-1-CAND-"), F.col("o_orderkey").cast("string")).alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("v"))
    b = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_linestatus").alias("s"), F.sum("l_quantity").alias("v"))
    b = b.select(F.concat(F.lit("BATCH-CAND-"), F.col("l_orderkey").cast("string")).alias("k"), "s", "v")
    return lookups.by_trailing_id(a, b, "k", "-CAND-", ["s", "v"]).select("id", "s_a", "s_b", F.round("v_a", 2).alias("v_a"), F.round("v_b", 2).alias("v_b"))


@query("""WITH m AS (SELECT c_custkey + CASE WHEN c_custkey % 9 = 0 THEN 10000000 ELSE 0 END AS k, CASE WHEN c_custkey % 4 = 0 THEN 'X' ELSE c_name END AS name, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer)
SELECT k, CASE WHEN c_custkey IS NULL THEN 'unknown' ELSE concat_ws(',', CASE WHEN name IS DISTINCT FROM c_name THEN 'name' END, CASE WHEN seg IS DISTINCT FROM c_mktsegment THEN 'seg' END) END AS problem FROM m LEFT JOIN customer ON c_custkey = k
WHERE c_custkey IS NULL OR name IS DISTINCT FROM c_name OR seg IS DISTINCT FROM c_mktsegment""")
def drifted_identities(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer")
    manifest = c.select((k + F.when(k % 9 == 0, 10000000).otherwise(0)).alias("k"), F.when(k % 4 == 0, "X").otherwise(F.col("c_name")).alias("name"), F.when(k % 6 != 0, F.col("c_mktsegment")).alias("seg"))
    return lookups.drifted_identities(manifest, c.select(k.alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg")), "k", ["name", "seg"])


@query(_BALLOT_SQL + """ SELECT lang, count(*) FILTER (decoded = 'candidate') AS candidate, count(*) FILTER (decoded = 'legacy') AS legacy, count(*) FILTER (decoded = 'tie') AS tie, count(*) FILTER (decoded = 'cannot-judge') AS "cannot-judge", count(*) FILTER (decoded = 'unjudged') AS unjudged FROM s GROUP BY lang""")
def field_wins(spark, sf):
    return lookups.wins(_ballots(spark, sf), "lang", "decoded")


@query(_BALLOT_SQL + """, v AS (SELECT nullif(machine, 'cannot-judge') AS verdict, count(*) AS n FROM s GROUP BY 1) SELECT verdict, n, round(n / (SELECT sum(n) FROM v), 4) AS share FROM v""")
def verdict_shares(spark, sf):
    return lookups.win_rates(_ballots(spark, sf).select(F.nullif("machine", F.lit("cannot-judge")).alias("verdict")), "verdict")


@query(_BALLOT_SQL + " SELECT lang, count(*) AS n, count(DISTINCT doc_id) AS cards FROM s WHERE status = 'flip' GROUP BY lang HAVING count(*) >= 3 AND count(DISTINCT doc_id) >= 3")
def systematic_flips(spark, sf):
    return adjudication.systematic(_ballots(spark, sf).where("status = 'flip'"), "lang", "doc_id")


@query("SELECT p_name, count(*) AS n, min(p_partkey) AS least, max(p_partkey) AS greatest FROM part GROUP BY 1 HAVING count(*) > 1")
def repeated_with_span(spark, sf):
    return lookups.repeated_with_span(table(spark, sf, "part"), "p_name", "p_partkey")


@query("""SELECT n_nationkey, n_name, n_regionkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers, (SELECT count(*) FILTER (c_acctbal < 0) FROM customer WHERE c_nationkey = n_nationkey) AS negative FROM nation""")
def totals_per_parent(spark, sf):
    return lookups.with_totals(table(spark, sf, "nation"), table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), "n_nationkey", {"customers": F.count(F.lit(1)), "negative": F.count_if(F.col("c_acctbal") < 0)})


@query("SELECT l_orderkey, l_suppkey, bool_or(coalesce(l_returnflag = 'R', false)) AS passed FROM lineitem GROUP BY ALL")
def outcomes_by_identity(spark, sf):
    return lookups.outcomes_by_identity(table(spark, sf, "lineitem").withColumn("ok", F.col("l_returnflag") == "R"), ["l_orderkey", "l_suppkey"], "ok")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events)
SELECT user_id, CASE WHEN value > 50 OR event_type = 'error' THEN 'fail' ELSE 'pass' END AS status, concat_ws(',', CASE WHEN event_type = 'error' THEN 'kind' END, CASE WHEN value > 50 THEN 'value' END) AS failed, md5(event_id::VARCHAR) AS prompt FROM r WHERE n = 1""")
def input_manifest(spark, sf):
    e = table(spark, sf, "events")
    told = F.create_map(F.lit("value"), F.when(F.col("value") > 50, "fail").otherwise("pass"), F.lit("kind"), F.when(F.col("event_type") == "error", "fail").otherwise("pass"))
    log = e.select("user_id", "event_id", told.alias("checks"), F.md5(F.col("event_id").cast("string")).alias("prompt"))
    return lookups.input_manifest(log, "user_id", "event_id", "checks", "prompt").withColumn("failed", F.array_join("failed", ","))


@query("""WITH h AS (SELECT nullif(p_name, 'new plate') AS uk, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS us FROM part) SELECT CASE WHEN uk IS NOT NULL THEN 'dictionary' WHEN us IS NOT NULL THEN 'fallback_from_us' ELSE 'missing' END AS source, count(*) AS n FROM h GROUP BY 1""")
def repair_sources(spark, sf):
    told = table(spark, sf, "part").select(T.uk_ipa(F.when(F.col("p_name") != "new plate", F.col("p_name")), F.when(F.col("p_partkey") % 2 == 0, F.col("p_type"))).alias("x"))
    return lookups.resolved_counts(told, "x.source")


@query(r"""WITH s AS (SELECT html AS b, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, 'https?://\S+', '', 'g'), '【[^】]*】', '', 'g'), '[†‡]', '', 'g'), '\s+', ' ', 'g')) AS a FROM pages)
SELECT count(*) FILTER (a IS DISTINCT FROM b) AS changed, count(*) FILTER (a IS NOT DISTINCT FROM b) AS unchanged FROM s""")
def repair_counts(spark, sf):
    return lookups.changed_counts(F.col("html"), T.strip_artifacts(F.col("html")), table(spark, sf, "pages"))


@query("""SELECT doc_id, concat_ws(',', CASE WHEN contains(text, '$') THEN 'text' END, CASE WHEN contains(source, '$') THEN 'source' END) AS fields FROM documents WHERE contains(text, '$') OR contains(source, '$')""")
def sign_accounting(spark, sf):
    return lookups.with_sign(table(spark, sf, "documents"), "doc_id", ["text", "source"], "$").withColumn("fields", F.array_join("fields", ","))


@query("""SELECT c_custkey FROM customer WHERE c_custkey % 10 = 3""")
def broken_seals(spark, sf):
    sealed = lookups.sealed(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey")
    return lookups.broken_seals(sealed.withColumn("c_name", F.when(F.col("c_custkey") % 10 == 3, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))), "c_custkey")


@query(r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g'))) AS kept FROM documents""")
def whitespace_keeping_lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(V.kept_lines(F.col("text"))).alias("kept"))


@query("SELECT p_partkey, p_brand || '__' || p_type AS stored FROM part")
def storage_keys(spark, sf):
    return table(spark, sf, "part").select("p_partkey", V.storage_key(F.concat_ws("/", "p_brand", "p_type")).alias("stored"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'a / ' || p_name WHEN 1 THEN p_name WHEN 2 THEN '{"ar":"x"}' END AS translations, CASE WHEN p_partkey % 3 = 0 THEN '["' || p_name || '"]' END AS synonyms, p_type AS mnemonic FROM part""")
def write_values(spark, sf):
    i, name = F.col("p_partkey"), F.col("p_name")
    t = F.when(i % 4 == 0, F.concat(F.lit('["a","'), name, F.lit('"]'))).when(i % 4 == 1, F.concat(F.lit('"'), name, F.lit('"'))).when(i % 4 == 2, '{"ar":"x"}').otherwise("null")
    raw = F.concat(F.lit('{"translations":'), t, F.lit(',"relations":{"synonyms":'), F.when(i % 3 == 0, F.concat(F.lit('["'), name, F.lit('"]'))).otherwise("null"), F.lit('},"mnemonic":"'), F.col("p_type"), F.lit('"}'))
    return table(spark, sf, "part").select("p_partkey", artifacts.write_value("translations", raw).alias("translations"), artifacts.write_value("relations_synonyms", raw).alias("synonyms"), artifacts.write_value("mnemonic", raw).alias("mnemonic"))


@query(f"""WITH p AS ({_WORDS_SQL}) SELECT id, unnest(['definition_en', 'examples[0]', 'examples[1]', 'usage']) AS field, unnest([word, noun, pos || ' ' || noun, level]) AS text FROM p WHERE id % 2 = 0 UNION ALL SELECT id, 'usage', level FROM p WHERE id % 2 = 1""")
def learner_texts(spark, sf):
    senses = F.when(F.col("id") % 2 == 0, F.array(F.struct(F.col("word").alias("definition_en"), F.lit("").alias("definition_ar"), F.array(F.col("noun"), F.concat_ws(" ", "pos", "noun")).alias("examples"))))
    return artifacts.learner_texts(_words(spark, sf).select("id", senses.alias("senses"), F.col("level").alias("usage"), F.lit(None).cast("string").alias("mnemonic")), "id", "senses", ["mnemonic", "usage"])


@query("""WITH r AS (SELECT event_id, event_id % 5 AS f FROM events) SELECT event_id, CASE WHEN f < 3 THEN 'failed' WHEN f = 3 THEN 'partial' ELSE 'ok' END AS status, CASE f WHEN 0 THEN 'infrastructure_empty_payload' WHEN 1 THEN 'infrastructure_empty_payload' WHEN 2 THEN 'unparseable_output' WHEN 3 THEN 'validator_findings' END AS failure_class FROM r""")
def answer_classes(spark, sf):
    f = F.col("event_id") % 5
    payload = lambda t: F.to_json(F.struct(F.array(F.struct(F.struct(F.array(F.struct(t.alias("text"))).alias("parts")).alias("content"))).alias("candidates")))
    response = F.when(f == 0, "{}").when(f == 1, payload(F.lit("  "))).when(f == 2, payload(F.lit("{x"))).when(f == 3, payload(F.lit('{"examples": []}'))).otherwise(payload(F.lit('{"examples": [1]}')))
    findings = lambda out: F.coalesce(F.json_array_length(F.get_json_object(out, "$.examples")) == 0, F.lit(True))
    return table(spark, sf, "events").select("event_id", artifacts.answer_class(response, findings).alias("r")).select("event_id", "r.*")


@query("""SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct([lower(x) for x in regexp_extract_all(source || ' ' || lang || ' and', '[A-Za-z]+')]), lambda w: NOT list_contains([lower(t) for t in regexp_extract_all(coalesce(text, ''), '[A-Za-z]+')], w))), ',') AS lacking FROM documents""")
def lemma_words_lacking(spark, sf):
    d = table(spark, sf, "documents").withColumn("lemma", F.concat_ws(" ", "source", "lang", F.lit("and")))
    return d.select("doc_id", F.array_join(F.sort_array(artifacts.structural_flags(d, "lemma", "text")), ",").alias("lacking"))


# ---- audits of runs

_STAGE_SQL = f"""WITH r AS (SELECT max(o_orderkey % 4) AS run FROM orders),
w AS (SELECT o_orderkey AS word_id, o_orderkey % 4 AS run_id, o_orderstatus, floor(o_totalprice)::INT AS v FROM orders),
s AS (SELECT l_orderkey AS word_id, l_orderkey * 10 + l_linenumber AS id, l_linestatus, l_returnflag, l_quantity::INT AS q FROM lineitem JOIN w ON l_orderkey = word_id, r WHERE run_id = run),
g AS (SELECT word_id, count(*) FILTER (l_linestatus = 'O') AS p FROM s GROUP BY 1),
c AS (SELECT word_id AS id, unnest([CASE WHEN o_orderstatus = 'P' THEN 'CATEGORY' END, CASE WHEN v % 5 = 0 THEN 'US_MISSING' WHEN v % 5 = 1 THEN 'US_SLASHES' END, CASE WHEN v % 7 = 0 THEN 'UK_SLASHES' END, CASE WHEN v % 6 = 0 THEN 'AR_MISSING' END, CASE WHEN p <> 1 THEN 'PRIMARY_COUNT' END]) AS code FROM g JOIN w USING (word_id)),
d AS (SELECT id, unnest([CASE WHEN q % 9 = 0 THEN 'DEFINITIONS' END, CASE WHEN l_returnflag = 'N' THEN 'REGISTER' END, CASE WHEN q % 5 = 0 THEN 'PRIMARY_SENSE' END, CASE WHEN q % 8 = 0 THEN 'BRACKETS' END, CASE WHEN q % 4 < 3 THEN 'TAGS' END, CASE WHEN id NOT IN (SELECT l_orderkey * 10 + l_linenumber FROM lineitem WHERE l_quantity::INT % 3 <> 0) THEN 'NO_LINEAGE' END]) AS code FROM s)"""


@query(_STAGE_SQL + " SELECT 'run' AS entity, run::BIGINT AS id, 'RUN_STATUS' AS code FROM r UNION ALL SELECT 'word', id, code FROM c WHERE code IS NOT NULL UNION ALL SELECT 'sense', id, code FROM d WHERE code IS NOT NULL")
def staging_audit(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    k, v, q = F.col("o_orderkey"), F.col("o_totalprice").cast("int"), F.col("l_quantity").cast("int")
    runs = o.select((k % 4).alias("id")).distinct().withColumn("status", F.when(F.col("id") == 3, "running").otherwise("completed"))
    words = o.select(k.alias("id"), F.when(F.col("o_orderstatus") == "P", "None").otherwise("Food & Drink").alias("category"))
    sounds = o.select(k.alias("word_id"), F.explode(F.array(F.struct(F.lit("us").alias("variant"), F.when(v % 5 == 0, "").when(v % 5 == 1, "/x/").otherwise("x").alias("ipa")), F.struct(F.lit("uk").alias("variant"), F.when(v % 7 == 0, "/y").alias("ipa")), F.struct(F.lit("ar").alias("variant"), F.when(v % 6 != 0, "ا").alias("ipa")))).alias("x")).select("word_id", "x.*")
    tags = F.when(q % 4 == 0, "{broken").when(q % 4 == 1, '["#a"]').when(q % 4 == 2, '["#a", "b", "#c"]').otherwise('["#a", "#b", "#c"]')
    senses = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("word_id"), (F.col("l_orderkey") % 4).alias("run_id"), F.col("l_linenumber").alias("sense_no"), (F.col("l_linestatus") == "O").alias("is_primary"),
        F.when(q % 9 == 0, "").otherwise("d").alias("definition_en"), F.lit("ت").alias("definition_ar"), F.lit("s").alias("short_def_en"), F.when(F.col("l_returnflag") == "N", "none").otherwise("Formal").alias("register"),
        F.when(q % 5 == 0, "Thing").otherwise("Object").alias("primary_sense"), F.when(q % 8 == 0, "a [b]").alias("mnemonic_ar"), tags.alias("semantic_tags"),
    )
    versions = li.where(q % 3 != 0).select(F.lit("sense").alias("entity_type"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("entity_id"))
    return audits.staging_audit(runs, words, senses, sounds, versions)


@query("""SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 3 = 0 THEN 'c_name' END, CASE WHEN c_custkey % 4 = 0 THEN 'c_mktsegment' END) AS mismatches FROM customer""")
def lock_mismatches(spark, sf):
    c, k = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), F.col("c_custkey")
    now = c.select(k, F.when(k % 3 == 0, "other").otherwise(F.col("c_name")).alias("c_name"), F.when(k % 4 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    return audits.lock_mismatches(c, now, "c_custkey", ["c_name", "c_mktsegment"]).withColumn("mismatches", F.array_join("mismatches", ","))


@query("""WITH e AS (SELECT unnest(['BUILDING', 'MACHINERY', 'NONE']) AS kind, unnest([300, 299, 2])::BIGINT AS expected), n AS (SELECT c_mktsegment AS kind, count(*) AS n FROM customer GROUP BY 1)
SELECT kind, coalesce(n, 0) AS n, coalesce(expected, 0) AS expected, coalesce(n, 0) = coalesce(expected, 0) AS ok FROM n FULL JOIN e USING (kind)""")
def quarantine_gate(spark, sf):
    return audits.quarantine_gate(table(spark, sf, "customer").select(F.col("c_mktsegment").alias("kind")), "kind", {"BUILDING": 300, "MACHINERY": 299, "NONE": 2})


@query("SELECT o_orderkey, 'approved_' || o_orderstatus AS state FROM orders WHERE o_orderstatus = 'P'")
def promotion_leaks(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("approved_"), "o_orderstatus")).otherwise("open").alias("state"))
    return audits.promotion_leaks(o, "o_orderkey", "state")


@query("""SELECT doc_id, concat_ws(',', CASE WHEN lang = 'fr' THEN 'missing run.lang' END, CASE WHEN source = 'src2' THEN 'bad status' END, CASE WHEN doc_id % 7 = 0 THEN 'hash mismatch' END) AS problems FROM documents""")
def provenance_problems(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.struct(F.nullif("lang", F.lit("fr")).alias("lang")).alias("run"), F.when(F.col("source") == "src2", "gone").otherwise("ok").alias("status"), F.col("source").alias("out"), F.when(F.col("doc_id") % 7 == 0, F.sha2(F.lit("x"), 256)).otherwise(F.sha2("source", 256)).alias("sha"))
    return d.select("doc_id", F.array_join(audits.provenance_problems({"run": ["lang"]}, "status", ["ok", "partial"], "out", "sha"), ",").alias("problems"))


@query("""SELECT 'rows' AS "check", 'customer' AS subject, true AS ok UNION ALL SELECT 'column', 'customer.c_name', true UNION ALL SELECT 'column', 'customer.c_rank', false UNION ALL SELECT 'rows', 'none', false""")
def preflight(spark, sf):
    c = table(spark, sf, "customer")
    return audits.preflight(spark, [], {"customer": c, "none": c.where("false")}, {"customer": ["c_name", "c_rank"]})


# ---- the migration protocol over the parts

_MIG_SQL = """WITH m AS (SELECT p_partkey, 'p_brand' AS field, p_brand AS v, CASE WHEN p_partkey % 5 = 0 THEN 'Brand#X' WHEN p_partkey % 5 = 1 THEN p_brand END AS after, p_partkey % 5 AS r FROM part WHERE p_partkey % 5 < 3
UNION ALL SELECT p_partkey + 10000000, 'p_type', NULL, 'x', 9 FROM part WHERE p_partkey % 50 = 0)"""


def _planned(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    i = F.col("p_partkey")
    brand = p.where(i % 5 < 3).select(i, F.lit("p_brand").alias("field"), F.when(i % 10 == 0, "old").otherwise(F.col("p_brand")).alias("before"), F.when(i % 5 == 0, "Brand#X").when(i % 5 == 1, F.col("p_brand")).alias("after"))
    return p, brand.unionByName(p.where(i % 50 == 0).select((i + 10000000).alias("p_partkey"), F.lit("p_type").alias("field"), F.lit(None).cast("string").alias("before"), F.lit("x").alias("after")))


@query(_MIG_SQL + """, k AS (SELECT (SELECT abs(count(*) - 100) FROM m) AS a, (SELECT count(*) FROM m WHERE r = 9) AS u, (SELECT count(*) FROM m WHERE r < 9 AND p_partkey % 10 = 0) AS d, (SELECT count(*) FROM m WHERE r < 9 AND p_partkey % 10 <> 0 AND after IS NULL) AS z, (SELECT count(*) FROM m WHERE r < 9 AND p_partkey % 10 <> 0 AND after = v) AS q, (SELECT count(*) FROM m WHERE field = 'p_type') AS p, (SELECT count(*) FROM m WHERE p_partkey < 50) AS x),
t AS (SELECT unnest(['count', 'twice', 'protected', 'excluded', 'unknown cell', 'drift', 'null value', 'no change']) AS "check", unnest([a, 0, p, x, u, d, z, q])::BIGINT AS n FROM k) SELECT *, n = 0 AS ok FROM t""")
def migration_checklist(spark, sf):
    p, changes = _planned(spark, sf)
    return protocol.checklist(changes, p, "p_partkey", 100, ["p_type"], p.where("p_partkey < 50").select("p_partkey"))


@query("""SELECT unnest(['unexpected change', 'missing change', 'row set', 'audit gap', 'audit surplus', 'rollback']) AS "check", 0::BIGINT AS n, true AS ok""")
def migration_dry_run(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    i = F.col("p_partkey")
    changes = p.where(i % 5 == 0).select(i, F.lit("p_brand").alias("field"), F.col("p_brand").alias("before"), F.when(i % 10 == 0, "Brand#X").alias("after"))
    return protocol.dry_run(p, changes, "p_partkey", ["p_brand", "p_type"])


@query("""WITH v AS (SELECT p_partkey, p_partkey % 10 = 3 AS odd, p_partkey % 10 = 5 AS lost FROM part)
SELECT unnest(['unexpected change', 'missing change', 'row set', 'audit gap', 'audit surplus']) AS "check", unnest([count(*) FILTER (odd), count(*) FILTER (lost), 0, count(*) FILTER (p_partkey % 20 = 10), 0])::BIGINT AS n, unnest([count(*) FILTER (odd), count(*) FILTER (lost), 0, count(*) FILTER (p_partkey % 20 = 10), 0]) = 0 AS ok FROM v""")
def migration_verification(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    i = F.col("p_partkey")
    changes = p.where(i % 5 == 0).select(i, F.lit("p_brand").alias("field"), F.col("p_brand").alias("before"), F.lit("Brand#X").alias("after"))
    after = p.withColumn("p_brand", F.when((i % 5 == 0) & (i % 10 != 5), "Brand#X").otherwise(F.col("p_brand"))).withColumn("p_type", F.when(i % 10 == 3, "odd").otherwise(F.col("p_type")))
    return protocol.verify(p, after, changes, migration.audit_rows(changes.where(i % 20 != 10), "p_partkey"), "p_partkey")


@query("""SELECT p_partkey, p_brand FROM part""")
def migration_rollback(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 > 0, F.col("p_brand")).alias("p_brand"))
    changes = p.select("p_partkey", F.lit("p_brand").alias("field"), F.col("p_brand").alias("before"), F.when(F.col("p_partkey") % 4 > 0, "new").alias("after"))
    back = migration.rolled_back(migration.apply_cells(p, changes, "p_partkey", ["p_brand"]), migration.audit_rows(changes, "p_partkey"), "p_partkey", ["p_brand"])
    return back.join(table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("_b")), "p_partkey").select("p_partkey", F.coalesce("p_brand", F.when(F.col("p_partkey") % 3 == 0, F.col("_b"))).alias("p_brand"))


@query("""WITH a AS (SELECT c_custkey, unnest(['definition', 'mnemonic', 'sense_separation', 'other']) AS f, unnest([CASE WHEN c_custkey % 3 = 0 THEN 'promote' ELSE 'keep' END, 'promote', 'promote', 'promote']) AS a, unnest([c_name, c_mktsegment, 'x', 'y']) AS v FROM customer WHERE c_custkey % 4 > 0)
SELECT c_custkey, CASE f WHEN 'definition' THEN 'definitionEn' ELSE 'mnemonicAr' END AS field, v AS after, 'sha256:' || sha256(v) AS after_sha FROM a WHERE a = 'promote' AND f IN ('definition', 'mnemonic')""")
def promotion_load(spark, sf):
    k = F.col("c_custkey")
    lit = lambda x: F.lit(x)
    actions = F.create_map(lit("definition"), F.when(k % 3 == 0, "promote").otherwise("keep"), lit("mnemonic"), lit("promote"), lit("sense_separation"), lit("promote"), lit("other"), lit("promote"))
    values = F.create_map(lit("definition"), F.col("c_name"), lit("mnemonic"), F.col("c_mktsegment"), lit("sense_separation"), lit("x"), lit("other"), lit("y"))
    manifest = table(spark, sf, "customer").select(k, actions.alias("actions"), values.alias("values"), (k % 4 == 0).alias("provenance_gap"))
    return protocol.load_promotions(manifest, "c_custkey", {"definition": "definitionEn", "mnemonic": "mnemonicAr"})


@query(f"WITH p AS ({_WORDS_SQL}) SELECT id, word, new_rank AS ranked_id FROM (SELECT id, word, row_number() OVER (ORDER BY zipf DESC, id) AS new_rank FROM p)")
def table_rebuilt_by_rank(spark, sf):
    ranked = ranking.global_position(_words(spark, sf).select("id", "word", "zipf"), [-F.col("zipf"), F.col("id")], "new_rank")
    return protocol.rebuilt_by_rank(ranked.withColumn("ranked_id", F.lit(0).cast("long")), "ranked_id", "new_rank").select("id", "word", "ranked_id")


@query("""WITH l AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) SELECT user_id, event_type, value, dense_rank() OVER (ORDER BY value DESC)::BIGINT AS rank FROM l WHERE n = 1""")
def ranked_observations(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "value", "event_id", F.lit("corpus").alias("source"), F.lit("v1").alias("version"))
    return ranking.ranked_observations(e, ["user_id", "event_type"], ["source", "version"], "value", "event_id").select("user_id", "event_type", "value", F.col("rank").cast("long").alias("rank"))


@query("""WITH s AS (SELECT lang || '/' || source AS cell, min(doc_id) AS doc_id FROM documents GROUP BY 1) SELECT * FROM s ORDER BY cell LIMIT 5""")
def smoke_pick(spark, sf):
    return sampling.smoke_pick(table(spark, sf, "documents").select(F.concat_ws("/", "lang", "source").alias("cell"), "doc_id"), "cell", "doc_id").select("cell", "doc_id")


@query("""WITH e AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1), g AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 0)
SELECT doc_id, doc_id IN (SELECT doc_id FROM g) AS in_low FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM e)""")
def exclusions_and_overlap(spark, sf):
    lab = table(spark, sf, "labels")
    kept = sampling.without(table(spark, sf, "documents").select("doc_id"), lab.where("toxic = 1"), "doc_id")
    return sampling.overlap(kept, {"low": lab.where("quality = 0")}, "doc_id")


@query("""SELECT item_id, 'unjudged' AS verdict, 7 AS fields, 7 AS sides FROM benchmark""")
def blank_ballots(spark, sf):
    b = table(spark, sf, "benchmark").select("item_id", contracts.blank_ballot().alias("b"))
    return b.select("item_id", F.array_join(F.array_distinct(F.map_values("b.fields")), ",").alias("verdict"), F.size("b.fields").alias("fields"), F.size("b.sides").alias("sides"))


@query(f"""WITH p AS ({_WORDS_SQL}), l AS (SELECT word, list_sort(list_distinct(list(pos))) AS kinds FROM p GROUP BY word) SELECT word, len(kinds) AS n, array_to_string(kinds, ',') AS kinds FROM l WHERE len(kinds) > 1""")
def multi_pos_words(spark, sf):
    told = _words(spark, sf).groupBy("word").agg(F.sort_array(F.collect_set("pos")).alias("kinds"))
    return told.where(F.size("kinds") > 1).select("word", F.size("kinds").cast("long").alias("n"), F.array_join("kinds", ",").alias("kinds"))


@query(f"""WITH p AS ({_WORDS_SQL}) SELECT count(*) AS n, round(corr(rank, zipf), 6) AS r_rank_price, round(corr(id % 9, length(word)), 6) AS r_other FROM p""")
def reproduction_overall(spark, sf):
    w = _words(spark, sf)
    return w.agg(F.count(F.lit(1)).alias("n"), F.round(F.corr("rank", "zipf"), 6).alias("r_rank_price"), F.round(F.corr(F.col("id") % 9, F.char_length("word")), 6).alias("r_other"))


@query("""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 = 1 EXCEPT ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal < 0""")
def change_set_difference(spark, sf):
    c = table(spark, sf, "customer")
    return c.where("c_custkey % 3 = 1").exceptAll(c.where("c_acctbal < 0"))


@query(f"""WITH p AS ({_WORDS_SQL}), k AS (SELECT word, unnest(['synonyms', 'mnemonic']) AS f, unnest(['candidate', CASE WHEN id % 2 = 0 THEN 'candidate' ELSE 'legacy' END]) AS v, unnest([noun, CASE WHEN id % 3 = 0 THEN '' ELSE pos END]) AS x, id FROM p)
SELECT id, array_to_string(list_sort(list(f || '=' || CASE WHEN v <> 'candidate' OR trim(x) = '' THEN 'keep' ELSE 'promote' END)), ',') AS actions, array_to_string(list_sort(list(f || '=' || CASE WHEN v = 'candidate' AND trim(x) <> '' THEN x ELSE '' END)), ',') AS vals FROM k GROUP BY id""")
def promotion_manifest(spark, sf):
    i = F.col("id")
    fields = F.array(F.struct(F.lit("synonyms").alias("f"), F.lit("candidate").alias("v"), F.col("noun").alias("x")), F.struct(F.lit("mnemonic").alias("f"), F.when(i % 2 == 0, "candidate").otherwise("legacy").alias("v"), F.when(i % 3 == 0, "").otherwise(F.col("pos")).alias("x")))
    items = _words(spark, sf).select("id", F.inline(fields))
    told = protocol.manifest_rows(items, "id", F.col("f"), F.col("v"), F.col("x"))
    said = lambda m: F.array_join(F.sort_array(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))), ",")
    return told.select("id", said("actions").alias("actions"), said("values").alias("vals"))


@query("SELECT count(*) AS n, sha256(string_agg(n_name || ':' || sha256(n_name), chr(10) ORDER BY n_name || ':' || sha256(n_name))) AS sha256 FROM nation")
def folder_hash(spark, sf):
    return lookups.folder_hash(table(spark, sf, "nation").select(F.col("n_name").alias("file"), F.sha2("n_name", 256).alias("sha256")))


@query("""SELECT c_custkey, c_nationkey, coalesce(c_mktsegment, '') AS seg FROM customer WHERE NOT (c_acctbal < 0 AND c_mktsegment = 'BUILDING') AND c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'BUILDING')""")
def cross_column_check(spark, sf):
    c = table(spark, sf, "customer")
    return c.where(~((F.col("c_acctbal") < 0) & (F.col("c_mktsegment") == "BUILDING"))).select("c_custkey", "c_nationkey", F.coalesce("c_mktsegment", F.lit("")).alias("seg"))


@query("""WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS pos, o_orderpriority AS lemma FROM orders) SELECT unnest(['lemma', 'pos']) AS field, unnest([count(*) FILTER (lemma IS NULL OR trim(lemma) = ''), count(*) FILTER (pos IS NULL)]) AS n_null FROM o""")
def seed_transport(spark, sf):
    o = records.transport(table(spark, sf, "orders"), {"o_orderkey": "id", "o_orderstatus": "pos", "o_orderpriority": "lemma"})
    return o.agg(F.count_if(F.col("lemma").isNull() | (F.trim("lemma") == "")).alias("lemma"), F.count_if(F.col("pos").isNull()).alias("pos")).select(F.explode(F.create_map(F.lit("lemma"), F.col("lemma"), F.lit("pos"), F.col("pos"))).alias("field", "n_null"))


@query("""SELECT 'one_returned_line' AS "check", l_orderkey::VARCHAR AS entity, count(*)::VARCHAR AS detail FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey HAVING count(*) > 1""")
def partial_unique(spark, sf):
    return quality.partial_unique(table(spark, sf, "lineitem"), ["l_orderkey"], F.col("l_returnflag") == "R", "one_returned_line")


@query("""WITH h AS (SELECT l_orderkey AS k, l_partkey AS t, 1 AS approved FROM lineitem WHERE l_returnflag = 'A'), n AS (SELECT DISTINCT l_orderkey AS k, l_partkey AS t FROM lineitem WHERE l_returnflag <> 'A')
SELECT k, t, approved FROM h UNION ALL SELECT k, t, 0 FROM n WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.k = n.k AND h.t = n.t)""")
def evidence_inserts(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("t"), F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("approved"))
    return evidence.with_evidence(li.where("approved = 1"), li.where("approved = 0"), ["k", "t"])


@query("""SELECT DISTINCT l_orderkey AS k, l_suppkey AS t FROM lineitem WHERE l_returnflag = 'A'""")
def approved_identities(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("t"), F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("approved"))
    return evidence.approved_identities(li, ["k", "t"], "approved")
