"""Queries over loose values and whole records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import records
from .base import table
from .queries import _WORDS_SQL, _words, query


@query("""WITH x AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN ' 0' || p_partkey WHEN 1 THEN 'x' || p_partkey ELSE p_name END AS raw, CASE p_partkey % 4 WHEN 0 THEN '100% ' || p_name ELSE p_name END AS p FROM part)
SELECT p_partkey, coalesce(try_cast(trim(raw) AS BIGINT)::VARCHAR, raw) AS value, replace(p, '%', '%%') AS escaped FROM x""")
def loose_values(spark, sf):
    i = F.col("p_partkey")
    raw = F.when(i % 3 == 0, F.concat(F.lit(" 0"), i.cast("string"))).when(i % 3 == 1, F.concat(F.lit("x"), i.cast("string"))).otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", V.maybe_int(raw).alias("value"), V.escape_percent(F.when(i % 4 == 0, F.concat(F.lit("100% "), "p_name")).otherwise(F.col("p_name"))).alias("escaped"))


@query("""WITH x AS (SELECT p_partkey, p_name || '☆ abc ☆' || p_type || ' ' AS x FROM part)
SELECT p_partkey, array_to_string(list_filter([trim(p) for p in string_split(x, '☆')], lambda p: length(p) > 4), '|') AS parts FROM x""")
def star_parts(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.array_join(V.star_parts(F.concat("p_name", F.lit("☆ abc ☆"), "p_type", F.lit(" "))), "|").alias("parts"))


@query("""WITH x AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '{"A1": "' || event_type || '", "B1": "' || user_id || '"}' WHEN 1 THEN '["' || event_type || '", "b"]' WHEN 2 THEN '{broken' WHEN 3 THEN '[1, "a"]' END AS x FROM events),
v AS (SELECT event_id, CASE WHEN json_valid(x) THEN x END AS x FROM x)
SELECT event_id, CASE WHEN json_type(x) = 'OBJECT' THEN array_to_string([k || '=' || (x ->> k) for k in json_keys(x)], ';') WHEN json_type(x) = 'ARRAY' AND len(list_filter(json_extract(x, '$[*]'), lambda e: json_type(e) <> 'VARCHAR')) = 0 THEN array_to_string(['=' || (e ->> '$') for e in json_extract(x, '$[*]')], ';') ELSE '' END AS examples FROM v""")
def example_parser(spark, sf):
    i, kind = F.col("event_id"), F.col("event_type")
    x = F.when(i % 5 == 0, F.format_string('{"A1": "%s", "B1": "%s"}', "event_type", F.col("user_id").cast("string"))).when(i % 5 == 1, F.concat(F.lit('["'), kind, F.lit('", "b"]'))).when(i % 5 == 2, "{broken").when(i % 5 == 3, '[1, "a"]')
    told = F.transform(V.examples(x), lambda e: F.concat(F.coalesce(e["level"], F.lit("")), F.lit("="), e["text"]))
    return table(spark, sf, "events").select("event_id", F.array_join(told, ";").alias("examples"))


@query("""WITH x AS (SELECT p_partkey, [p_name, 'عين', upper(p_name), 'قمر', p_type, 'عين'] AS xs FROM part),
s AS (SELECT p_partkey, list_filter(xs, lambda x: NOT regexp_matches(x, '[؀-ۿ]')) AS en, list_filter(xs, lambda x: regexp_matches(x, '[؀-ۿ]')) AS ar FROM x)
SELECT p_partkey, array_to_string(list_filter(en, lambda x, i: list_position([lower(y) for y in en], lower(x)) = i)[:6], '|') AS en, array_to_string(list_filter(ar, lambda x, i: list_position([lower(y) for y in ar], lower(x)) = i)[:6], '|') AS ar FROM s""")
def bilingual_split(spark, sf):
    told = V.by_script(F.array(F.col("p_name"), F.lit("عين"), F.upper("p_name"), F.lit("قمر"), F.col("p_type"), F.lit("عين")))
    return table(spark, sf, "part").select("p_partkey", told.alias("x")).select("p_partkey", F.array_join("x.en", "|").alias("en"), F.array_join("x.ar", "|").alias("ar"))


@query("""WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)
SELECT p_partkey, array_to_string(list_sort(list_distinct([w[1] || ' ' || w[2], w[1] || 's ' || w[2], w[1] || ' ' || w[2] || 's'])), '|') AS variants FROM w""")
def phrase_variants(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.sort_array(T.phrase_variants(F.col("p_name"), lambda w: F.array(w, F.concat(w, F.lit("s"))))), "|").alias("variants"))


@query("""SELECT doc_id, concat_ws(',', CASE WHEN quality IS NULL THEN 'label.quality' END, CASE WHEN lang IS NULL THEN 'document.lang' END, CASE WHEN nullif(toxic, 0) IS NULL THEN 'document.toxic' END) AS missing FROM documents LEFT JOIN labels USING (doc_id)""")
def provenance_gaps(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    d = d.select("doc_id", F.struct("quality").alias("label"), F.struct("lang", F.nullif("toxic", F.lit(0)).alias("toxic")).alias("document"))
    return d.select("doc_id", F.array_join(records.missing_fields({"label": ["quality"], "document": ["lang", "toxic"]}), ",").alias("missing"))


@query("""WITH g AS (SELECT l_orderkey, count(*) AS n, min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(DISTINCT l_linenumber) AS k, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)
SELECT l_orderkey, n, concat_ws(',', CASE WHEN lo <> 1 OR hi <> n OR k <> n THEN 'NOT_SEQUENTIAL' END, CASE WHEN r <> 1 THEN 'PRIMARY_COUNT' END) AS codes FROM g WHERE lo <> 1 OR hi <> n OR k <> n OR r <> 1""")
def sequence_defects(spark, sf):
    told = records.sequence_defects(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", F.col("l_returnflag") == "R")
    return told.select("l_orderkey", "n", F.array_join("codes", ",").alias("codes"))


@query("""WITH a AS (SELECT o_orderkey AS k, 1 + o_orderkey % 3 AS in_a FROM orders), b AS (SELECT l_orderkey AS k, count(*) AS in_b FROM lineitem GROUP BY 1)
SELECT k, coalesce(in_a, 0) AS in_a, coalesce(in_b, 0) AS in_b FROM a FULL JOIN b USING (k) WHERE coalesce(in_a, 0) <> coalesce(in_b, 0)""")
def count_parity(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.explode(F.sequence(F.lit(0), (F.col("o_orderkey") % 3).cast("int")))).select("k")
    return records.parity(a, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query(f"""WITH p AS ({_WORDS_SQL}), m AS (SELECT level, pos = 'noun' AS new, avg(zipf) AS zipf, count(*)::DOUBLE AS n FROM p WHERE pos IN ('noun', 'verb') GROUP BY ALL),
l AS (SELECT level, new, 'zipf' AS metric, zipf AS v FROM m UNION ALL SELECT level, new, 'n', n FROM m)
SELECT level, metric, round(a.v, 6) AS before, round(b.v, 6) AS after, round(b.v - a.v, 6) AS change FROM (SELECT * FROM l WHERE NOT new) a FULL JOIN (SELECT * FROM l WHERE new) b USING (level, metric)""")
def metric_changes(spark, sf):
    m = _words(spark, sf).groupBy("level", "pos").agg(F.avg("zipf").alias("zipf"), F.count(F.lit(1)).alias("n"))
    told = records.metric_changes(m.where("pos = 'verb'"), m.where("pos = 'noun'"), "level", ["zipf", "n"])
    return told.select("level", "metric", F.round("before", 6).alias("before"), F.round("after", 6).alias("after"), "change")


@query("""SELECT user_id, bool_or(event_type = 'click') AS click, bool_or(event_type = 'error') AS error, bool_or(event_type = 'click') AND bool_or(event_type = 'error') AS complete FROM events GROUP BY 1""")
def phases_per_key(spark, sf):
    return records.phases(table(spark, sf, "events"), "user_id", "event_type", ["click", "error"])


@query("""WITH m AS (SELECT max(c_custkey) AS m FROM customer WHERE c_nationkey < 10) SELECT c_custkey, printf('ID-%04d', (m + row_number() OVER (ORDER BY c_custkey))::INT) AS id FROM customer, m WHERE c_nationkey >= 10""")
def allocated_ids(spark, sf):
    c = table(spark, sf, "customer")
    held = c.where("c_nationkey < 10").select(F.format_string("ID-%04d", "c_custkey").alias("id"))
    return records.next_ids(c.where("c_nationkey >= 10").select("c_custkey"), held, "id", "c_custkey", "ID")


@query("""WITH k AS (SELECT c_custkey::VARCHAR AS x, row_number() OVER (ORDER BY c_custkey::VARCHAR) - 1 AS i FROM customer),
g AS (SELECT i // 4096 AS r, sha256(string_agg(x, chr(10) ORDER BY i)) AS h FROM k GROUP BY 1)
SELECT (SELECT count(*) FROM k) AS n, CASE WHEN count(*) = 1 THEN min(h) ELSE sha256(string_agg(h, chr(10) ORDER BY r)) END AS sha256 FROM g""")
def selection_hash(spark, sf):
    return records.selection_hash(table(spark, sf, "customer"), "c_custkey")


@query("""WITH o AS (SELECT conv_id, count(*) AS turns, max(role) AS who FROM conversations WHERE turn < 2 GROUP BY 1), n AS (SELECT conv_id, count(*) AS turns, min(role) AS who FROM conversations WHERE turn >= 2 GROUP BY 1)
SELECT conv_id, 'legacy' AS arm, turns::VARCHAR AS turns, who FROM o WHERE conv_id IN (SELECT conv_id FROM n) UNION ALL SELECT conv_id, 'candidate', turns::VARCHAR, who FROM n WHERE conv_id IN (SELECT conv_id FROM o)""")
def neutral_arms(spark, sf):
    c = table(spark, sf, "conversations")
    old = c.where("turn < 2").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.max("role").alias("who"))
    new = c.where("turn >= 2").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.min("role").alias("who"))
    return records.arms(old, new, "conv_id", ["turns", "who"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber = 2 THEN 'key' WHEN l_discount = 0 THEN 'value' WHEN l_returnflag = 'N' THEN 'pin 1' END AS problem FROM lineitem""")
def observation_checks(spark, sf):
    li = table(spark, sf, "lineitem")
    key = F.when(F.col("l_linenumber") == 2, "broken").otherwise(F.concat_ws("/", F.col("l_partkey").cast("string"), F.lit("noun")))
    value = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    told = records.observations(li, key, value, [F.when(F.col("l_returnflag") == "N", " ").otherwise(F.col("l_returnflag")), F.col("l_linestatus")])
    return told.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "problem")


@query(f"""WITH p AS ({_WORDS_SQL}) SELECT id, CASE WHEN pos <> 'other' AND NOT contains(noun, ' ') THEN noun || '/' || pos END AS key, 'sha256:' || sha256(coalesce(nullif(pos, 'verb'), 'null')) AS cell FROM p""")
def identity_keys(spark, sf):
    w = _words(spark, sf)
    return w.select("id", T.identity_key(F.concat(F.lit(" "), F.initcap("noun")), F.upper("pos")).alias("key"), T.cell_hash(F.nullif("pos", F.lit("verb"))).alias("cell"))


@query(r"""WITH x AS (SELECT doc_id, '```json' || chr(10) || '{"lang": "' || lang || '"}' || chr(10) || '``` ' AS x FROM documents)
SELECT doc_id, trim(regexp_replace(regexp_replace(trim(x), '^```[a-zA-Z]*\s*', ''), '\s*```$', '')) AS inner_text FROM x""")
def stripped_fences(spark, sf):
    fenced = F.concat(F.lit('```json\n{"lang": "'), "lang", F.lit('"}\n``` '))
    return table(spark, sf, "documents").select("doc_id", T.strip_fences(fenced).alias("inner_text"))
