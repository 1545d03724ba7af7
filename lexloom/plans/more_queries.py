"""Further queries over the star tables: contracts, cohorts, record formats, relational surface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cohorts, contracts, ranking
from ..sources import files
from .base import table
from .queries import _WORDS_SQL, _words, query


@query("""SELECT e.user_id AS id, arg_max(props, event_id) AS body FROM events e GROUP BY e.user_id""")
def prediction_log(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    lines = e.select(F.concat(F.lit("CAND-"), F.col("user_id").cast("string")).alias("key"), F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```")).alias("text"), "event_id")
    return files.predictions(lines, "key", "text", "event_id")


@query("""SELECT n_nationkey, '{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}' AS raw_json, sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') AS source_hash FROM nation""")
def lineage_rows(spark, sf):
    return files.with_lineage(table(spark, sf, "nation")).select("n_nationkey", "raw_json", "source_hash")


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey < 500 UNION ALL SELECT c_custkey, lower(c_name) FROM customer WHERE c_custkey >= 500""")
def insert_or_ignore(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return files.insert_new(c.where("c_custkey < 500"), c.withColumn("c_name", F.lower("c_name")), ["c_custkey"])


@query("""SELECT l_orderkey, l_quantity FROM lineitem WHERE l_orderkey % 4 <> 0 UNION ALL SELECT l_orderkey, -1.0 FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 4 = 0)""")
def replaced_children(spark, sf):
    old = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    return files.replace_children(old, old.where("l_orderkey % 4 = 0").select("l_orderkey", F.lit(-1.0).alias("l_quantity")).distinct(), "l_orderkey")


@query("""WITH c AS (SELECT o_orderkey, [CASE WHEN o_totalprice > 1000 THEN 'pass' ELSE 'fail' END, CASE WHEN o_orderpriority LIKE '1%' THEN 'pass' ELSE 'fail' END, CASE WHEN o_orderstatus IN ('F', 'O') THEN 'pass' ELSE 'fail' END] AS s FROM orders)
SELECT o_orderkey, concat_ws(',', CASE WHEN s[1] = 'fail' THEN 'price' END, CASE WHEN s[2] = 'fail' THEN 'priority' END, CASE WHEN s[3] = 'fail' THEN 'status' END) AS failed FROM c""")
def candidate_contract(spark, sf):
    told = contracts.checks({"price": F.col("o_totalprice") > 1000, "priority": F.col("o_orderpriority").startswith("1"), "status": F.col("o_orderstatus").isin("F", "O")})
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(contracts.failed(told), ",").alias("failed"))


@query(f"""WITH p AS ({_WORDS_SQL}), s AS (SELECT id, CASE WHEN pos = 'prep' THEN 'NO_POS' WHEN level = 'C2' THEN 'NO_LEVEL' END AS stop,
  concat_ws(',', CASE WHEN zipf < 1000 THEN 'CHEAP' END, CASE WHEN noun LIKE 'r%' THEN 'R_WORD' END) AS err, concat_ws(',', CASE WHEN rank % 3 = 0 THEN 'THIRD' END, CASE WHEN level = 'A1' THEN 'EASY' END) AS flg FROM p)
SELECT id, CASE WHEN stop IS NOT NULL OR err <> '' THEN 'ERROR' WHEN flg <> '' THEN 'FLAG' ELSE 'PASS' END AS status, coalesce(stop, nullif(err, ''), flg) AS codes FROM s""")
def artifact_status(spark, sf):
    told = contracts.staged_status(
        {"NO_POS": F.col("pos") == "prep", "NO_LEVEL": F.col("level") == "C2"},
        {"CHEAP": F.col("zipf") < 1000, "R_WORD": F.col("noun").startswith("r")},
        {"THIRD": F.col("rank") % 3 == 0, "EASY": F.col("level") == "A1"},
    )
    return _words(spark, sf).select("id", told.alias("s")).select("id", "s.status", F.array_join("s.codes", ",").alias("codes"))


@query(f"""WITH p AS ({_WORDS_SQL}), v AS (SELECT id, CASE id % 5 WHEN 0 THEN 'sense_separation' ELSE noun END AS field, CASE WHEN rank % 2 = 0 THEN 'candidate' ELSE 'legacy' END AS verdict, CASE WHEN id % 3 = 0 THEN ' ' ELSE word END AS value, zipf > 1400 AS loss, level < 'B2' AS more FROM p)
SELECT id, CASE WHEN field = 'sense_separation' THEN 'manual' WHEN verdict <> 'candidate' OR trim(value) = '' THEN 'keep' ELSE 'promote' END AS action,
  CASE WHEN verdict = 'candidate' AND NOT loss THEN 'REGENERATE' WHEN verdict = 'candidate' THEN 'MANUAL_REVIEW' WHEN more THEN 'ENRICH' ELSE 'KEEP_LEGACY' END AS disposition FROM v""")
def promotion_actions(spark, sf):
    i, verdict = F.col("id"), F.when(F.col("rank") % 2 == 0, "candidate").otherwise("legacy")
    field, value = F.when(i % 5 == 0, "sense_separation").otherwise(F.col("noun")), F.when(i % 3 == 0, " ").otherwise(F.col("word"))
    return _words(spark, sf).select("id", contracts.promotion(field, verdict, value).alias("action"), contracts.disposition(verdict, F.col("zipf") > 1400, F.col("level") < "B2").alias("disposition"))


_LEAK_SQL = ", ".join(f"regexp_extract_all(x, '(?i){shape}')" for shape in contracts.LEAKS)


@query(rf"""WITH t AS (SELECT item_id, text || CASE item_id % 5 WHEN 0 THEN ' PILOT-V1-CAND-' || item_id || ' and exp-2026' WHEN 1 THEN ' run-A1-B Gemini-2.5 model, a seed' WHEN 2 THEN ' at 2.2.3 ' || md5(item_id::VARCHAR) WHEN 3 THEN ' Pilot_Manifest output_hash' ELSE ' the legacy model and its baseline' END AS x FROM benchmark)
SELECT item_id, array_to_string(list_sort(list_distinct(flatten([{_LEAK_SQL}]))), ',') AS words FROM t""")
def blind_leaks(spark, sf):
    n, i = F.col("item_id") % 5, F.col("item_id").cast("string")
    more = F.when(n == 0, F.concat(F.lit(" PILOT-V1-CAND-"), i, F.lit(" and exp-2026"))).when(n == 1, " run-A1-B Gemini-2.5 model, a seed").when(n == 2, F.concat(F.lit(" at 2.2.3 "), F.md5(i))).when(n == 3, " Pilot_Manifest output_hash").otherwise(" the legacy model and its baseline")
    return table(spark, sf, "benchmark").select("item_id", F.array_join(F.sort_array(contracts.leaks(F.concat("text", more))), ",").alias("words"))


@query(f"""WITH p AS ({_WORDS_SQL}) SELECT id, round(((id % 2 = 0)::INT + (id % 3 = 0)::INT + (id % 5 = 0)::INT + 2) / 5, 6) AS structural,
  round(((length(noun) > 3)::INT + (length(word) > 9)::INT + (length(noun) > 5 OR length(word) > 5)::INT + (length(noun) > 5 AND length(word) > 5)::INT) / 4, 6) AS completeness,
  round(CASE WHEN id % 2 = 0 OR id % 7 > 2 THEN ((id % 2 = 0 AND id % 3 > 0)::INT + (id % 7 > 2 AND id % 5 > 0)::INT) / ((id % 2 = 0)::INT + (id % 7 > 2)::INT) ELSE 1 END, 6) AS preservation,
  CASE WHEN (id % 2 = 0 AND id % 3 = 0) OR (id % 7 > 2 AND id % 5 = 0) THEN 1.0 ELSE 0.0 END::DOUBLE AS loss FROM p""")
def machine_scores(spark, sf):
    i, noun, word = F.col("id"), F.col("noun"), F.col("word")
    yes = F.lit(True)
    told = contracts.machine_scores(
        F.array(i % 2 == 0, i % 3 == 0, i % 5 == 0, yes, yes),
        F.when(F.char_length(noun) > 3, noun).otherwise(""),
        F.when(F.char_length(word) > 9, word),
        F.array(noun, word),
        F.array(i % 2 == 0, i % 7 > 2),
        F.array(i % 3 > 0, i % 5 > 0),
    )
    return _words(spark, sf).select("id", told.alias("m")).select("id", *[F.round(f"m.{c}", 6).alias(c) for c in ("structural", "completeness", "preservation")], "m.loss")


@query("""WITH a AS (SELECT doc_id FROM documents WHERE lang = 'de' ORDER BY md5('co:' || doc_id), doc_id LIMIT 12),
b AS (SELECT doc_id FROM documents WHERE n_chars > 3000 AND doc_id NOT IN (SELECT doc_id FROM a) ORDER BY md5('co:' || doc_id), doc_id LIMIT 9),
c AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM a) AND doc_id NOT IN (SELECT doc_id FROM b) ORDER BY md5('co:' || doc_id), doc_id LIMIT 30 - (SELECT count(*) FROM a) - (SELECT count(*) FROM b))
SELECT doc_id, 'german' AS cohort FROM a UNION ALL SELECT doc_id, 'long' FROM b UNION ALL SELECT doc_id, 'rest' FROM c""")
def reviewer_cohorts(spark, sf):
    d = table(spark, sf, "documents")
    return cohorts.cohort_pick(d, "doc_id", [("german", F.col("lang") == "de", 12), ("long", F.col("n_chars") > 3000, 9), ("rest", F.lit(True), 9)], "co")


@query()
def greedy_quota_draw(spark, sf):
    d = table(spark, sf, "documents").withColumns({"long": F.col("n_chars") > 2000, "third": F.col("source") == "src3", "lined": F.contains("text", F.lit("\n"))})
    return cohorts.quota_draw(d, "doc_id", {"lang": {"en": 20, "de": 10, "fr": 5}, "source": {"src1": 12, "src2": 9, "src3": 14}}, {"long": 9, "third": 6, "lined": 12}, 35, "qd", F.length("text") > 15000)


@query(f"WITH p AS ({_WORDS_SQL}) SELECT id, word, pos FROM p WHERE word IN (SELECT word FROM p GROUP BY word HAVING count(DISTINCT pos) > 1)")
def same_word_other_pos(spark, sf):
    return cohorts.same_word_elsewhere(_words(spark, sf), "word", "pos").select("id", "word", "pos")


@query("""WITH h AS (SELECT nullif(p_name, 'new plate') AS uk, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS us, p_partkey FROM part)
SELECT p_partkey, coalesce(uk, us) AS ipa, CASE WHEN uk IS NOT NULL THEN 'dictionary' WHEN us IS NOT NULL THEN 'fallback_from_us' END AS source FROM h""")
def uk_ipa_fallback(spark, sf):
    told = T.uk_ipa(F.when(F.col("p_name") == "new plate", " ").otherwise(F.col("p_name")), F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")))
    return table(spark, sf, "part").select("p_partkey", told.alias("x")).select("p_partkey", "x.ipa", "x.source")


@query("""SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2""")
def hourly_windows(spark, sf):
    told = table(spark, sf, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))
    return told.select(F.col("w.start").alias("start"), "event_type", "n", "total")


@query("""WITH g AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, session::BIGINT AS session, count(*) AS n, min(ts) AS first_ts FROM s GROUP BY 1, 2""")
def sessions(spark, sf):
    own = Window.partitionBy("user_id").orderBy("ts", "event_id")
    fresh = F.when(F.col("ts") - F.lag("ts").over(own) <= F.expr("interval 30 minutes"), 0).otherwise(1)
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", fresh.alias("fresh"))
    e = e.withColumn("session", F.sum("fresh").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return e.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"))


@query("""SELECT l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus)::BIGINT AS g, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def cube_report(spark, sf):
    return table(spark, sf, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.grouping_id().cast("long").alias("g"), F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query(f"""WITH p AS ({_WORDS_SQL}) SELECT '- **' || noun || '** (' || string_agg(DISTINCT pos, ', ' ORDER BY pos) || '), ' || count(*) || ' entries' AS card, noun FROM p GROUP BY noun""")
def review_cards(spark, sf):
    told = _words(spark, sf).groupBy("noun").agg(F.array_join(F.sort_array(F.collect_set("pos")), ", ").alias("kinds"), F.count(F.lit(1)).alias("n"))
    return told.select(F.format_string("- **%s** (%s), %d entries", "noun", "kinds", "n").alias("card"), "noun")


@query("""WITH u AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT md5(line) AS line, count(*) AS n, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_doc FROM u WHERE length(trim(line, ' ')) > 4 GROUP BY 1 HAVING count(*) > 1""")
def shared_lines(spark, sf):
    u = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.char_length(F.trim("line")) > 4)
    per = u.groupBy(F.md5("line").alias("line"), "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("line").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc")).where("n > 1")


@query("""SELECT user_id, event_id, dense_rank() OVER (PARTITION BY event_type ORDER BY value DESC) AS rank FROM events""")
def dense_rank_by_scope(spark, sf):
    return ranking.dense_rank_in_scope(table(spark, sf, "events"), "event_type", "value").select("user_id", "event_id", F.col("rank").cast("long").alias("rank"))
