"""Queries over the star tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import adjudication, batch, evidence, levels, migration, quality, ranking, rules, sampling
from ..sources import files
from .base import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# The tables hold no words with levels and parts of speech; these stand in for them.
POS_OF_TYPE = {"STANDARD": "noun", "SMALL": "verb", "MEDIUM": "adj", "LARGE": "adv", "PROMO": "num", "ECONOMY": "prep"}
_POS_SQL = "CASE p_type WHEN 'STANDARD' THEN 'noun' WHEN 'SMALL' THEN 'verb' WHEN 'MEDIUM' THEN 'adj' WHEN 'LARGE' THEN 'adv' WHEN 'PROMO' THEN 'num' WHEN 'ECONOMY' THEN 'prep' ELSE 'other' END"
_LEVEL_SQL = "CASE WHEN p_size <= 8 THEN 'A1' WHEN p_size <= 16 THEN 'A2' WHEN p_size <= 25 THEN 'B1' WHEN p_size <= 33 THEN 'B2' WHEN p_size <= 41 THEN 'C1' ELSE 'C2' END"
_WORDS_SQL = "SELECT p_partkey AS id, p_name AS word, string_split(p_name, ' ')[-1] AS noun, p_retailprice AS zipf, p_partkey + 1 AS rank, " + _POS_SQL + " AS pos, " + _LEVEL_SQL + " AS level FROM part"


def _words(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    level = F.lit("C2")
    for most, name in ((41, "C1"), (33, "B2"), (25, "B1"), (16, "A2"), (8, "A1")):
        level = F.when(size <= most, name).otherwise(level)
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("word"),
        F.element_at(F.split("p_name", " "), -1).alias("noun"),
        F.col("p_retailprice").alias("zipf"),
        (F.col("p_partkey") + 1).alias("rank"),
        ranking.lookup(POS_OF_TYPE, F.col("p_type"), "other").alias("pos"),
        level.alias("level"),
    )


@query("""
WITH t AS (SELECT lang, unnest([lower(x) for x in regexp_extract_all(coalesce(text, ''), '[A-Za-z'']+')]) AS token FROM documents),
c AS (SELECT lang, token, count(*) AS n FROM t GROUP BY ALL),
z AS (SELECT lang, token, n, round(log10(n / (sum(n) OVER (PARTITION BY lang)) * 1e9), 6) AS zipf FROM c)
SELECT lang, token, n, zipf, dense_rank() OVER (PARTITION BY lang ORDER BY zipf DESC) AS rank FROM z
""")
def freq_zipf_dense_rank(spark, sf):
    words = table(spark, sf, "documents").select("lang", F.explode(T.tokens(F.col("text"))).alias("token"))
    return ranking.dense_rank_in_scope(ranking.word_frequency(words, "lang", "token"), "lang", "zipf")


@query("""
WITH d AS (SELECT lang, text, CASE lang WHEN 'en' THEN 'thing' WHEN 'fr' THEN 'avec' WHEN 'de' THEN 'nicht' ELSE 'una' END AS w FROM documents),
p AS (SELECT lang, list_contains([lower(x) for x in regexp_extract_all(coalesce(text, ''), '[A-Za-z'']+')], w) AS hit FROM d)
SELECT lang, count(*) AS n, count(*) FILTER (hit) AS present, round(count(*) FILTER (hit) / count(*), 6) AS rate FROM p GROUP BY lang
""")
def exact_token_rate(spark, sf):
    target = ranking.lookup({"en": "thing", "fr": "avec", "de": "nicht"}, F.col("lang"), "una")
    told = table(spark, sf, "documents").select("lang", T.contains_target(F.col("text"), target).alias("hit"))
    return told.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("present")).withColumn("rate", F.round(F.col("present") / F.col("n"), 6))


_CLOSURE_SQL = r"""list_filter([w,
  CASE WHEN pos IN ('noun','verb','num') THEN w || 's' END,
  CASE WHEN pos IN ('noun','verb','num') AND regexp_matches(w, '(s|x|z|ch|sh)$') THEN w || 'es' END,
  CASE WHEN pos IN ('noun','verb','num') AND cy THEN st || 'ies' END,
  CASE WHEN pos = 'verb' AND fe THEN w || 'd' END, CASE WHEN pos = 'verb' AND fe THEN st || 'ing' END,
  CASE WHEN pos = 'verb' AND NOT fe THEN w || 'ed' END, CASE WHEN pos = 'verb' AND NOT fe THEN w || 'ing' END,
  CASE WHEN pos = 'verb' AND cy THEN st || 'ied' END,
  CASE WHEN pos = 'verb' AND dbl THEN tw || 'ed' END, CASE WHEN pos = 'verb' AND dbl THEN tw || 'ing' END,
  CASE WHEN pos IN ('adj','adv') AND fe THEN w || 'r' END, CASE WHEN pos IN ('adj','adv') AND fe THEN w || 'st' END,
  CASE WHEN pos IN ('adj','adv') AND NOT fe THEN w || 'er' END, CASE WHEN pos IN ('adj','adv') AND NOT fe THEN w || 'est' END,
  CASE WHEN pos IN ('adj','adv') AND cy THEN st || 'ier' END, CASE WHEN pos IN ('adj','adv') AND cy THEN st || 'iest' END,
  CASE WHEN pos IN ('adj','adv') AND dbl THEN tw || 'er' END, CASE WHEN pos IN ('adj','adv') AND dbl THEN tw || 'est' END
], lambda f: f IS NOT NULL)"""


@query(f"""
WITH p AS ({_WORDS_SQL}),
s AS (SELECT id, pos, noun AS w, left(noun, -1) AS st, noun || right(noun, 1) AS tw, regexp_matches(noun, '[^aeiou]y$') AS cy,
             noun LIKE '%e' AS fe, regexp_matches(noun, '[^aeiou][aeiou][^aeiouwyx]$') AS dbl FROM p)
SELECT id, pos, w AS noun, array_to_string(list_sort(list_distinct({_CLOSURE_SQL})), '|') AS forms FROM s
""")
def inflection_closure(spark, sf):
    return _words(spark, sf).select("id", "pos", "noun", F.array_join(F.sort_array(T.lemma_closure(F.col("noun"), F.col("pos"))), "|").alias("forms"))


@query(r"""
WITH d AS (SELECT p_partkey AS id, p_name AS w, CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN 'The ' || p_name || '.' WHEN 2 THEN 'to ' || p_name
             WHEN 3 THEN 'The act of ' || p_name || 'ing' WHEN 4 THEN 'A kind of ' || p_name ELSE p_type END AS d FROM part),
n AS (SELECT id, d, trim(regexp_replace(lower(d), '[^a-z0-9]+', ' ', 'g')) AS x, trim(regexp_replace(lower(w), '[^a-z0-9]+', ' ', 'g')) AS w FROM d)
SELECT id, d AS definition, x IN (w, 'a ' || w, 'the ' || w, 'to ' || w, 'the act of ' || w, 'the act of ' || w || 'ing') AS circular FROM n
""")
def circular_definition_flags(spark, sf):
    n, w = F.col("p_partkey") % 6, F.col("p_name")
    text = (
        F.when(n == 0, w).when(n == 1, F.concat(F.lit("The "), w, F.lit("."))).when(n == 2, F.concat(F.lit("to "), w)).when(n == 3, F.concat(F.lit("The act of "), w, F.lit("ing"))).when(n == 4, F.concat(F.lit("A kind of "), w)).otherwise(F.col("p_type"))
    )
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), text.alias("definition"), T.is_circular(text, w).alias("circular"))


_ARTIFACT_SQL = r"""WITH d AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '【1†src】' || html WHEN 1 THEN html || ' [12]' ELSE url || ' ' || html END AS x FROM pages)"""


def _artifacts(spark, sf):
    n = F.col("page_id") % 4
    return table(spark, sf, "pages").select("page_id", F.when(n == 0, F.concat(F.lit("【1†src】"), "html")).when(n == 1, F.concat("html", F.lit(" [12]"))).otherwise(F.concat_ws(" ", "url", "html")).alias("x"))


@query(_ARTIFACT_SQL + r"""
SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, 'https?://\S+', '', 'g'), '【[^】]*】', '', 'g'), '[†‡]', '', 'g'), '\s+', ' ', 'g'))) AS stripped FROM d
""")
def strip_artifacts(spark, sf):
    return _artifacts(spark, sf).select("page_id", F.md5(T.strip_artifacts(F.col("x"))).alias("stripped"))


@query(_ARTIFACT_SQL + r"""
SELECT page_id, concat_ws(',', CASE WHEN regexp_matches(x, 'https?://\S') THEN 'URL' END, CASE WHEN regexp_matches(x, '【[^】]*】') THEN 'CITATION' END,
  CASE WHEN regexp_matches(x, '[†‡]') THEN 'DAGGER' END, CASE WHEN regexp_matches(x, '\[[0-9]+\]') THEN 'REFERENCE' END) AS codes FROM d
""")
def contamination_codes(spark, sf):
    return _artifacts(spark, sf).select("page_id", F.array_join(T.learner_text_defects(F.col("x")), ",").alias("codes"))


_TIE_SQL = "CASE pos WHEN 'det' THEN 1 WHEN 'pron' THEN 2 WHEN 'conj' THEN 3 WHEN 'prep' THEN 4 WHEN 'noun' THEN 5 WHEN 'verb' THEN 6 WHEN 'adj' THEN 7 WHEN 'adv' THEN 8 WHEN 'num' THEN 9 ELSE 10 END"
_RATIO_SQL = "CASE pos WHEN 'verb' THEN 1.0 WHEN 'prep' THEN 0.93 WHEN 'noun' THEN 0.88 WHEN 'adv' THEN 0.75 WHEN 'adj' THEN 0.7 WHEN 'num' THEN 0.65 ELSE 0.5 END"
_GAP_SQL = "CASE first(level) OVER w WHEN 'A1' THEN 100 WHEN 'A2' THEN 150 WHEN 'B1' THEN 200 WHEN 'B2' THEN 300 WHEN 'C1' THEN 400 WHEN 'C2' THEN 500 ELSE 200 END"


@query(f"WITH p AS ({_WORDS_SQL}) SELECT id, rank, row_number() OVER (ORDER BY zipf DESC, {_TIE_SQL}, rank) AS new_rank FROM p")
def global_rerank_tiebreak(spark, sf):
    return ranking.rerank_globally(_words(spark, sf), "zipf", "pos", "rank").select("id", "rank", "new_rank")


@query(f"""WITH p AS ({_WORDS_SQL}),
a AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY rank) AS k, row_number() OVER (PARTITION BY word ORDER BY {_RATIO_SQL} DESC, rank) AS n FROM p)
SELECT a.id, a.word, a.pos, a.rank, b.rank AS new_rank FROM a JOIN a b ON a.word = b.word AND a.n = b.k""")
def dup_group_reorder(spark, sf):
    return ranking.reorder_duplicates(_words(spark, sf), "word", "pos", "rank").select("id", "word", "pos", "rank", "new_rank")


@query(f"""WITH p AS ({_WORDS_SQL}),
k AS (SELECT id, rank, first(rank) OVER w + (row_number() OVER w - 1) * {_GAP_SQL} AS key FROM p WINDOW w AS (PARTITION BY word ORDER BY rank))
SELECT id, rank, row_number() OVER (ORDER BY key, rank) AS new_rank FROM k""")
def spaced_rerank(spark, sf):
    return ranking.space_copies(_words(spark, sf), "word", "level", "rank").select("id", "rank", "new_rank")


_SYLL_SQL = "greatest(1, len(regexp_extract_all(noun, '[aeiouy]+')) - CASE WHEN noun LIKE '%e' AND len(regexp_extract_all(noun, '[aeiouy]+')) > 1 THEN 1 ELSE 0 END + CASE WHEN regexp_matches(noun, '[^aeiouy]le$') THEN 1 ELSE 0 END)::INT"


@query(f"""WITH p AS ({_WORDS_SQL}), s AS (SELECT *, {_SYLL_SQL} AS syllables,
  CASE level WHEN 'A1' THEN 2 WHEN 'A2' THEN 3 WHEN 'B1' THEN 4 WHEN 'B2' THEN 5 WHEN 'C1' THEN 7 ELSE 8 END AS lo, CASE level WHEN 'A1' THEN 5 WHEN 'A2' THEN 6 WHEN 'B1' THEN 7 WHEN 'B2' THEN 7 WHEN 'C1' THEN 9 ELSE 10 END AS hi FROM p)
SELECT id, level, pos, noun, syllables, greatest(lo, least(hi, round_even(lo + (hi - lo) * (CASE WHEN rank <= 150 THEN 0.0 WHEN rank <= 400 THEN 0.3 WHEN rank <= 700 THEN 0.5 WHEN rank <= 1500 THEN 0.65 WHEN rank <= 4000 THEN 0.78 WHEN rank <= 7000 THEN 0.88 ELSE 1.0 END)::DOUBLE
  + (CASE pos WHEN 'num' THEN -0.5 WHEN 'adj' THEN 0.3 WHEN 'adv' THEN 0.3 WHEN 'prep' THEN 0.7 ELSE 0 END)::DOUBLE + (CASE WHEN syllables >= 5 THEN 1.0 WHEN syllables = 4 THEN 0.7 WHEN syllables = 3 THEN 0.4 WHEN syllables = 2 THEN 0.0 ELSE -0.5 END)::DOUBLE, 0)::INT))::INT AS difficulty FROM s""")
def difficulty_score(spark, sf):
    w = _words(spark, sf)
    return w.select("id", "level", "pos", "noun", T.syllables(F.col("noun")).alias("syllables"), levels.difficulty(F.col("level"), F.col("pos"), F.col("rank"), F.col("noun")).alias("difficulty"))


@query("""WITH c AS (SELECT c_mktsegment AS level, c_name AS word, min(c_custkey) AS r FROM customer GROUP BY ALL),
i AS (SELECT level, word, row_number() OVER (PARTITION BY level ORDER BY r, word) - 1 AS idx, count(*) OVER (PARTITION BY level) AS n FROM c),
k AS (SELECT *, ceil(n / 50)::BIGINT AS k FROM i)
SELECT level, word, idx, printf('%s_%02d', level, least(floor(idx / (n / k))::BIGINT + 1, k)) AS unit_id FROM k""")
def unit_assignment(spark, sf):
    return levels.assign_units(table(spark, sf, "customer"), "c_mktsegment", "c_name", "c_custkey").select(F.col("c_mktsegment").alias("level"), F.col("c_name").alias("word"), F.col("idx").cast("long").alias("idx"), "unit_id")


@query("""SELECT printf('%s_%02d', c_mktsegment, c_nationkey) AS unit, count(*) AS n_rows, count(DISTINCT lower(trim(c_name))) AS n_words, count(*) FILTER (c_acctbal < 0) AS negative, count(*) FILTER (c_acctbal >= 5000) AS high FROM customer GROUP BY 1""")
def unit_rollup(spark, sf):
    c = table(spark, sf, "customer").withColumn("unit", F.format_string("%s_%02d", "c_mktsegment", "c_nationkey"))
    return levels.rollup_units(c, "unit", "c_name", {"negative": F.col("c_acctbal") < 0, "high": F.col("c_acctbal") >= 5000})


@query(f"""WITH p AS ({_WORDS_SQL}), u AS (SELECT level, noun AS unit, count(*) AS n, count(*) FILTER (zipf > 1500) AS dear FROM p GROUP BY ALL),
l AS (SELECT *, CASE level WHEN 'A1' THEN 0 WHEN 'A2' THEN 1 WHEN 'B1' THEN 2 WHEN 'B2' THEN 3 WHEN 'C1' THEN 4 ELSE 5 END AS lv FROM u)
SELECT level, unit, n, dear, 'by_size' AS path, row_number() OVER (ORDER BY lv, -n, unit) AS position FROM l UNION ALL
SELECT level, unit, n, dear, 'by_dear' AS path, row_number() OVER (ORDER BY lv, -dear, unit) AS position FROM l""")
def curriculum_orderings(spark, sf):
    u = _words(spark, sf).groupBy("level", F.col("noun").alias("unit")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("zipf") > 1500).alias("dear"))
    return levels.order_units(u, "level", {"by_size": "n", "by_dear": "dear"}, "unit")


@query(f"WITH p AS ({_WORDS_SQL}) SELECT coalesce(level, 'all') AS level, count(*) AS n, count(*) FILTER (zipf > 1500) AS dear, count(*) FILTER (pos = 'noun') AS nouns FROM p GROUP BY ROLLUP (level)")
def level_crosstab(spark, sf):
    return levels.crosstab(_words(spark, sf), "level", {"dear": F.col("zipf") > 1500, "nouns": F.col("pos") == "noun"})


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0),
m AS (SELECT coalesce(a.k, b.k), a.k IS NOT NULL AS ia, b.k IS NOT NULL AS ib FROM a FULL JOIN b USING (k))
SELECT unnest(['both', 'only_a', 'only_b', 'either']) AS view, unnest([count(*) FILTER (ia AND ib), count(*) FILTER (ia AND NOT ib), count(*) FILTER (ib AND NOT ia), count(*)]) AS n FROM m""")
def membership_views(spark, sf):
    return evidence.membership(table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@query("""WITH w AS (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN upper(x) ELSE x END AS k FROM (SELECT p_partkey, p_name || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '/' || p_brand END AS x FROM part)),
m AS (SELECT lower(p_name || '/' || p_brand) AS f, count(*) AS n, min(p_partkey) AS id FROM part GROUP BY 1)
SELECT w.k AS key, coalesce(n, 0) AS matches, CASE WHEN n IS NULL THEN 'not found' WHEN n > 1 THEN 'ambiguous' ELSE 'ok' END AS status, CASE WHEN n = 1 THEN id END AS id FROM w LEFT JOIN m ON lower(w.k) = m.f""")
def identity_multiplicity(spark, sf):
    p = table(spark, sf, "part")
    full = F.concat_ws("/", "p_name", "p_brand")
    key = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(full)
    wanted = p.select(F.when(F.col("p_partkey") % 2 == 0, F.upper(key)).otherwise(key).alias("key")).distinct()
    master = p.select(full.alias("k"), F.col("p_partkey").alias("id"))
    return evidence.exactly_one(wanted.withColumnRenamed("key", "k"), master, "k", ["id"]).withColumnRenamed("k", "key")


_CASCADE_SQL = """WITH m AS (SELECT lower(p_name) AS lemma, p_type AS pos FROM part WHERE p_size <= 25 UNION SELECT lower(regexp_extract(p_name, '[a-z]+$')), p_type FROM part WHERE p_size <= 25),
u AS (SELECT lemma, list(DISTINCT pos) AS held FROM m GROUP BY lemma),
r AS (SELECT p_partkey AS id, CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN p_name WHEN 2 THEN regexp_extract(p_name, '^[a-z]+') ELSE regexp_extract(p_name, '[a-z]+$') END AS lemma, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN 'OTHER' ELSE p_type END AS pos FROM part),
c AS (SELECT r.id, r.lemma, r.pos, CASE WHEN trim(r.lemma) = '' THEN 'UNRESOLVED_MALFORMED' WHEN regexp_matches(trim(r.lemma), '\\s') THEN 'MULTIWORD' WHEN held IS NULL THEN 'NEW_SINGLE_WORD' WHEN r.pos IS NULL THEN 'NORMALIZED_LEMMA_EXACT' WHEN list_contains(held, r.pos) THEN 'NORMALIZED_LEMMA_POS_EXACT' ELSE 'SAME_LEMMA_DIFFERENT_POS' END AS class FROM r LEFT JOIN u USING (lemma))"""


def _cascade(spark, sf):
    p = table(spark, sf, "part")
    last, first, n = F.regexp_extract("p_name", "[a-z]+$", 0), F.regexp_extract("p_name", "^[a-z]+", 0), F.col("p_partkey")
    master = p.where("p_size <= 25").select(F.explode(F.array(F.lower("p_name"), F.lower(last))).alias("lemma"), F.col("p_type").alias("pos"))
    rows = p.select(n.alias("id"), F.when(n % 7 == 0, "").when(n % 7 == 1, F.col("p_name")).when(n % 7 == 2, first).otherwise(last).alias("lemma"), F.when(n % 5 == 1, "OTHER").when(n % 5 > 1, F.col("p_type")).alias("pos"))
    return evidence.cascade(rows, evidence.universe(master, "lemma", "pos"), "lemma", "pos")


@query(_CASCADE_SQL.replace("\\\\", "\\") + " SELECT * FROM c")
def cascade_classify(spark, sf):
    return _cascade(spark, sf)


@query(_CASCADE_SQL.replace("\\\\", "\\") + """ SELECT k AS class, count(id) AS n FROM (SELECT unnest(['UNRESOLVED_MALFORMED','MULTIWORD','NEW_SINGLE_WORD','NORMALIZED_LEMMA_EXACT','NORMALIZED_LEMMA_POS_EXACT','SAME_LEMMA_DIFFERENT_POS']) AS k) LEFT JOIN c ON c.class = k GROUP BY k""")
def cascade_counts(spark, sf):
    return evidence.class_counts(_cascade(spark, sf))


@query("""WITH r AS (SELECT o_orderkey, o_custkey AS a, o_orderpriority AS b, CASE o_orderkey % 3 WHEN 0 THEN 'exact' WHEN 1 THEN 'first' ELSE 'none' END AS tier FROM orders),
m AS (SELECT c_custkey AS a, CASE WHEN c_custkey % 2 = 0 THEN '5-LOW' ELSE '1-URGENT' END AS b, c_mktsegment AS segment FROM customer)
SELECT r.o_orderkey, r.a, r.b, tier, segment FROM r JOIN m ON r.a = m.a AND r.b = m.b WHERE tier = 'exact' UNION ALL
SELECT r.o_orderkey, r.a, r.b, tier, segment FROM r JOIN m ON r.a = m.a WHERE tier = 'first'""")
def tiered_evidence_join(spark, sf):
    n = F.col("o_orderkey") % 3
    r = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("a"), F.col("o_orderpriority").alias("b"), F.when(n == 0, "exact").when(n == 1, "first").otherwise("none").alias("tier"))
    m = table(spark, sf, "customer").select(F.col("c_custkey").alias("a"), F.when(F.col("c_custkey") % 2 == 0, "5-LOW").otherwise("1-URGENT").alias("b"), F.col("c_mktsegment").alias("segment"))
    return evidence.tiered_join(r, m, "tier", {"exact": ["a", "b"], "first": ["a"]}, ["segment"])


_ACCOUNT_SQL = """WITH e AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 10 <> 3),
l AS (SELECT l_orderkey AS k, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS line, l_quantity >= 50 AS bad, l_returnflag = 'R' AS failed FROM lineitem),
j AS (SELECT l.*, e.k IS NOT NULL AS known FROM l LEFT JOIN e USING (k)),
o AS (SELECT *, row_number() OVER (PARTITION BY k, NOT bad AND known ORDER BY line) AS nth FROM j),
c AS (SELECT line, k, CASE WHEN bad THEN 'malformed' WHEN NOT known THEN 'unknown' WHEN nth > 1 THEN 'duplicate' WHEN failed THEN 'failed' ELSE 'successful' END AS outcome FROM o)"""


def _lines(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    return ranking.global_position(table(spark, sf, "lineitem").select(*order, "l_returnflag"), [F.col(c) for c in order], "line")


@query(_ACCOUNT_SQL + """, s AS (SELECT count(*) FILTER (outcome = 'successful') AS successful, count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'duplicate') AS duplicate, count(*) FILTER (outcome = 'unknown') AS unknown, count(*) FILTER (outcome = 'malformed') AS malformed, (SELECT count(DISTINCT k) FROM e) AS expected FROM c)
SELECT *, successful + failed AS mapped, expected - successful - failed AS missing, expected - successful - failed + duplicate + unknown + malformed > 0 AS aborts FROM s""")
def batch_accounting(spark, sf):
    expected = table(spark, sf, "orders").where("o_orderkey % 10 <> 3").select(F.col("o_orderkey").alias("l_orderkey"))
    told = batch.account(_lines(spark, sf), expected, "l_orderkey", "line", F.col("l_quantity") >= 50, F.col("l_returnflag") == "R")
    return batch.accounting(told, expected, "l_orderkey")


@query("""WITH j AS (SELECT CASE WHEN conv_id % 3 = 0 THEN json_object('key', conv_id, 'error', role)::VARCHAR WHEN conv_id % 3 = 1 THEN json_object('response', text, 'key', conv_id)::VARCHAR ELSE json_object('key', conv_id, 'meta', json_object('a', 1), 'response', role)::VARCHAR END AS line FROM conversations)
SELECT array_to_string(list_sort(json_keys(line)), ',') AS shape, count(*) AS n FROM j GROUP BY 1""")
def envelope_histogram(spark, sf):
    c, n, key = table(spark, sf, "conversations"), F.col("conv_id") % 3, F.col("conv_id").alias("key")
    line = F.when(n == 0, F.to_json(F.struct(key, F.col("role").alias("error")))).when(n == 1, F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("response"), key))).otherwise(F.to_json(F.struct(key, F.struct(F.lit(1).alias("a")).alias("meta"), F.col("role").alias("response"))))
    return batch.envelope_shapes(c.select(line.alias("line")), "line")


@query("SELECT * FROM (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1".replace("SELECT *", "SELECT user_id, event_type, event_id, value", 1))
def latest_per_key(spark, sf):
    return ranking.latest_per_key(table(spark, sf, "events"), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "value")


@query("SELECT o_orderkey AS k, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def remaining_work(spark, sf):
    return batch.remaining(table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority"), table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query("""WITH n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events)
SELECT event_id, printf('%d_batch_%d', user_id, n // 10 + 1) AS batch_id, (n % 10 + 1)::INT AS ordinal FROM n""")
def micro_batches(spark, sf):
    e = table(spark, sf, "events").withColumn("scope", F.col("user_id").cast("string"))
    return batch.numbered_batches(e, "scope", "event_id", 10).select("event_id", "batch_id", "ordinal")


_SIDE_SQL = "CASE WHEN ('0x' || substr(md5('ab:' || {0}), 1, 1))::INT % 2 = 1 THEN 'candidate' ELSE 'legacy' END"


@query(f"SELECT item_id, {_SIDE_SQL.format('item_id')} AS a FROM benchmark")
def ab_side_assignment(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", sampling.side_of_a("ab", F.col("item_id")).alias("a"))


_BALLOT_SQL = f"""WITH b AS (SELECT doc_id, quality, toxic, {_SIDE_SQL.format('doc_id')} AS a, CASE WHEN doc_id % 10 = 7 THEN 'tie' WHEN quality = 1 THEN 'A' ELSE 'B' END AS verdict, CASE WHEN doc_id % 13 = 0 THEN 'cannot-judge' WHEN n_chars % 2 = 0 THEN 'candidate' ELSE 'legacy' END AS machine, lang FROM labels JOIN documents USING (doc_id)),
d AS (SELECT *, CASE verdict WHEN 'A' THEN a WHEN 'B' THEN CASE a WHEN 'candidate' THEN 'legacy' ELSE 'candidate' END ELSE verdict END AS decoded FROM b),
s AS (SELECT *, CASE WHEN decoded = machine THEN 'agree' WHEN decoded IN ('unjudged', 'cannot-judge') OR machine = 'cannot-judge' THEN 'abstain' WHEN decoded IN ('candidate', 'legacy') AND machine IN ('candidate', 'legacy') THEN 'flip' ELSE 'mismatch' END AS status FROM d)"""


def _ballots(spark, sf):
    i = F.col("doc_id")
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    rows = rows.select("doc_id", "lang", F.when(i % 10 == 7, "tie").when(F.col("quality") == 1, "A").otherwise("B").alias("verdict"), F.when(i % 13 == 0, "cannot-judge").when(F.col("n_chars") % 2 == 0, "candidate").otherwise("legacy").alias("machine"))
    sides = table(spark, sf, "labels").select("doc_id", sampling.side_of_a("ab", i).alias("a"))
    told = adjudication.decode(rows, sides, "doc_id", "verdict", "a")
    return told.withColumn("status", adjudication.agreement(F.col("decoded"), F.col("machine")))


@query(_BALLOT_SQL + " SELECT doc_id, verdict, decoded, machine, status FROM s")
def ballot_decode(spark, sf):
    return _ballots(spark, sf).select("doc_id", "verdict", "decoded", "machine", "status")


@query(_BALLOT_SQL + """, m AS (SELECT lang, count(*) FILTER (status = 'agree') AS agree, count(*) FILTER (status = 'flip') AS flip, count(*) FILTER (status = 'abstain') AS abstain, count(*) FILTER (status = 'mismatch') AS mismatch FROM s GROUP BY lang)
SELECT *, round(agree / nullif(agree + flip + mismatch, 0), 4) AS ratio FROM m""")
def agreement_matrix(spark, sf):
    return adjudication.agreement_matrix(_ballots(spark, sf), "lang", "status")


@query("""WITH a AS (SELECT DISTINCT doc_id, 'low' AS c FROM labels WHERE quality = 0), b AS (SELECT DISTINCT doc_id, 'low' AS c FROM labels WHERE toxic = 1)
SELECT (SELECT count(*) FROM a JOIN b USING (doc_id, c)) AS "both", (SELECT count(*) FROM a ANTI JOIN b USING (doc_id, c)) AS only_a, (SELECT count(*) FROM b ANTI JOIN a USING (doc_id, c)) AS only_b""")
def pair_overlap(spark, sf):
    lab = table(spark, sf, "labels")
    return adjudication.pair_overlap(lab.where("quality = 0").select("doc_id", F.lit("low").alias("c")), lab.where("toxic = 1").select("doc_id", F.lit("low").alias("c")))


_PRESERVE_SQL = r"""WITH t AS (SELECT conv_id, turn, role, CASE WHEN turn % 5 = 3 THEN '' ELSE text END AS old, CASE WHEN turn % 3 = 1 THEN text WHEN turn % 7 = 2 THEN '' ELSE lead(text) OVER (PARTITION BY conv_id ORDER BY turn, role, text) END AS new FROM conversations),
v AS (SELECT *, coalesce(trim(old, ' ') <> '', false) AS ho, coalesce(trim(new, ' ') <> '', false) AS hn, coalesce(len(old) > 60, false) AS ov, coalesce(len(new) > 60, false) AS nv,
  CASE turn % 6 WHEN 0 THEN 'replace' WHEN 1 THEN 'preserve' WHEN 2 THEN 'null' WHEN 3 THEN 'improve' WHEN 4 THEN 'improve/replace' END AS act, CASE WHEN turn = 5 THEN 'null' WHEN turn = 3 THEN 'non_null' END AS state, conv_id % 2 = 0 AS rea, conv_id % 3 > 0 AS sup FROM t),
k AS (SELECT *, CASE WHEN coalesce((state = 'null' AND ho) OR (state = 'non_null' AND NOT ho) OR (act = 'null' AND nv), false) THEN 'field_decision_conflict'
  WHEN NOT ho THEN CASE WHEN nv THEN 'fill' ELSE 'remain_null' END
  WHEN coalesce(lower(trim(regexp_replace(old, '\s+', ' ', 'g'), ' ')) = lower(trim(regexp_replace(new, '\s+', ' ', 'g'), ' ')), false) THEN CASE WHEN act IN ('replace', 'improve', 'improve/replace') THEN 'redundant_replace' ELSE 'preserved' END
  WHEN NOT ov THEN CASE WHEN nv THEN 'repair' ELSE 'changed_defective' END
  WHEN NOT nv AND NOT hn THEN CASE WHEN act = 'null' AND rea AND sup THEN 'justified_nullification' ELSE 'unjustified_nullification' END
  WHEN NOT nv THEN 'regression' WHEN act IN ('replace', 'improve', 'improve/replace') AND rea AND sup THEN 'changed' WHEN act = 'preserve' THEN 'field_decision_conflict' ELSE 'unjustified_change' END AS kind FROM v)"""


def _preserved(spark, sf):
    from pyspark.sql import Window

    t, c = F.col("turn"), table(spark, sf, "conversations")
    after = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = c.select("conv_id", "turn", "role", F.when(t % 5 == 3, "").otherwise(F.col("text")).alias("old"), F.when(t % 3 == 1, F.col("text")).when(t % 7 == 2, "").otherwise(after).alias("new"))
    ok = lambda x: F.coalesce(F.char_length(x) > 60, F.lit(False))
    action = F.when(t % 6 == 0, "replace").when(t % 6 == 1, "preserve").when(t % 6 == 2, "null").when(t % 6 == 3, "improve").when(t % 6 == 4, "improve/replace")
    even, third = F.col("conv_id") % 2 == 0, F.col("conv_id") % 3 > 0
    kind = rules.preservation(F.col("old"), F.col("new"), action, ok("old"), ok("new"), F.when(t == 5, "null").when(t == 3, " Non-Null"), even, third, even, third)
    return rows.select("conv_id", "turn", "role", kind.alias("kind"), ok("old").alias("old_valid"), F.coalesce(F.trim("old") != "", F.lit(False)).alias("old_has"))


@query(_PRESERVE_SQL + " SELECT conv_id, turn, role, kind FROM k")
def preservation_classes(spark, sf):
    return _preserved(spark, sf).select("conv_id", "turn", "role", "kind")


@query(_PRESERVE_SQL + """, s AS (SELECT count(*) FILTER (ho AND ov) AS valid_pool, count(*) FILTER (ho AND NOT ov) AS defective_pool, count(*) FILTER (ho AND NOT ov AND kind = 'repair') AS r FROM k),
vp AS (SELECT kind, count(*) AS n FROM k WHERE ho AND ov GROUP BY kind),
n AS (SELECT coalesce(sum(n) FILTER (kind = 'preserved'), 0) AS p, coalesce(sum(n) FILTER (kind IN ('changed', 'justified_nullification')), 0) AS j, coalesce(sum(n) FILTER (kind IN ('unjustified_change', 'field_decision_conflict')), 0) AS u,
  coalesce(sum(n) FILTER (kind LIKE '%nullification'), 0) AS z, coalesce(sum(n) FILTER (kind = 'unjustified_nullification'), 0) AS zu, coalesce(sum(n) FILTER (kind IN ('regression', 'unjustified_nullification')), 0) AS g FROM vp)
SELECT valid_pool, defective_pool, round(p / nullif(valid_pool, 0), 6) AS preservation_precision, round(r / nullif(defective_pool, 0), 6) AS repair_recall, round(j / nullif(valid_pool, 0), 6) AS justified_change_rate, round(u / nullif(valid_pool, 0), 6) AS unjustified_change_rate,
  round(z / nullif(valid_pool, 0), 6) AS nullification_rate, round(zu / nullif(valid_pool, 0), 6) AS unjustified_nullification_rate, round(g / nullif(valid_pool, 0), 6) AS regression_rate FROM s, n""")
def preservation_report(spark, sf):
    return rules.preservation_rates(_preserved(spark, sf), "kind", "old_valid", "old_has")


@query(_PRESERVE_SQL + " SELECT CASE WHEN kind IN ('preserved', 'redundant_replace') THEN 'legacy_preserved' WHEN kind = 'repair' THEN 'deterministic_repair' WHEN kind IN ('justified_nullification', 'unjustified_nullification', 'remain_null') THEN 'null' ELSE 'llm_changed' END AS source, count(*) AS n FROM k GROUP BY 1")
def source_types(spark, sf):
    return _preserved(spark, sf).groupBy(rules.source_type(F.col("kind")).alias("source")).agg(F.count(F.lit(1)).alias("n"))


_ALLOC_SQL = """WITH c AS (SELECT lang || '/' || source AS cell, count(*) AS size FROM documents GROUP BY 1),
a AS (SELECT *, size <= 2 AS small, 400 - coalesce(sum(size) FILTER (size <= 2) OVER (), 0) AS lft, coalesce(sum(size) FILTER (size > 2) OVER (), 0) AS mass FROM c),
b AS (SELECT *, size::DOUBLE * lft::DOUBLE / nullif(mass, 0)::DOUBLE AS exact FROM a),
d AS (SELECT *, CASE WHEN small THEN size ELSE greatest(2, floor(exact))::BIGINT END AS base, CASE WHEN small THEN -1.0 ELSE exact - floor(exact) END AS frac FROM b),
q AS (SELECT cell, size, least(size, base + CASE WHEN NOT small AND row_number() OVER (ORDER BY frac DESC, cell) <= 400 - sum(base) OVER () THEN 1 ELSE 0 END)::BIGINT AS quota FROM d)"""


def _cells(spark, sf):
    d = table(spark, sf, "documents").withColumn("cell", F.concat_ws("/", "lang", "source"))
    return d, sampling.allocate(d.groupBy("cell").agg(F.count(F.lit(1)).alias("size")), "cell", "size", 400)


@query(_ALLOC_SQL + " SELECT * FROM q")
def stratified_allocation(spark, sf):
    return _cells(spark, sf)[1]


@query(_ALLOC_SQL + ", r AS (SELECT doc_id, lang || '/' || source AS cell, row_number() OVER (PARTITION BY lang, source ORDER BY md5('pick:' || doc_id), doc_id) AS n FROM documents) SELECT doc_id, cell FROM r JOIN q USING (cell) WHERE n <= quota")
def stratified_sample(spark, sf):
    d, quotas = _cells(spark, sf)
    return sampling.stratified(d.select("doc_id", "cell"), quotas, "cell", "doc_id", "pick", 400)


@query("SELECT lang || '/' || source AS cell, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def one_per_stratum(spark, sf):
    return sampling.one_per_stratum(table(spark, sf, "documents").select(F.concat_ws("/", "lang", "source").alias("cell"), "doc_id"), "cell", "doc_id").select("cell", "doc_id")


@query("""SELECT 'lineitem_pk' AS "check", concat_ws('/', l_orderkey, l_linenumber) AS entity, count(*)::VARCHAR AS detail FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 UNION ALL
SELECT 'customer_order', c_custkey::VARCHAR, count(*)::VARCHAR FROM customer ANTI JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey UNION ALL
SELECT 'supplier_balance', s_suppkey::VARCHAR, s_name FROM supplier WHERE NOT coalesce(s_acctbal >= 0, false) UNION ALL
SELECT 'label_enum', doc_id::VARCHAR, lang FROM documents WHERE NOT coalesce(lang IN ('en', 'de', 'fr'), false)""")
def violation_audit(spark, sf):
    t = lambda n: table(spark, sf, n)
    return quality.audit(
        quality.repeated_keys(t("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem_pk"),
        quality.orphans(t("customer"), "c_custkey", t("orders"), "o_custkey", "customer_order"),
        quality.broken(t("supplier"), "s_suppkey", F.col("s_acctbal") >= 0, F.col("s_name"), "supplier_balance"),
        quality.broken(t("documents"), "doc_id", F.col("lang").isin("en", "de", "fr"), F.col("lang"), "label_enum"),
    )


@query("""SELECT c_custkey, concat_ws(',', CASE WHEN NOT c_acctbal >= 0 THEN 'BALANCE' END, CASE WHEN NOT c_nationkey < 20 THEN 'NATION' END, CASE WHEN NOT c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'SEGMENT' END) AS rejected FROM customer""")
def import_gate(spark, sf):
    tests = {"BALANCE": F.col("c_acctbal") >= 0, "NATION": F.col("c_nationkey") < 20, "SEGMENT": F.col("c_mktsegment").isin("BUILDING", "MACHINERY")}
    return quality.gate(table(spark, sf, "customer"), tests).select("c_custkey", F.array_join("rejected", ",").alias("rejected"))


_CHANGES_SQL = """WITH ch AS (SELECT p_partkey, 'p_brand' AS field, p_brand AS before, 'Brand#X' AS after FROM part WHERE p_partkey % 5 = 0 UNION ALL SELECT p_partkey, 'p_type', p_type, lower(p_type) FROM part WHERE p_partkey % 7 = 0)"""


def _changes(spark, sf):
    p = table(spark, sf, "part")
    brand = p.where("p_partkey % 5 = 0").select("p_partkey", F.lit("p_brand").alias("field"), F.col("p_brand").alias("before"), F.lit("Brand#X").alias("after"))
    return p, brand.unionByName(p.where("p_partkey % 7 = 0").select("p_partkey", F.lit("p_type").alias("field"), F.col("p_type").alias("before"), F.lower("p_type").alias("after")))


@query("SELECT p_partkey, p_name, CASE WHEN p_partkey % 5 = 0 THEN 'Brand#X' ELSE p_brand END AS p_brand, CASE WHEN p_partkey % 7 = 0 THEN lower(p_type) ELSE p_type END AS p_type, p_size, p_retailprice FROM part")
def cell_migration_apply(spark, sf):
    p, changes = _changes(spark, sf)
    return migration.apply_cells(p, changes, "p_partkey", ["p_brand", "p_type"])


@query(_CHANGES_SQL + " SELECT * FROM ch")
def cell_migration_diff(spark, sf):
    p, changes = _changes(spark, sf)
    p = p.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return migration.differences(p, migration.apply_cells(p, changes, "p_partkey", ["p_brand", "p_type"]), "p_partkey")


@query(_CHANGES_SQL + " SELECT p_partkey, field, before, after, 'sha256:' || sha256(before) AS before_sha, 'sha256:' || sha256(after) AS after_sha FROM ch")
def cell_migration_audit(spark, sf):
    return migration.audit_rows(_changes(spark, sf)[1], "p_partkey")


@query("""WITH j AS (SELECT sha256('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}') AS h FROM customer)
SELECT count(*) AS n_rows, sha256(count(*) || ':' || sum(('0x' || substr(h, 1, 15))::BIGINT::HUGEINT) || ':' || sum(('0x' || substr(h, 16, 15))::BIGINT::HUGEINT)) AS sha256 FROM j""")
def table_logical_hash(spark, sf):
    return migration.logical_hash(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"))


@query("""WITH t AS (SELECT count(*) AS n, count(*) FILTER (nullif(trim(quality::VARCHAR), '') IS NULL) AS q, count(*) FILTER (nullif(trim(toxic::VARCHAR), '') IS NULL) AS x FROM documents LEFT JOIN labels USING (doc_id))
SELECT unnest(['quality', 'toxic']) AS field, unnest([q, x]) AS n_null, round(unnest([q, x]) / n, 4) AS rate FROM t""")
def null_rate_audit(spark, sf):
    return quality.null_rates(table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left"), ["quality", "toxic"])


@query(f"""WITH p AS ({_WORDS_SQL}), s AS (SELECT level, rank % 9 AS a, length(word) AS b FROM p)
SELECT level, count(*) AS n, count(*) FILTER (abs(a - b) = 0) AS exact, count(*) FILTER (abs(a - b) = 1) AS off_by_one, count(*) FILTER (abs(a - b) >= 2) AS off_by_more, round(corr(a, b), 6) AS r FROM s GROUP BY level""")
def reproduction_by_level(spark, sf):
    s = _words(spark, sf).select("level", (F.col("rank") % 9).alias("a"), F.char_length("word").alias("b"))
    gap = F.abs(F.col("a") - F.col("b"))
    return s.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.count_if(gap == 0).alias("exact"), F.count_if(gap == 1).alias("off_by_one"), F.count_if(gap >= 2).alias("off_by_more"), F.round(F.corr("a", "b"), 6).alias("r"))


@query("""WITH s AS (SELECT lang, unnest(string_split(text, '. ')) AS s FROM documents), w AS (SELECT lang, len(regexp_extract_all(s, '[^ \\n]+')) AS n FROM s)
SELECT lang, CASE WHEN n <= 6 THEN 'A1' WHEN n <= 9 THEN 'A2' WHEN n <= 13 THEN 'B1' WHEN n <= 18 THEN 'B2' WHEN n <= 24 THEN 'C1' ELSE 'C2' END AS band, count(*) AS n FROM w GROUP BY 1, 2""".replace("\\\\", "\\"))
def word_count_bucket(spark, sf):
    s = table(spark, sf, "documents").select("lang", F.explode(F.split("text", r"\. ")).alias("s"))
    return s.groupBy("lang", T.length_band(F.regexp_count("s", F.lit(r"[^ \n]+"))).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH j AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '[' || event_id || ',"a"]' WHEN 2 THEN '"' || event_type || '"' ELSE '{broken' END AS x FROM events)
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'object' WHEN 1 THEN 'array' WHEN 2 THEN 'scalar' ELSE 'malformed' END AS kind, CASE WHEN event_id % 4 = 0 THEN (x->>'k')::BIGINT END AS k, CASE WHEN event_id % 4 = 1 THEN json_array_length(x) END::INT AS n FROM j""")
def json_union_parse(spark, sf):
    i = F.col("event_id")
    x = F.when(i % 4 == 0, F.col("props")).when(i % 4 == 1, F.concat(F.lit("["), i.cast("string"), F.lit(',"a"]'))).when(i % 4 == 2, F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))).otherwise("{broken")
    v, kind = F.try_parse_json(x), V.json_kind(x)
    return table(spark, sf, "events").select("event_id", kind.alias("kind"), F.try_variant_get(v, "$.k", "long").alias("k"), F.when(kind == "array", F.json_array_length(x)).alias("n"))


@query("""SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN 'Everyday' WHEN 'SMALL' THEN 'Everyday' WHEN 'MEDIUM' THEN 'Science' WHEN 'LARGE' THEN 'Science' WHEN 'PROMO' THEN 'PROMO' ELSE 'General / Common' END AS category FROM part""")
def category_remap(spark, sf):
    moves = {"STANDARD": "Everyday", "SMALL": "Everyday", "MEDIUM": "Science", "LARGE": "Science"}
    return table(spark, sf, "part").select("p_partkey", files.remapped(F.col("p_type"), moves, ["PROMO"], "General / Common").alias("category"))


@query(f"WITH p AS ({_WORDS_SQL}) SELECT id, pos, CASE pos WHEN 'noun' THEN 'n' WHEN 'verb' THEN 'v' ELSE pos END AS short, CASE pos WHEN 'adj' THEN 'adjective' WHEN 'adv' THEN 'adverb' WHEN 'num' THEN 'number' WHEN 'prep' THEN 'preposition' ELSE pos END AS long, CASE WHEN pos IN ('noun', 'verb', 'adj', 'adv') THEN pos ELSE 'function' END AS grp FROM p")
def pos_normalise(spark, sf):
    p = F.col("pos")
    return _words(spark, sf).select("id", "pos", T.pos_short(p).alias("short"), T.pos_long(p).alias("long"), T.pos_group(p).alias("grp"))


@query("""WITH w AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z]+') AS ws FROM documents),
u AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w), f AS (SELECT doc_id, arg_min(w, i) AS w, min(i) AS i FROM u GROUP BY doc_id, lower(w)),
k AS (SELECT doc_id, w, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM f)
SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS words FROM k WHERE n <= 8 GROUP BY doc_id""")
def first_occurrence_dedupe(spark, sf):
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(words).alias("i", "w"))
    first = d.groupBy("doc_id", F.lower("w").alias("lw")).agg(F.min(F.struct("i", "w")).alias("f"))
    return first.groupBy("doc_id").agg(F.sort_array(F.collect_list("f")).alias("fs")).select("doc_id", F.array_join(F.transform(F.slice("fs", 1, 8), lambda f: f["w"]), " ").alias("words"))


@query("""SELECT doc_id, '{"key":"d-' || doc_id || '","request":{"contents":[{"role":"user","parts":[{"text":"Describe ' || lang || ' from ' || source || '"}]}]}}' AS line FROM documents""")
def request_lines(spark, sf):
    d = table(spark, sf, "documents").withColumn("key", F.concat(F.lit("d-"), F.col("doc_id").cast("string")))
    return batch.request_lines(d, F.col("key"), "Describe %s from %s", ["lang", "source"]).select(F.substring("key", 3, 20).cast("long").alias("doc_id"), "line")


@query(r"""WITH r AS (SELECT p_partkey, replace(trim(regexp_replace(lower(CASE p_partkey % 3 WHEN 0 THEN '  ' || p_name || '’s ' WHEN 1 THEN upper(p_name) ELSE replace(p_name, ' ', '-') END), '\s+', ' ', 'g')), '’', '''') AS x FROM part),
l AS (SELECT p_partkey, CASE WHEN x LIKE '%''s' AND length(x) > 2 THEN left(x, -2) ELSE x END AS lemma FROM r)
SELECT p_partkey, lemma, regexp_matches(lemma, '^[\p{L}\p{M}\p{Nd}''-]+$') AS single FROM l""")
def normalized_lemmas(spark, sf):
    n, w = F.col("p_partkey") % 3, F.col("p_name")
    raw = F.when(n == 0, F.concat(F.lit("  "), w, F.lit("’s "))).when(n == 1, F.upper(w)).otherwise(F.replace(w, F.lit(" "), F.lit("-")))
    told = table(spark, sf, "part").select("p_partkey", T.normalize_lemma(raw).alias("lemma"))
    return told.withColumn("single", T.is_single_word(F.col("lemma")))
