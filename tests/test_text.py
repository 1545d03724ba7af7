import pytest
from pyspark.sql import functions as F

from lexloom.functions import text as T


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("raw", "lemma"),
    [(None, ""), ("  Apple ", "apple"), ("Teacher’s", "teacher"), ("'s", "'s"), ("ice\t cream", "ice cream"), ("Café", "café"), ("it’s", "it")],
)
def test_normalize_lemma(spark, raw, lemma):
    assert one(spark, T.normalize_lemma(F.col("a").cast("string")), a=raw) == lemma


@pytest.mark.parametrize(("word", "ok"), [("apple", True), ("well-known", True), ("ice cream", False), ("", False), (None, False), ("naïve", True), ("a.b", False)])
def test_single_word(spark, word, ok):
    assert one(spark, T.is_single_word(F.col("a").cast("string")), a=word) is ok


@pytest.mark.parametrize(
    ("word", "pos", "forms"),
    [
        ("box", "noun", {"box", "boxs", "boxes"}),
        ("city", "noun", {"city", "citys", "cities"}),
        ("stop", "verb", {"stop", "stops", "stoped", "stoping", "stopped", "stopping"}),
        ("make", "verb", {"make", "makes", "maked", "making"}),
        ("big", "adj", {"big", "biger", "bigest", "bigger", "biggest"}),
        ("happy", "adj", {"happy", "happyer", "happyest", "happier", "happiest"}),
        ("of", "prep", {"of"}),
    ],
)
def test_closure(spark, word, pos, forms):
    assert set(one(spark, T.lemma_closure(F.col("w"), F.col("p")), w=word, p=pos)) == forms


@pytest.mark.parametrize(("text", "word", "pos", "there"), [("She stopped.", "stop", "verb", True), ("A shop.", "stop", "verb", False), ("We gave up-- ", "give up", "verb", False), ("Never give-up now", "give up", "verb", True), ("He gives up.", "give up", "verb", True), ("I like chocolate ice cream.", "ice cream", "noun", True), ("Do not abandon your friends.", "abandon", "verb", True), (None, "sun", "noun", False)])
def test_target_present(spark, text, word, pos, there):
    assert one(spark, T.target_present(F.col("t").cast("string"), F.col("w"), F.col("p")), t=text, w=word, p=pos) is there


@pytest.mark.parametrize(("definition", "circular"), [("The act of run.", True), ("to run", True), ("run", True), ("a run", True), ("to move fast", False), (None, False)])
def test_circular(spark, definition, circular):
    assert one(spark, T.is_circular(F.col("d").cast("string"), F.lit("run")), d=definition) is circular


def test_artifacts(spark):
    x = "See https://a.b/c 【4†x】 the† cat [3]"
    assert one(spark, T.strip_artifacts(F.col("x")), x=x) == "See the cat [3]"
    assert one(spark, T.learner_text_defects(F.col("x")), x=x) == ["URL", "CITATION", "DAGGER", "REFERENCE"]


@pytest.mark.parametrize(("uk", "us", "want"), [("a", "b", ("a", "dictionary")), (" ", "b", ("b", "fallback_from_us")), (None, "", (None, None))])
def test_uk_ipa(spark, uk, us, want):
    assert tuple(one(spark, T.uk_ipa(F.col("a").cast("string"), F.col("b").cast("string")), a=uk, b=us)) == want


@pytest.mark.parametrize(("word", "n"), [("a•bout", 2), ("table", 2), ("make", 1), ("rhythm", 1), ("idea", 2), ("psst", 1)])
def test_syllables(spark, word, n):
    assert one(spark, T.syllables(F.col("w")), w=word) == n


def test_first_occurrences(spark):
    got = spark.sql("select array('a', 'B', 'A', 'b', 'c', 'd') as x").select(T.first_occurrences(F.col("x"), 3).alias("x")).first().x
    assert got == ["a", "B", "c"]


@pytest.mark.parametrize(("a", "b", "same"), [('["x","y"]', '["x", "y"]', True), ('["x"]', '["y"]', False), (None, None, True), ("x", None, False), ("x", "x", True)])
def test_value_equal(spark, a, b, same):
    assert one(spark, T.value_equal(F.col("a").cast("string"), F.col("b").cast("string")), a=a, b=b) is same


def test_pos_names(spark):
    assert one(spark, T.pos_short(F.lit("Adjective"))) == "adj"
    assert one(spark, T.pos_long(F.lit("adv"))) == "adverb"
    assert one(spark, T.pos_short(F.lit("weird"))) == "weird"
    assert one(spark, T.pos_short(F.lit(" "))) is None


@pytest.mark.parametrize(
    ("kind", "value", "why"),
    [
        ("definition", None, "empty"), ("definition", "to run", "circular"), ("definition", "abc", ""), ("explanation", "لا يوجد", "generic_null"), ("explanation", "[x]", "bracket_placeholder"), ("explanation", "abc", ""),
        ("examples", ["I run.", "run"], "count!=3"), ("examples", ["I run.", "run", " "], "empty_example"), ("examples", ["I run.", "run", "runs"], "target_missing"), ("examples", ["I run.", "run", "Run!", ""], ""),
        ("translations", ["none", "N/A"], "generic_null"), ("translations", [" "], "empty"), ("relations", [], "empty"), ("relations", ["x"], ""), ("mnemonic", None, "null"), ("mnemonic", " ", "empty"), ("mnemonic", "None", "generic_null"), ("mnemonic", "see [1]", ""),
    ],
)
def test_field_validity(spark, kind, value, why):
    from lexloom.functions import values as V

    x = F.lit(value).cast("string") if not isinstance(value, list) else F.array(*map(F.lit, value)).cast("array<string>")
    assert tuple(spark.range(1).select(V.field_validity(kind, x, F.lit("run")).alias("x")).first().x) == (why == "", why)


@pytest.mark.parametrize(("reason", "ok"), [("wrong because the sense belongs to another headword", True), ("short", False), ("it is Not  Ideal here", False), (None, False), ("better wording in the same sense", True), ("an uncertain etymology", False)])
def test_reasons(spark, reason, ok):
    from lexloom.functions import values as V

    assert spark.range(1).select(V.reason_suffices(F.lit(reason).cast("string")).alias("x")).first().x.suffices is ok
