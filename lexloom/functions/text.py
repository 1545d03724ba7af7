"""Text rules as column expressions; none needs Python on the executors but ``nfc``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s+"
ARABIC = r"[؀-ۿ]"
# Texts that stand for "nothing", and parts of speech with their short forms.
NULL_WORDS = ["none", "null", "n/a", "لا يوجد", "لا توجد", "لا شيء", "غير متوفر", "لا توجد وسيلة"]
POS_SHORT = {"noun": "n", "verb": "v", "adjective": "adj", "adverb": "adv", "preposition": "prep", "conjunction": "conj", "pronoun": "pron", "determiner": "det", "number": "num", "exclamation": "excl", "modal verb": "modal"}
POS_SET = ["noun", "verb", "adj", "adv", "prep", "conj", "pron", "det", "num", "excl", "modal"]


def squash(x: Column) -> Column:
    """Runs of white space (of any script) become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(x, SPACE, " "))


def strip(x: Column) -> Column:
    """Without white space (of any script) at the ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def norm(x: Column) -> Column:
    """Lower-cased, runs of white space one space, none at the ends; null stays null."""
    return squash(F.lower(x))


def nfc(x: Column) -> Column:
    """Canonical composition.  ASCII text, which is composed already, never reaches Python."""

    @F.pandas_udf("string")
    def compose(s):
        import unicodedata

        return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    plain = F.octet_length(x) == F.char_length(x)
    return F.when(plain, x).otherwise(compose(F.when(~plain, x)))


def normalize_lemma(x: Column, composed: bool = False) -> Column:
    """Trim, lower-case, compose, straighten apostrophes, squash, and drop a final 's; null gives ''.

    ``composed`` says that the input is in canonical composition already and spares that step.
    """
    low = F.lower(squash(F.coalesce(x, F.lit(""))))
    low = low if composed else nfc(low)
    straight = squash(F.translate(low, "‘’ʼ", "'''"))
    return F.when(straight.endswith("'s") & (F.char_length(straight) > 2), F.regexp_replace(straight, "'s$", "")).otherwise(straight)


def is_single_word(x: Column) -> Column:
    return F.coalesce(x.rlike(r"^[\p{L}\p{M}\p{Nd}'-]+$"), F.lit(False))


def identity_key(lemma: Column, pos: Column) -> Column:
    """``lemma/pos``, both trimmed and lower-cased; null unless the lemma is one word and the part of speech known."""
    word, kind = normalize_lemma(lemma, composed=True), F.lower(F.trim(pos))
    return F.when(is_single_word(word) & kind.isin(POS_SET), F.concat_ws("/", word, kind))


def tokens(x: Column) -> Column:
    """Runs of ASCII letters and apostrophes, lower-cased."""
    return F.transform(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit("[A-Za-z']+"), F.lit(0)), F.lower)


def norm_phrase(x: Column) -> Column:
    return squash(F.replace(F.lower(x), F.lit("-"), F.lit(" ")))


def contains_target(text: Column, lemma: Column) -> Column:
    return F.array_contains(tokens(text), F.lower(F.trim(lemma)))


def is_circular(definition: Column, lemma: Column) -> Column:
    """The definition says no more than its word: the word itself, or after ``a``, ``the``, ``to`` or ``the act of``."""
    d = squash(F.regexp_replace(F.lower(definition), "[^a-z0-9]+", " "))
    w = squash(F.regexp_replace(F.lower(lemma), "[^a-z0-9]+", " "))
    shapes = [w, *(F.concat(F.lit(p), w) for p in ("a ", "the ", "to ", "the act of ")), F.concat(F.lit("the act of "), w, F.lit("ing"))]
    return F.coalesce((w != "") & d.isin(*shapes), F.lit(False))


def lemma_closure(lemma: Column, pos: Column) -> Column:
    """Regular inflected forms of a word, its own first; which ones depends on the part of speech."""
    w = F.lower(F.trim(lemma))
    n = F.char_length(w)
    stem = F.substring(w, F.lit(1), n - 1)
    c_y = (n > 1) & w.rlike("[^aeiou]y$")
    sibilant, final_e = w.rlike("(s|x|z|ch|sh)$"), w.endswith("e")
    doubles = w.rlike("[^aeiou][aeiou][^aeiouwyx]$")
    twice = F.concat(w, F.right(w, F.lit(1)))
    plural, verbal, graded = pos.isin("noun", "verb", "num"), pos == "verb", pos.isin("adj", "adv")
    plus = lambda base, end: F.concat(base, F.lit(end))
    forms = [
        w,
        F.when(plural, plus(w, "s")),
        F.when(plural & sibilant, plus(w, "es")),
        F.when(plural & c_y, plus(stem, "ies")),
        *(F.when(verbal & final_e, f) for f in (plus(w, "d"), plus(stem, "ing"))),
        *(F.when(verbal & ~final_e, plus(w, e)) for e in ("ed", "ing")),
        F.when(verbal & c_y, plus(stem, "ied")),
        *(F.when(verbal & doubles, plus(twice, e)) for e in ("ed", "ing")),
        *(F.when(graded & final_e, plus(w, e)) for e in ("r", "st")),
        *(F.when(graded & ~final_e, plus(w, e)) for e in ("er", "est")),
        *(F.when(graded & c_y, plus(stem, e)) for e in ("ier", "iest")),
        *(F.when(graded & doubles, plus(twice, e)) for e in ("er", "est")),
    ]
    return F.array_distinct(F.filter(F.array(*forms), lambda f: f.isNotNull()))


def phrase_variants(phrase: Column, forms_of) -> Column:
    """A phrase with one of its words at a time replaced by each of that word's forms."""
    words = F.split(squash(F.lower(phrase)), " ")
    put = lambda i, form: F.array_join(F.transform(words, lambda w, j: F.when(j == i, form).otherwise(w)), " ")
    return F.array_distinct(F.flatten(F.transform(words, lambda w, i: F.transform(forms_of(w), lambda f: put(i, f)))))


def target_forms(lemma: Column, pos: Column) -> tuple[Column, Column, Column]:
    """What ``holds_target`` looks for: the word, its forms, and the variants of a phrase (null for a single word)."""
    word = norm_phrase(lemma)
    return word, lemma_closure(word, pos), F.when(word.contains(" "), phrase_variants(word, lambda w: lemma_closure(w, pos)))


def holds_target(text: Column, word: Column, forms: Column, variants: Column) -> Column:
    """Some form of the word is a token of the text; of a phrase, it or it with one word inflected is part of it."""
    found = F.when(word.contains(" "), F.exists(variants, lambda v: F.contains(norm_phrase(text), v))).otherwise(F.arrays_overlap(tokens(text), forms))
    return F.coalesce((word != "") & found, F.lit(False))


def target_present(text: Column, lemma: Column, pos: Column) -> Column:
    """``holds_target`` of one text; where many texts share a word, find its forms once."""
    return holds_target(text, *target_forms(lemma, pos))


def strip_artifacts(x: Column) -> Column:
    """Without links, bracketed citations and daggers."""
    bare = F.regexp_replace(F.regexp_replace(x, r"(?U)https?://\S+", ""), r"【[^】]*】", "")
    return squash(F.regexp_replace(bare, "[†‡]", ""))


def learner_text_defects(x: Column) -> Column:
    """Codes of what does not belong into a learner's text, in a fixed order."""
    tests = {"URL": r"https?://\S", "CITATION": r"【[^】]*】", "DAGGER": "[†‡]", "REFERENCE": r"\[[0-9]+\]"}
    return F.filter(F.array(*[F.when(x.rlike(p), F.lit(code)) for code, p in tests.items()]), lambda c: c.isNotNull())


def uk_ipa(uk: Column, us: Column) -> Column:
    """The British transcription, or the American in its place, with its source."""
    a, b = F.nullif(F.trim(uk), F.lit("")), F.nullif(F.trim(us), F.lit(""))
    return F.struct(F.coalesce(a, b).alias("ipa"), F.when(a.isNotNull(), "dictionary").when(b.isNotNull(), "fallback_from_us").alias("source"))


def first_occurrences(items: Column, most: int) -> Column:
    """Items without later repeats (case aside), in order, the first ``most``."""
    low = F.transform(items, F.lower)
    return F.slice(F.filter(items, lambda x, i: F.array_position(low, F.lower(x)) == i + 1), 1, most)


def is_null_like(x: Column) -> Column:
    return x.isNull() | (strip(x) == "") | F.lower(strip(x)).isin(NULL_WORDS)


def syllables(word: Column) -> Column:
    """Parts between bullets, where there are any; else vowel groups, less a silent final e, at least 1."""
    w = F.lower(F.trim(word))
    groups = F.regexp_count(w, F.lit("[aeiouy]+"))
    silent = F.when(w.endswith("e") & (groups > 1), 1).otherwise(0)
    le = F.when(w.rlike("[^aeiouy]le$"), 1).otherwise(0)
    return F.when(F.contains(word, F.lit("•")), F.size(F.split(word, "•"))).otherwise(F.greatest(F.lit(1), groups - silent + le)).cast("int")


def length_band(words: Column) -> Column:
    """Level of a sentence by its number of words."""
    out = F.lit("C2")
    for most, level in ((24, "C1"), (18, "B2"), (13, "B1"), (9, "A2"), (6, "A1")):
        out = F.when(words <= most, level).otherwise(out)
    return out


def by_band(sentences: Column) -> Column:
    """Sentences by the level of their number of words, in order, as a map by level; levels without any are absent."""
    banded = F.transform(sentences, lambda s: F.struct(length_band(F.size(F.filter(F.split(s, r"(?U)\s+"), lambda w: w != ""))).alias("band"), s.alias("s")))
    levels = ["A1", "A2", "B1", "B2", "C1", "C2"]
    of = lambda level: F.transform(F.filter(banded, lambda b: b["band"] == level), lambda b: b["s"])
    every = F.create_map(*[x for level in levels for x in (F.lit(level), of(level))])
    return F.map_filter(every, lambda k, v: F.size(v) > 0)


def pos_short(x: Column) -> Column:
    """Short form of a part of speech; an unknown one as it is, an empty one null."""
    table = F.create_map(*[F.lit(v) for kv in POS_SHORT.items() for v in kv])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(x))), F.nullif(F.trim(x), F.lit("")))


def pos_long(x: Column) -> Column:
    table = F.create_map(*[F.lit(v) for k, s in POS_SHORT.items() for v in (s, k)])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(x))), F.nullif(F.trim(x), F.lit("")))


def pos_group(x: Column) -> Column:
    return F.when(x.isin("noun", "verb", "adj", "adv"), x).otherwise("function")


def cell_hash(x: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.coalesce(x.cast("string"), F.lit("null")), 256))


def strip_fences(x: Column) -> Column:
    """The inside of one ``` fence around a text, if there is one."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(x), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))


def value_equal(a: Column, b: Column) -> Column:
    """Equal as JSON arrays of strings where both are such, else as strings; null equals null."""
    as_list = lambda x: F.from_json(x, "array<string>")
    both = F.coalesce(a.startswith("[") & b.startswith("["), F.lit(False))
    return F.when(both, as_list(a).eqNullSafe(as_list(b))).otherwise(a.eqNullSafe(b))
