"""Values of loose type: numbers as text, lists as text, validity and emptiness of fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ARABIC, NULL_WORDS, contains_target, first_occurrences, is_circular, norm

# Phrases that name a preference and no defect, and the fewest characters of a reason.
VAGUE = ["prefer null", "not ideal", "cannot improve", "can't improve", "can not improve", "could not improve", "no better", "not perfect", "cleaner", "minimalism", "uncertain", "rather omit", "prefer to omit", "no strong"]
LEAST_REASON = 10


def maybe_int(x: Column) -> Column:
    """Canonical digits of a whole number given as text; anything else as it is."""
    return F.coalesce(F.trim(x).try_cast("long").cast("string"), x)


def star_parts(x: Column) -> Column:
    """Parts between stars that have more than four characters."""
    return F.filter(F.transform(F.split(x, "☆"), lambda p: F.trim(p)), lambda p: F.char_length(p) > 4)


def escape_percent(x: Column) -> Column:
    return F.replace(x, F.lit("%"), F.lit("%%"))


def is_empty(x: Column) -> Column:
    """Null, blank, or an empty JSON container."""
    return x.isNull() | F.trim(x).isin("", "[]", "{}", "null")


def string_list(x: Column) -> Column:
    """The items of a JSON array of strings; null for anything else, also where an item is no string."""
    kind = F.schema_of_variant(F.try_parse_json(x))
    return F.when(kind == "ARRAY<STRING>", F.from_json(x, "array<string>")).when(F.trim(x) == "[]", F.array().cast("array<string>"))


def examples(x: Column) -> Column:
    """``level, text`` of each example in a JSON object by level or a JSON list; an empty array where it is neither."""
    kind = F.schema_of_variant(F.try_parse_json(x))
    listed = F.transform(F.from_json(x, "array<string>"), lambda t: F.struct(F.lit(None).cast("string").alias("level"), t.alias("text")))
    mapped = F.transform(F.map_entries(F.from_json(x, "map<string,string>")), lambda e: F.struct(e["key"].alias("level"), e["value"].alias("text")))
    return F.when(kind == "ARRAY<STRING>", listed).when(kind.startswith("OBJECT"), mapped).otherwise(F.array().cast("array<struct<level:string,text:string>>"))


def by_script(items: Column, most: int = 6) -> Column:
    """Items split into Arabic script and others, each without repeats and at most ``most``."""
    return F.struct(first_occurrences(F.filter(items, lambda x: ~x.rlike(ARABIC)), most).alias("en"), first_occurrences(F.filter(items, lambda x: x.rlike(ARABIC)), most).alias("ar"))


def has_content(kind: str, value: Column) -> Column:
    """Whether an earlier value says anything: a text that is not blank, a list with an item that is not."""
    if kind in ("definition", "explanation", "mnemonic"):
        return F.coalesce(norm(value) != "", F.lit(False))
    if kind == "examples":
        return F.coalesce(F.exists(value, lambda x: x != ""), F.lit(False))
    return F.coalesce(F.exists(value, lambda x: F.trim(x) != ""), F.lit(False))


def field_validity(kind: str, value: Column, word: Column) -> Column:
    """``valid, why`` of a field: the first thing that is wrong with it ('' if nothing is).

    ``value`` is a text for ``definition``, ``explanation`` and ``mnemonic``, else an array of texts; null counts
    as empty.
    """
    said = norm(value) if kind in ("definition", "explanation", "mnemonic") else None
    items = F.filter(F.coalesce(value, F.array().cast("array<string>")), lambda x: (x != "") if kind == "examples" else F.coalesce(F.trim(x) != "", F.lit(False))) if said is None else None
    generic = lambda x: norm(x).isin(NULL_WORDS)
    blank = F.coalesce(said == "", F.lit(True)) if said is not None else None
    tests = {
        "definition": lambda: {"empty": blank, "circular": is_circular(said, word)},
        "explanation": lambda: {"empty": blank, "generic_null": said.isin(NULL_WORDS), "bracket_placeholder": said.startswith("[") | said.startswith("(")},
        "examples": lambda: {"count!=3": F.size(items) != 3, "empty_example": F.exists(items, lambda x: F.trim(x) == ""), "target_missing": F.exists(items, lambda x: ~contains_target(x, word))},
        "translations": lambda: {"empty": F.size(items) == 0, "generic_null": F.forall(items, generic)},
        "relations": lambda: {"empty": F.size(items) == 0},
        "mnemonic": lambda: {"null": value.isNull(), "empty": blank, "generic_null": said.isin(NULL_WORDS)},
    }[kind]()
    why = F.coalesce(*[F.when(c, F.lit(n)) for n, c in tests.items()], F.lit(""))
    return F.struct((why == "").alias("valid"), why.alias("why"))


def reason_suffices(x: Column) -> Column:
    """``suffices, why``: a reason of some length that names more than a vague preference."""
    said = F.coalesce(norm(x), F.lit(""))
    vague = F.array(*[F.contains(said, F.lit(p)) for p in VAGUE])
    why = F.when(said == "", "none declared").when(F.char_length(said) < LEAST_REASON, "too short").when(F.exists(vague, lambda v: v), "vague").otherwise("")
    return F.struct((why == "").alias("suffices"), why.alias("why"))


def kept_lines(x: Column) -> Column:
    """Runs of blanks and tabs become one blank, line breaks stay, none of either at the ends."""
    return F.regexp_replace(F.regexp_replace(x, "[ \t]+", " "), r"(?U)^\s+|\s+$", "")


def storage_key(key: Column) -> Column:
    """``word/pos`` as it is written in names of files."""
    return F.replace(key, F.lit("/"), F.lit("__"))


def json_kind(x: Column) -> Column:
    """``object``, ``array``, ``scalar`` or ``malformed``; null for null."""
    shape = F.schema_of_variant(F.try_parse_json(x))
    return F.when(x.isNull(), F.lit(None)).when(shape.isNull(), "malformed").when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array").otherwise("scalar")
