"""Contracts of records: what a candidate must hold, the order of checks, and what follows from verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_fences

# Keys of transport wiring that may not travel, shapes of run identifiers that tell where a text comes
# from (never bare words, which may be content), the fields and verdicts of a ballot, and its severe errors.
TRANSPORT_KEYS = ["channel", "phase", "provenance", "job_id", "input_gcs", "output_gcs", "candidate_id", "created_at", "imported_at"]
LEAKS = [r"PILOT-V1-CAND-\d+", r"RUN-[A-Z0-9]+(?:-[A-Z0-9]+)*", r"EXP-\d{4}", r"gemini[\w.\-]*", r"\b2\.2\.3\b", r"\b[0-9a-f]{32,}\b", "pilot_manifest", "input_snapshot", "output_hash"]
FIELDS = ["definition", "arabic_explanation", "sense_separation", "examples", "translations", "relations", "mnemonic"]
VERDICTS = ["A-better", "B-better", "tie", "cannot-judge", "unjudged"]
CRITICAL = ["wrong_meaning", "misleading_arabic", "invalid_relation_synonym", "example_semantic_error", "target_word_violation", "fabricated_etymology_mnemonic", "cefr_learner_mismatch"]


def checks(tests: dict[str, Column]) -> Column:
    """Array of (check, status) in order; unknown is a failure."""
    return F.array(*[F.struct(F.lit(n).alias("check"), F.when(F.coalesce(ok, F.lit(False)), "pass").otherwise("fail").alias("status")) for n, ok in tests.items()])


def failed(told: Column) -> Column:
    return F.transform(F.filter(told, lambda c: c["status"] == "fail"), lambda c: c["check"])


def staged_status(stops: dict[str, Column], errors: dict[str, Column], flags: dict[str, Column]) -> Column:
    """ERROR at the first stop that applies, alone; else all errors, else FLAG with all flags, else PASS."""
    codes = lambda d: F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in d.items()]), lambda x: x.isNotNull())
    first = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in stops.items()])
    bad, odd = codes(errors), codes(flags)
    status = F.when(first.isNotNull(), "ERROR").when(F.size(bad) > 0, "ERROR").when(F.size(odd) > 0, "FLAG").otherwise("PASS")
    return F.struct(status.alias("status"), F.when(first.isNotNull(), F.array(first)).when(F.size(bad) > 0, bad).otherwise(odd).alias("codes"))


def banned_fields(df: DataFrame, banned: list[str] = TRANSPORT_KEYS) -> list[str]:
    """Paths of columns, at any depth, whose name may not travel: a check of the schema, not of rows."""
    from pyspark.sql.types import ArrayType, MapType, StructType

    def walk(kind, path):
        if isinstance(kind, StructType):
            for f in kind.fields:
                here = f"{path}.{f.name}" if path else f.name
                if f.name.lower() in banned:
                    yield here
                yield from walk(f.dataType, here)
        elif isinstance(kind, ArrayType):
            yield from walk(kind.elementType, path)
        elif isinstance(kind, MapType):
            yield from walk(kind.valueType, path)

    return list(walk(df.schema, ""))


def leaks(text: Column) -> Column:
    """What in a blind text has the shape of a run identifier, each once, in the order of the shapes."""
    return F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(f"(?i)({shape})"), F.lit(1)) for shape in LEAKS])))


def ballot_defects(fields: Column, sides: Column) -> Column:
    """Defects of a ballot: ``fields`` (field to verdict) and ``sides`` (severe error to side) as maps.

    Both must cover exactly what a ballot has; a side is A, B or null.
    """
    covers = lambda m, names: F.coalesce(F.array_sort(F.map_keys(m)) == F.array(*map(F.lit, sorted(names))), F.lit(False))
    bad_verdicts = F.transform(F.filter(F.array(*map(F.lit, FIELDS)), lambda f: ~F.coalesce(F.try_element_at(fields, f).isin(VERDICTS), F.lit(False))), lambda f: F.concat(F.lit("verdict:"), f))
    bad_sides = F.transform(F.filter(F.array(*map(F.lit, CRITICAL)), lambda c: ~F.coalesce(F.try_element_at(sides, c).isin("A", "B"), F.lit(True))), lambda c: F.concat(F.lit("side:"), c))
    none = F.array().cast("array<string>")
    return F.concat(F.when(covers(fields, FIELDS), bad_verdicts).otherwise(F.array(F.lit("fields"))), F.when(covers(sides, CRITICAL), F.coalesce(bad_sides, none)).otherwise(F.array(F.lit("critical_errors"))))


def blank_ballot() -> Column:
    """A ballot on which nothing is judged: every field ``unjudged``, no side."""
    pairs = lambda names, value: F.create_map(*[x for n in names for x in (F.lit(n), value)])
    return F.struct(pairs(FIELDS, F.lit("unjudged")).alias("fields"), pairs(CRITICAL, F.lit(None).cast("string")).alias("sides"))


def parsed_ballot(text: Column) -> Column:
    """``fields, sides, problem`` of a model's answer: one fence and one wrapper are tolerated, nothing else.

    ``problem`` is the first of: not JSON, not an object, no fields, a defect of the contract, an unjudged field.
    """
    body = strip_fences(text)
    plain = "struct<fields:map<string,string>,critical_errors:map<string,struct<side:string>>>"
    one, wrapped = F.from_json(body, plain), F.from_json(body, f"struct<ballot:{plain}>")
    kind = F.schema_of_variant(F.try_parse_json(body))
    inner = F.when(one["fields"].isNull(), wrapped["ballot"]).otherwise(one)
    fields = inner["fields"]
    sides = F.transform_values(inner["critical_errors"], lambda k, v: v["side"])
    problem = (
        F.when(kind.isNull(), "malformed JSON")
        .when(~kind.startswith("OBJECT"), "not an object")
        .when(fields.isNull(), "no fields")
        .when(F.size(ballot_defects(fields, sides)) > 0, F.concat(F.lit("defects: "), F.array_join(ballot_defects(fields, sides), ",")))
        .when(F.exists(F.map_values(fields), lambda v: v == "unjudged"), "unjudged field")
    )
    return F.struct(fields.alias("fields"), sides.alias("sides"), problem.alias("problem"))


def promotion(field: Column, verdict: Column, value: Column) -> Column:
    """What is done with a decided field."""
    empty = value.isNull() | (F.trim(value) == "")
    return F.when(field == "sense_separation", "manual").when(verdict != "candidate", "keep").when(empty, "keep").otherwise("promote")


def disposition(winner: Column, loss: Column, additions: Column) -> Column:
    """The decision matrix of winner, information lost and information added."""
    return (
        F.when(winner.isNull(), "MANUAL_REVIEW")
        .when((winner == "candidate") & ~loss, "REGENERATE")
        .when((winner == "candidate") & loss, "MANUAL_REVIEW")
        .when((winner == "legacy") & additions, "ENRICH")
        .when(winner == "legacy", "KEEP_LEGACY")
        .when(additions & ~loss, "ENRICH")
        .otherwise("KEEP_LEGACY")
    )


def machine_scores(keys: Column, us: Column, ar: Column, definitions: Column, had: Column, kept: Column) -> Column:
    """Structural, completeness, preservation and loss scores of a parsed word.

    ``keys`` flags its five required keys; ``had`` and ``kept`` flag the earlier values and which of them remain.
    """
    share = lambda flags: F.aggregate(flags, F.lit(0.0), lambda a, x: a + F.when(x, 1.0).otherwise(0.0))
    some = F.exists(definitions, lambda d: F.char_length(d) > 5)
    every = F.forall(definitions, lambda d: F.char_length(d) > 5) & (F.size(definitions) > 0)
    full = share(F.array(F.coalesce(us != "", F.lit(False)), F.coalesce(ar != "", F.lit(False)), some, every)) / 4
    both = F.zip_with(had, kept, lambda h, k: h & k)
    held = F.coalesce(F.try_divide(share(both), share(had)), F.lit(1.0))
    return F.struct((share(keys) / 5).alias("structural"), full.alias("completeness"), held.alias("preservation"), F.when(F.exists(F.zip_with(had, kept, lambda h, k: h & ~k), lambda x: x), 1.0).otherwise(0.0).alias("loss"))
