"""Ladders of rules: field triage and quotas, preservation of earlier values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ARABIC, cell_hash, holds_target, is_circular, is_null_like, norm_phrase, strip, target_forms

# The share of flagged fields from which on a run is halted, and the field that has none.
QUOTAS = {"examples": 0.35, "relations_synonyms": 0.3, "relations_antonyms": 0.3, "relations_collocations": 0.3, "translations": 0.3, "explanation_ar": 0.2, "definition_en": 0.2, "mnemonic": 0.2}
EXEMPT = "sense_separation"
REPAIRS = ["MNE_EMPTY_STRING", "MNE_GENERIC_NULL"]


def _blank(x: Column) -> Column:
    return x.isNull() | (strip(x) == "")


def triage_definition(value: Column, word: Column) -> Column:
    return F.when(_blank(value), "DEF_EMPTY").when(is_null_like(value), "DEF_GENERIC_NULL").when(is_circular(value, word), "DEF_CIRCULAR")


def triage_explanation(value: Column) -> Column:
    return F.when(_blank(value), "AR_EMPTY").when(is_null_like(value), "AR_GENERIC_NULL").when(~value.rlike(ARABIC), "AR_NO_ARABIC_SCRIPT")


def bands(x: Column) -> Column:
    """The sentences of a JSON list of texts or a JSON object by band, null for one that is no text; null if malformed."""
    kind = F.schema_of_variant(F.try_parse_json(x))
    by_band = F.transform(F.map_values(F.from_json(x, "map<string,variant>")), lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    listed = F.from_json(x, "array<string>")
    texts = F.when((kind == "ARRAY<STRING>") & ~F.exists(listed, lambda t: t.isNull()), listed).when(kind.startswith("OBJECT"), by_band)
    return F.when(F.size(texts) > 0, texts)


def triage_examples(items: Column, *target: Column) -> Column:
    """``items``: what ``bands`` gives; ``target``: what ``target_forms`` does."""
    plain = F.transform(items, norm_phrase)
    unended = F.exists(items, lambda s: ~strip(s).rlike("[.!?؟۔]$"))
    uncased = F.exists(items, lambda s: strip(s).rlike(r"^\p{Ll}"))
    return (
        F.when(items.isNull(), "EX_MALFORMED_JSON")
        .when(F.exists(items, _blank), "EX_EMPTY_BAND")
        .when(F.exists(items, lambda s: ~holds_target(s, *target)), "EX_NO_LEMMA_TOKEN")
        .when(F.size(F.array_distinct(plain)) < F.size(plain), "EX_DUPLICATE_BANDS")
        .when(unended & uncased, "EX_SOFT_ESCALATION")
    )


def triage_translations(value: Column) -> Column:
    slots = F.filter(F.transform(F.split(value, "/"), lambda s: F.lower(strip(s))), lambda s: s != "")
    return F.when(_blank(value) | (F.size(slots) == 0), "TR_EMPTY").when(F.size(F.array_distinct(slots)) < F.size(slots), "TR_DUPLICATE_SLOTS")


def triage_mnemonic(value: Column) -> Column:
    return F.when(value.isNull(), F.lit(None)).when(strip(value) == "", REPAIRS[0]).when(is_null_like(value), REPAIRS[1])


def triage_relation(x: Column, word: Column) -> Column:
    """``code, items`` of one JSON list of relations; no items where the list is defective, an empty list for null."""
    kind, items = F.schema_of_variant(F.try_parse_json(x)), F.from_json(x, "array<string>")
    plain = F.transform(items, norm_phrase)
    code = (
        F.when(x.isNull(), F.lit(None))
        .when(~F.coalesce(kind.startswith("ARRAY"), F.lit(False)), "REL_MALFORMED_JSON")
        .when(~kind.isin("ARRAY<STRING>", "ARRAY<VOID>") | F.exists(items, lambda i: i.isNull()), "REL_INVALID_ITEM")
        .when(F.array_contains(plain, norm_phrase(word)), "REL_SELF_REFERENCE")
        .when(F.size(F.array_distinct(plain)) < F.size(plain), "REL_DUPLICATES")
    )
    return F.struct(code.cast("string").alias("code"), F.when(code.isNull(), F.coalesce(plain, F.array().cast("array<string>"))).alias("items"))


# What was checked where a code is given, and all that was checked of a field that is kept.
CHECKED = {
    "DEF_EMPTY": "non_empty", "DEF_GENERIC_NULL": "generic_null", "DEF_CIRCULAR": "circularity",
    "AR_EMPTY": "non_empty", "AR_GENERIC_NULL": "generic_null", "AR_NO_ARABIC_SCRIPT": "arabic_script",
    "EX_MALFORMED_JSON": "json_bands", "EX_EMPTY_BAND": "non_empty_bands", "EX_NO_LEMMA_TOKEN": "contains_target", "EX_DUPLICATE_BANDS": "band_uniqueness", "EX_SOFT_ESCALATION": "soft_combination",
    "TR_EMPTY": "non_empty", "TR_DUPLICATE_SLOTS": "slot_uniqueness",
    "MNE_EMPTY_STRING": "non_empty", "MNE_GENERIC_NULL": "generic_null",
    "REL_MALFORMED_JSON": "json_array", "REL_INVALID_ITEM": "string_items", "REL_SELF_REFERENCE": "self_reference", "REL_DUPLICATES": "item_uniqueness", "REL_SYN_ANT_OVERLAP": "syn_ant_disjoint",
}
KEPT = {
    "definition_en": ["non_empty", "generic_null", "circularity"],
    "explanation_ar": ["non_empty", "generic_null", "arabic_script"],
    "examples": ["json_bands", "non_empty_bands", "contains_target", "band_uniqueness"],
    "translations": ["non_empty_slots", "slot_uniqueness"],
    "mnemonic": ["type_is_string_or_null", "non_empty", "generic_null"],
    **{f"relations_{r}": ["json_array", "string_items", "self_reference", "item_uniqueness"] for r in ("synonyms", "antonyms", "collocations")},
}
_SOFT = "array<struct<band:string,signal:string,count:int>>"
_EVIDENCE = {"checked": "array<string>", "format": "string", "empty_bands": "array<string>", "failing_bands": "array<string>", "soft_signals": _SOFT, "slot_count": "int", "item_count": "int", "inventory_empty": "boolean", "inventory_null": "boolean", "overlap": "array<string>", "null_valid": "boolean", "proposed_fix": "string", "reason": "string", "primary_sense": "string"}


def _evidence(**known: Column) -> Column:
    return F.struct(*[known.get(k, F.lit(None)).cast(t).alias(k) for k, t in _EVIDENCE.items()])


def _soft(band: Column, signal: str, count: Column | None = None) -> Column:
    return F.struct(band.cast("string").alias("band"), F.lit(signal).alias("signal"), (F.lit(None) if count is None else count).cast("int").alias("count"))


def _named_bands(x: Column, items: Column, *target: Column) -> Column:
    """Of each sentence of ``bands``: its name, whether it is empty, lacks the word, does not end or begin as it should."""
    kind = F.schema_of_variant(F.try_parse_json(x))
    names = F.when(kind.startswith("OBJECT"), F.map_keys(F.from_json(x, "map<string,variant>"))).otherwise(F.transform(items, lambda s, i: F.concat(F.lit("arr"), i.cast("string"))))
    told = lambda s, n: F.struct(n.alias("band"), _blank(s).alias("empty"), (~_blank(s) & ~holds_target(s, *target)).alias("lacks"), (~_blank(s) & ~strip(s).rlike("[.!?؟۔]$")).alias("unended"), (~_blank(s) & strip(s).rlike(r"^\p{Ll}")).alias("uncased"))
    return F.zip_with(items, names, told)


def field_evidence(told: DataFrame, word: str, pos: str) -> dict[str, Column]:
    """By field what its evidence can say, whatever its code: see ``triage``."""
    c, w = F.col, F.col(word)
    kind = F.schema_of_variant(F.try_parse_json(c("examples")))
    picked = lambda flag: F.transform(F.filter("_marks", lambda m: m[flag]), lambda m: m["band"])
    softs = F.flatten(F.transform("_marks", lambda m: F.filter(F.array(F.when(m["unended"], _soft(m["band"], "EX_NO_TERMINAL_PUNCT")), F.when(m["uncased"], _soft(m["band"], "EX_LEADING_LOWERCASE"))), lambda x: x.isNotNull())))
    slots = F.size(F.filter(F.split(c("translations"), "/"), lambda s: strip(s) != ""))
    shared = F.array_sort(F.array_intersect("_synonyms.items", "_antonyms.items"))
    out = {
        "definition_en": _evidence(),
        "explanation_ar": _evidence(),
        "examples": _evidence(format=F.when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object"), empty_bands=picked("empty"), failing_bands=picked("lacks"), soft_signals=softs),
        "translations": _evidence(slot_count=slots, soft_signals=F.when(~c("translations").rlike(ARABIC), F.array(_soft(F.lit(None), "TR_NO_ARABIC_SCRIPT")))),
        "mnemonic": _evidence(null_valid=F.when(c("mnemonic").isNull(), True), proposed_fix=F.lit("normalize_to_null")),
        EXEMPT: _evidence(reason=F.lit("default_manual_per_G3"), primary_sense=c("primary_sense") if "primary_sense" in told.columns else F.lit(None)),
    }
    for name in ("synonyms", "antonyms", "collocations"):
        items = F.from_json(c(name), "array<string>")
        known = {"item_count": F.size(items), "inventory_empty": F.size(items) == 0, "inventory_null": F.when(c(name).isNull(), True)}
        if name == "collocations":
            without = F.size(F.filter(f"_{name}.items", lambda i: ~F.contains(i, norm_phrase(w))))
            known["soft_signals"] = F.when(without > 0, F.array(_soft(F.lit(None), "REL_COLLOCATION_NO_TARGET", without)))
        else:
            known["overlap"] = shared
        out[f"relations_{name}"] = _evidence(**known)
    return out


def _said(field: Column, code: Column, e: Column) -> Column:
    """The part of a field's evidence that belongs to its code, as JSON; what is null or empty is left out."""
    kept, keep = F.create_map(*[x for k, v in KEPT.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]), code.isNull()
    checks = F.create_map(*[x for k, v in CHECKED.items() for x in (F.lit(k), F.lit(v))])
    some = lambda x: F.when(F.size(x) > 0, x)
    null = keep & F.coalesce(e["inventory_null"], e["null_valid"], F.lit(False))
    checked = F.when(e["reason"].isNotNull(), F.lit(None)).when(null, F.array(F.when(e["null_valid"].isNotNull(), "null_valid").otherwise("inventory"))).when(keep, F.try_element_at(kept, field)).otherwise(F.array(F.try_element_at(checks, code)))
    only = lambda name, *codes: F.when(code.isin(*codes), e[name])
    parts = {
        "checked": checked,
        "format": F.when(keep | ~code.isin("EX_MALFORMED_JSON"), e["format"]),
        "empty_bands": some(only("empty_bands", "EX_EMPTY_BAND")),
        "failing_bands": some(only("failing_bands", "EX_NO_LEMMA_TOKEN")),
        "soft_signals": some(F.when(keep | code.isin("EX_SOFT_ESCALATION"), e["soft_signals"])),
        "slot_count": F.when(keep | code.isin("TR_DUPLICATE_SLOTS"), e["slot_count"]),
        "item_count": F.when((keep & ~null) | code.isin("REL_DUPLICATES"), e["item_count"]),
        "inventory_empty": F.when(keep & ~null, e["inventory_empty"]),
        "inventory_null": F.when(keep, e["inventory_null"]),
        "overlap": some(only("overlap", "REL_SYN_ANT_OVERLAP")),
        "null_valid": F.when(keep, e["null_valid"]),
        "proposed_fix": only("proposed_fix", *REPAIRS),
        "reason": e["reason"],
        "primary_sense": e["primary_sense"],
    }
    return F.to_json(F.struct(*[v.alias(k) for k, v in parts.items()]))


def triage(cards: DataFrame, key: str, word: str, pos: str, cells: bool = False, evidence: bool = False) -> DataFrame:
    """Nine records a card: ``key, field, status, code, requires_llm, requires_human`` and, if asked for, ``cell`` and ``evidence``.

    Evidence is a JSON text: what was checked, names of empty and of failing bands (``arr0``, ... in a list), soft signals,
    numbers of slots and items, the overlap of synonyms and antonyms, a proposed repair.

    Cards have ``definition, explanation, examples, translations, mnemonic, synonyms, antonyms, collocations,
    primary_sense`` as text (lists as JSON).  A list of synonyms and one of antonyms that share an item are both
    defective, if both are sound by themselves.  Senses always go to a reviewer.
    """
    w, c = F.col(word), F.col
    told = cards.select("*", *[triage_relation(c(f), w).alias(f"_{f}") for f in ("synonyms", "antonyms", "collocations")], bands(c("examples")).alias("_bands"), *[x.alias(n) for n, x in zip(("_word", "_forms", "_variants"), target_forms(w, c(pos)), strict=True)])
    target = [c("_word"), c("_forms"), c("_variants")]  # made once a card, not once a sentence
    if evidence:
        told = told.withColumn("_marks", _named_bands(c("examples"), c("_bands"), *target))
        says = field_evidence(told, word, pos)
    both = F.arrays_overlap("_synonyms.items", "_antonyms.items")
    overlap = lambda f: F.coalesce(c(f"_{f}.code"), F.when(c(f).isNotNull() & F.coalesce(both, F.lit(False)), "REL_SYN_ANT_OVERLAP"))
    fields = {
        "definition_en": ("definition", triage_definition(c("definition"), w)),
        "explanation_ar": ("explanation", triage_explanation(c("explanation"))),
        "examples": ("examples", triage_examples(c("_bands"), *target)),
        "translations": ("translations", triage_translations(c("translations"))),
        "mnemonic": ("mnemonic", triage_mnemonic(c("mnemonic"))),
        "relations_synonyms": ("synonyms", overlap("synonyms")),
        "relations_antonyms": ("antonyms", overlap("antonyms")),
        "relations_collocations": ("collocations", c("_collocations.code")),
        EXEMPT: ("primary_sense", F.lit(None)),
    }
    coded = [F.struct(F.lit(name).alias("field"), code.cast("string").alias("code"), *([cell_hash(c(value)).alias("cell")] if cells else []), *([says[name].alias("evidence")] if evidence else [])) for name, (value, code) in fields.items()]

    def record(r):
        # The code is bound by the lambda, so it is evaluated once.
        status = F.when(r["field"] == EXEMPT, "MANUAL_REVIEW").when(r["code"].isNull(), "KEEP").when(r["code"].isin(REPAIRS), "DETERMINISTIC_REPAIR").otherwise("LLM_REVIEW")
        return F.struct(r["field"].alias("field"), status.alias("status"), r["code"].alias("code"), (status == "LLM_REVIEW").alias("requires_llm"), (status == "MANUAL_REVIEW").alias("requires_human"), *([r["cell"].alias("cell")] if cells else []), *([_said(r["field"], r["code"], r["evidence"]).alias("evidence")] if evidence else []))

    return told.select(key, F.inline(F.transform(F.array(*coded), record)))


def quota_report(records: DataFrame, quotas: dict[str, float] = QUOTAS) -> DataFrame:
    """By field: total, flagged, rate, quota and whether the rate is above it (equal is not); exempt fields are absent."""
    limit = F.try_element_at(F.create_map(*[F.lit(v) for kv in quotas.items() for v in kv]), F.col("field"))
    told = records.where(F.col("field") != EXEMPT).groupBy("field").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") != "KEEP").alias("flagged"))
    rate = F.col("flagged") / F.col("total")
    return told.select("field", "total", "flagged", F.round(rate, 4).alias("rate"), limit.alias("quota"), F.coalesce(rate > limit, F.lit(False)).alias("breached"))


def halt_on_breach(report: DataFrame) -> DataFrame:
    """The report; reading it fails if a field is over its quota."""
    return report.withColumn("breached", F.when(F.col("breached"), F.raise_error(F.concat(F.lit("quota breached: "), F.col("field")))).otherwise(F.col("breached")))


def preservation(old: Column, new: Column, action: Column, old_valid: Column, new_valid: Column, state: Column, reason: Column, superior: Column, defect: Column, evidence: Column) -> Column:
    """What became of a text field: ``preservation.ladder`` over texts, blank ones being empty.

    ``evidence`` says that an emptied field was sufficiently argued.
    """
    from .preservation import ladder

    has = lambda x: F.coalesce(F.trim(x) != "", F.lit(False))
    level = lambda x: F.lower(F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    return ladder(has(old), old_valid, has(new), new_valid, level(old) == level(new), action, reason, superior, defect, evidence, state)


def preservation_rates(rows: DataFrame, kind: str, old_valid: str, old_has: str) -> DataFrame:
    """Seven rates over the pools of valid and of defective old values; null where a pool is empty.

    Empty old values are in neither pool.
    """
    valid, defective = F.col(old_has) & F.col(old_valid), F.col(old_has) & ~F.col(old_valid)
    pool = lambda *kinds: F.count_if(valid & F.col(kind).isin(*kinds))
    told = rows.agg(
        F.count_if(valid).alias("valid_pool"),
        F.count_if(defective).alias("defective_pool"),
        pool("preserved").alias("_preserved"),
        F.count_if(defective & (F.col(kind) == "repair")).alias("_repaired"),
        pool("changed", "justified_nullification").alias("_justified"),
        pool("unjustified_change", "field_decision_conflict").alias("_unjustified"),
        pool("justified_nullification", "unjustified_nullification").alias("_nulled"),
        pool("unjustified_nullification").alias("_nulled_unjustly"),
        pool("regression", "unjustified_nullification").alias("_regressed"),
    )
    ratio = lambda a, b="valid_pool": F.round(F.try_divide(F.col(a), F.col(b)), 6)
    return told.select(
        "valid_pool",
        "defective_pool",
        ratio("_preserved").alias("preservation_precision"),
        ratio("_repaired", "defective_pool").alias("repair_recall"),
        ratio("_justified").alias("justified_change_rate"),
        ratio("_unjustified").alias("unjustified_change_rate"),
        ratio("_nulled").alias("nullification_rate"),
        ratio("_nulled_unjustly").alias("unjustified_nullification_rate"),
        ratio("_regressed").alias("regression_rate"),
    )


def source_type(kind: Column) -> Column:
    """Where the value that a field ends up with comes from."""
    return F.when(kind.isin("preserved", "redundant_replace"), "legacy_preserved").when(kind == "repair", "deterministic_repair").when(kind.isin("justified_nullification", "unjustified_nullification", "remain_null"), "null").otherwise("llm_changed")
