"""What becomes of earlier values: typed fields compared, decisions read, classes, pools and rates.

An earlier record, a candidate and the decisions about its fields are JSON texts.  A value may be a text, a list, an
object (its values in the order of the text) or nothing; lists are compared item by item, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm, strip
from ..functions.values import field_validity, reason_suffices
from .artifacts import candidate_cursor
from .rules import source_type

# The fields in order, and what each is.
KINDS = {"definition_en": "definition", "explanation_ar": "explanation", "examples": "examples", "translations": "translations", "synonyms": "relations", "antonyms": "relations", "collocations": "relations", "mnemonic": "mnemonic"}
_TEXTS = ("definition", "explanation", "mnemonic")
#: What stands for an item that is null: a value, but neither blank nor a word for nothing.
_NULL_ITEM = "(null)"


def ladder(old_has: Column, old_valid: Column, new_has: Column, new_valid: Column, same: Column, action: Column, reason: Column, superior: Column, defect: Column, argued: Column, state: Column) -> Column:
    """The class of a field, the first that holds.

    ``action`` is what was declared: ``replace``, ``improve`` or ``improve/replace``; ``null``; ``preserve``; anything
    else and nothing declare nothing.  ``state`` is the declared state of the old value, in any case and with ``-`` or
    ``_``.  ``reason`` says that a reason was given, ``superior`` that the new value was declared better, ``defect`` and
    ``argued`` that the old one was declared faulty and that this was argued for; unknown counts as no.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    old_has, old_valid, new_has, new_valid, same, reason, superior, defect, argued = map(yes, (old_has, old_valid, new_has, new_valid, same, reason, superior, defect, argued))
    said = F.replace(F.lower(strip(state)), F.lit("-"), F.lit("_"))
    replaces = yes(action.isin("replace", "improve", "improve/replace"))
    empties, keeps = yes(action == "null"), yes(action == "preserve")
    conflict = (yes(said == "null") & old_has) | (yes(said == "non_null") & ~old_has) | (empties & new_valid)
    return (
        F.when(conflict, "field_decision_conflict")
        .when(~old_has, F.when(new_valid, "fill").otherwise("remain_null"))
        .when(same, F.when(replaces, "redundant_replace").otherwise("preserved"))
        .when(~old_valid, F.when(new_valid, "repair").otherwise("changed_defective"))
        .when(~new_valid & ~new_has, F.when(empties & defect & argued, "justified_nullification").otherwise("unjustified_nullification"))
        .when(~new_valid, "regression")
        .when(replaces & reason & superior, "changed")
        .when(keeps, "field_decision_conflict")
        .otherwise("unjustified_change")
    )


def _plain(v: Column) -> Column:
    """An item as a text: itself if it is one, else its JSON."""
    kind = F.schema_of_variant(v)
    return F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind == "VOID", _NULL_ITEM).otherwise(F.to_json(v))


def _example(v: Column) -> Column:
    part = lambda k: F.nullif(F.try_variant_get(v, k, "string"), F.lit(""))
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), F.coalesce(part("$.example_text"), part("$.text"), F.lit(""))).otherwise(_plain(v))


def typed_values(rows: DataFrame, sides: dict[str, tuple[str, str, str, str]], word: str) -> DataFrame:
    """``rows`` with a struct ``has, valid, fault, said`` by each name in ``sides``: (JSON text, the same as VARIANT, path, kind).

    ``said`` is what is compared: a text with its case and white space levelled, texts of examples, or the JSON of items.  The values
    are made step by step, so that none is worked out more often than once.
    """
    node, shape, text, texts = ({k: f"_{k}_{what}" for k in sides} for what in ("node", "shape", "text", "texts"))
    lists = {k: v for k, v in sides.items() if v[3] not in _TEXTS}
    out = rows.withColumns({node[k]: F.try_variant_get(parsed, path, "variant") for k, (_, parsed, path, _) in sides.items()})
    out = out.withColumns({shape[k]: F.coalesce(F.schema_of_variant(node[k]), F.lit("VOID")) for k in sides})
    none = F.array().cast("array<variant>")
    inner = lambda raw, path: F.map_values(F.from_json(F.get_json_object(raw, path), "map<string,variant>"))
    items = {
        k: F.when(F.col(shape[k]) == "VOID", none).when(F.startswith(shape[k], F.lit("ARRAY")), F.try_variant_get(node[k], "$", "array<variant>")).when(F.startswith(shape[k], F.lit("OBJECT")), inner(raw, path)).otherwise(F.array(node[k]))
        for k, (raw, _, path, _) in lists.items()
    }
    out = out.withColumns({text[k]: F.when(F.col(shape[k]) == "STRING", F.try_variant_get(node[k], "$", "string")) for k in sides if k not in lists})
    held = {k: f"_{k}_items" for k in lists}
    out = out.withColumns({held[k]: items[k] for k in lists})
    out = out.withColumns({texts[k]: F.filter(F.transform(held[k], _example), lambda x: x != "") if sides[k][3] == "examples" else F.transform(held[k], _plain) for k in lists})
    told = {k: f"_{k}_told" for k in sides}
    out = out.withColumns({told[k]: field_validity(v[3], F.col(texts[k] if k in lists else text[k]), F.col(word)) for k, v in sides.items()})
    json_of = lambda k: F.transform(held[k], lambda x: F.to_json(x))
    said = {k: F.array(norm(F.col(text[k]))) if k not in lists else F.col(texts[k]) if v[3] == "examples" else json_of(k) for k, v in sides.items()}
    has = {k: F.exists(texts[k], lambda x: strip(x) != "") if k in lists and v[3] != "examples" else F.size(texts[k]) > 0 if k in lists else F.coalesce(strip(F.col(text[k])) != "", F.lit(False)) for k, v in sides.items()}
    out = out.withColumns({k: F.struct(has[k].alias("has"), F.col(f"{told[k]}.valid").alias("valid"), F.col(f"{told[k]}.why").alias("fault"), said[k].alias("said")) for k in sides})
    return out.drop(*[c for d in (node, shape, text, texts, told, held) for c in d.values()])


def preserved_fields(rows: DataFrame, seed: str, candidate: str, decisions: str, word: str, into: str = "fields") -> DataFrame:
    """``rows`` with ``into``: an array of ``field, category, source, action, old_has, old_valid, old_fault, new_fault``.

    All eight fields in one pass.  A candidate's mnemonic is ``mnemonic_ar`` where it has that key.  What is no JSON
    object has no fields, and a decision that is no object declares nothing.  An item that is no text is compared by
    its JSON.
    """
    laid = rows.withColumns({f"_{k}": F.try_parse_json(F.col(v)) for k, v in (("s", seed), ("c", candidate), ("d", decisions))})
    sides = {f"_old_{f}": (seed, "_s", f"$.{f}", k) for f, k in KINDS.items()} | {f"_new_{f}": (candidate, "_c", f"$.{f}", k) for f, k in KINDS.items()}
    sides["_new_mnemonic_ar"] = (candidate, "_c", "$.mnemonic_ar", "mnemonic")
    laid = typed_values(laid, sides, word)
    laid = laid.withColumn("_new_mnemonic", F.when(F.try_variant_get("_c", "$.mnemonic_ar", "variant").isNotNull(), F.col("_new_mnemonic_ar")).otherwise(F.col("_new_mnemonic")))
    laid = laid.withColumns({f"_say_{f}": F.try_variant_get("_d", f"$.{f}", "variant") for f in KINDS})
    parts = []
    for field in KINDS:
        about = lambda k, field=field: F.try_variant_get(f"_say_{field}", f"$.{k}", "variant")
        told = lambda k, about=about: F.when(F.schema_of_variant(about(k)) == "STRING", F.try_variant_get(about(k), "$", "string"))
        true = lambda k, about=about: (F.schema_of_variant(about(k)) == "BOOLEAN") & F.try_variant_get(about(k), "$", "boolean")
        parts.append(F.struct(F.lit(field).alias("field"), F.col(f"_old_{field}").alias("old"), F.col(f"_new_{field}").alias("new"), told("action").alias("action"), (told("reason") != "").alias("reason"), true("replacement_superiority").alias("superior"), true("legacy_defect").alias("defect"), told("evidence").alias("evidence"), told("legacy_state").alias("state")))

    def judged(x: Column) -> Column:
        kind = ladder(x["old"]["has"], x["old"]["valid"], x["new"]["has"], x["new"]["valid"], x["old"]["said"] == x["new"]["said"], x["action"], x["reason"], x["superior"], x["defect"], reason_suffices(x["evidence"])["suffices"], x["state"])
        return F.struct(x["field"].alias("field"), kind.alias("category"), x["action"].alias("action"), x["old"]["has"].alias("old_has"), x["old"]["valid"].alias("old_valid"), x["old"]["fault"].alias("old_fault"), x["new"]["fault"].alias("new_fault"))

    laid = laid.withColumn("_parts", F.array(*parts)).withColumn("_judged", F.transform("_parts", judged))
    sourced = F.transform("_judged", lambda x: F.struct(x["field"].alias("field"), x["category"].alias("category"), source_type(x["category"]).alias("source"), *[x[k].alias(k) for k in ("action", "old_has", "old_valid", "old_fault", "new_fault")]))
    return laid.select(*rows.columns, sourced.alias(into))


def field_report(fields: Column) -> Column:
    """Of one record's fields: the pools, counts by class within them, and the seven rates (null where a pool is empty)."""
    valid = F.filter(fields, lambda x: x["old_has"] & x["old_valid"])
    defective = F.filter(fields, lambda x: x["old_has"] & ~x["old_valid"])
    n = lambda pool, *kinds: F.size(F.filter(pool, lambda x: x["category"].isin(*kinds)))
    counts = {
        "preserved": n(valid, "preserved"),
        "changed": n(valid, "changed"),
        "justified_nullification": n(valid, "justified_nullification"),
        "unjustified_nullification": n(valid, "unjustified_nullification"),
        "regression": n(valid, "regression"),
        "unjustified_change": n(valid, "unjustified_change"),
        "declaration_conflicts": n(valid, "field_decision_conflict"),
        "redundant_replace": n(valid, "redundant_replace"),
        "repair": n(defective, "repair"),
    }
    c, pool = counts, F.size(valid)
    rate = lambda x, of: F.try_divide(x, of)
    return F.struct(
        pool.alias("legacy_valid_pool"),
        F.size(defective).alias("legacy_defective_pool"),
        rate(c["preserved"], pool).alias("preservation_precision"),
        rate(c["repair"], F.size(defective)).alias("repair_recall"),
        rate(c["changed"] + c["justified_nullification"], pool).alias("justified_change_rate"),
        rate(c["unjustified_change"] + c["declaration_conflicts"], pool).alias("unjustified_change_rate"),
        rate(c["justified_nullification"] + c["unjustified_nullification"], pool).alias("nullification_rate"),
        rate(c["unjustified_nullification"], pool).alias("unjustified_nullification_rate"),
        rate(c["regression"] + c["unjustified_nullification"], pool).alias("regression_rate"),
        F.struct(*[x.alias(k) for k, x in c.items()]).alias("counts"),
    )


def import_decisions(lines: DataFrame, submitted: DataFrame, line: str = "line") -> DataFrame:
    """Output lines of a decision batch (B6): ``key, error, decisions_status, lemma, pos, cefr, fields, report``.

    ``submitted`` maps each ``key`` to ``lemma, pos, cefr``, the earlier record ``seed`` and the ``candidate`` of the
    generation before (both JSON texts).  Blank lines are no lines.  ``error`` is the first of malformed line, missing
    key, unknown key, an error of the batch, decisions that are no JSON object.  The first three say nothing of a record;
    after the others its fields are judged with nothing declared.  ``decisions_status`` is ``ok``, ``missing`` (an empty
    object) or the error.  A key that comes twice is judged twice.
    """
    v = F.try_parse_json(F.col("_line"))
    told = lines.select(strip(F.col(line)).alias("_line")).where("_line <> ''").select(F.when(F.schema_of_variant(v).startswith("OBJECT"), v).alias("_v"))
    key = F.try_variant_get("_v", "$.key", "string")
    told = told.withColumn("key", key).join(submitted.withColumnRenamed("key", "_sent"), F.col("key") == F.col("_sent"), "left")
    answer = F.try_variant_get("_v", "$.response.candidates[0].content.parts[0].text", "string")
    parsed = F.try_parse_json(strip(answer))
    given = F.schema_of_variant(parsed).startswith("OBJECT")
    failed = F.try_variant_get("_v", "$.error", "variant").isNotNull()
    error = (
        F.when(F.col("_v").isNull(), "malformed_line")
        .when(F.coalesce(F.col("key") == "", F.lit(True)), "missing_key")
        .when(F.col("_sent").isNull(), "unknown_key")
        .when(failed, "batch_api_error")
        .when(~F.coalesce(given, F.lit(False)), "decisions_parse_failed")
    )
    told = told.withColumn("error", error).withColumn("_decisions", F.when(F.col("error").isNull(), strip(answer)))
    told = told.withColumn("_cursor", F.to_json(candidate_cursor(F.col("candidate")), {"ignoreNullFields": "false"}))
    told = preserved_fields(told, "seed", "_cursor", "_decisions", "lemma")
    known = F.col("_sent").isNotNull()
    status = F.when(F.col("error").isNotNull(), F.concat(F.lit("error: "), F.col("error"))).when(F.size(F.json_object_keys("_decisions")) > 0, "ok").otherwise("missing")
    fields = F.when(known, F.col("fields"))
    return told.select("key", "error", F.when(known, status).alias("decisions_status"), "lemma", "pos", "cefr", fields.alias("fields")).withColumn("report", F.when(F.col("fields").isNotNull(), field_report(F.col("fields"))))


def seed_features(rows: DataFrame, seed: str, word: str, pos: str, technical: list[str], separators: list[str], few: int = 5) -> DataFrame:
    """``rows`` with all that a draw looks at in an earlier record's JSON.

    ``key, pos_group, mnemonic_null, examples_contract, examples_target_all, examples_count, translations_multi,
    relations_total, relations_poor, definition_valid, definition_len, multi_pos, technical``.  ``multi_pos`` is by the
    parts of speech that a word has in ``rows``, blank counting as one; ``translations_multi`` looks for separators in
    the text, of a list or an object in its JSON.  A record that is no JSON object has empty fields.
    """
    from ..functions.text import contains_target, pos_group

    laid = rows.withColumns({"_s": F.try_parse_json(F.col(seed)), "_w": F.lower(strip(F.col(word))), "_p": F.lower(strip(F.coalesce(F.col(pos), F.lit(""))))})
    laid = typed_values(laid, {f"_x_{f}": (seed, "_s", f"$.{f}", k) for f, k in KINDS.items()}, word)
    text = lambda f: F.try_variant_get("_s", f"$.{f}", "variant")
    shown = lambda f: F.coalesce(F.when(F.schema_of_variant(text(f)) == "STRING", F.try_variant_get("_s", f"$.{f}", "string")).when(F.schema_of_variant(text(f)) != "VOID", F.to_json(text(f))), F.lit(""))
    kinds = laid.groupBy(F.col("_w").alias("_g")).agg(F.min("_p").alias("_lo"), F.max("_p").alias("_hi"))
    said = lambda f: F.transform(F.col(f"_x_{f}.said"), lambda x: x)
    # The items of relations are kept as JSON; a blank one is a text of white space.
    total = sum((F.size(F.filter(said(f), lambda x: ~x.rlike(r'^"\s*"$'))) for f in ("synonyms", "antonyms", "collocations")), F.lit(0))
    told = laid.join(kinds, F.col("_w") == F.col("_g"), "left").withColumns({"_total": total, "_texts": said("examples"), "_trans": shown("translations")})
    return told.select(
        *rows.columns,
        F.concat_ws("/", "_w", "_p").alias("key"),
        pos_group(F.col("_p")).alias("pos_group"),
        (~F.col("_x_mnemonic.has")).alias("mnemonic_null"),
        F.col("_x_examples.valid").alias("examples_contract"),
        ((F.size("_texts") == 3) & F.forall("_texts", lambda x: contains_target(x, F.col(word)))).alias("examples_target_all"),
        F.size("_texts").alias("examples_count"),
        F.exists(F.array(*map(F.lit, separators)), lambda s: F.contains(F.col("_trans"), s)).alias("translations_multi"),
        F.col("_total").alias("relations_total"),
        (F.col("_total") <= few).alias("relations_poor"),
        F.col("_x_definition_en.valid").alias("definition_valid"),
        F.char_length(shown("definition_en")).alias("definition_len"),
        F.coalesce(F.col("_lo") != F.col("_hi"), F.lit(False)).alias("multi_pos"),
        F.coalesce(F.try_variant_get("_s", "$.category", "string").isin(technical), F.lit(False)).alias("technical"),
    )
