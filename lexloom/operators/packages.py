"""Blind packages: items with two arms under neutral labels, their private map, prompts, runs that can go on."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import examples
from .contracts import blank_ballot
from .ranking import global_position
from .sampling import side_of_a


def candidate_arm(raw: Column) -> Column:
    """The arm of a generated output, from its JSON text."""
    v = F.try_parse_json(raw)
    text = lambda p: F.try_variant_get(v, p, "string")
    listed = lambda p: F.coalesce(F.try_variant_get(v, p, "array<string>"), F.array().cast("array<string>"))
    kind = F.schema_of_variant(F.try_variant_get(v, "$.examples", "variant"))
    said = F.when(kind.startswith("ARRAY<OBJECT"), F.transform(F.try_variant_get(v, "$.examples", "array<struct<example_text:string>>"), lambda e: e["example_text"])).otherwise(listed("$.examples"))
    return _arm(text("$.definition_en"), text("$.explanation_ar"), said, text("$.translations.arabic_ar"), listed("$.synonyms"), listed("$.antonyms"), listed("$.collocations"), text("$.mnemonic_ar"))


def legacy_arm(definition: Column, explanation: Column, sentences: Column, translations: Column, synonyms: Column, antonyms: Column, collocations: Column, mnemonic: Column) -> Column:
    """The arm of an earlier row, in the same shape; lists are JSON text, and levels of examples do not show.

    Collocations are shown as they are: leaving them out of one arm only would tell the arms apart.
    """
    listed = lambda x: F.coalesce(F.from_json(x, "array<string>"), F.array().cast("array<string>"))
    return _arm(definition, explanation, F.transform(examples(sentences), lambda e: e["text"]), translations, listed(synonyms), listed(antonyms), listed(collocations), mnemonic)


def _arm(definition, explanation, sentences, translations, synonyms, antonyms, collocations, mnemonic) -> Column:
    relations = F.struct(synonyms.alias("synonyms"), antonyms.alias("antonyms"), collocations.alias("collocations"))
    return F.struct(definition.alias("definition"), explanation.alias("arabic"), sentences.alias("examples"), translations.alias("translations"), relations.alias("relations"), mnemonic.alias("mnemonic"))


def items(candidates: DataFrame, legacy: DataFrame, identities: DataFrame, key: str) -> DataFrame:
    """Identities with both arms (Z7): ``key, lemma, pos, candidate, legacy`` for keys that have all three."""
    return identities.select(key, "lemma", "pos").join(candidates.select(key, "candidate"), key).join(legacy.select(key, "legacy"), key)


def blind_package(rows: DataFrame, key: str, name: str, seed: str) -> tuple[DataFrame, DataFrame]:
    """The package and its private map.

    Items are numbered ``name-0001`` on in the order of their keys; a fair coin of seed and key says which arm
    is shown as A.  The package holds nothing that tells; the map says what stood where.
    """
    told = global_position(rows.withColumn("_a", side_of_a(seed, F.col(key))), [F.col(key)], "_n")
    told = told.withColumn("eval_id", F.format_string(f"{name}-%04d", "_n"))
    a, b = (F.when(F.col("_a") == side, F.col("candidate")).otherwise(F.col("legacy")) for side in ("candidate", "legacy"))
    package = told.select("eval_id", "lemma", "pos", a.alias("armA"), b.alias("armB"), blank_ballot().alias("ballot"))
    return package, told.select("eval_id", F.when(F.col("_a") == "candidate", "A").otherwise("B").alias("candidate_side"), F.col(key).alias("candidate_key"))


def leaking_items(package: DataFrame) -> DataFrame:
    """``eval_id, leaks`` of items in which something has the shape of an identifier."""
    from .contracts import leaks

    found = leaks(F.to_json(F.struct("lemma", "pos", "armA", "armB")))
    return package.select("eval_id", found.alias("leaks")).where(F.size("leaks") > 0)


def judge_prompts(package: DataFrame, rubric: str, request: str) -> DataFrame:
    """``eval_id, prompt``: the rubric, what is asked for, and the blind view, of five named fields and no others."""
    view = F.to_json(F.struct("armA", "armB", "eval_id", "lemma", "pos"), {"ignoreNullFields": "false"})
    return package.select("eval_id", F.concat(F.lit(f"{rubric}\n\n{request}\n"), view).alias("prompt"))


def templated(template: str, fields: dict[str, Column]) -> Column:
    """A template with ``{name}`` replaced by each field's text (S13, B2, Z27); what fields hold is not read again."""
    out, rest = [], template
    while rest:
        places = sorted((rest.find("{" + n + "}"), n) for n in fields if "{" + n + "}" in rest)
        if not places:
            out.append(F.lit(rest))
            break
        at, name = places[0]
        out += [F.lit(rest[:at]), F.coalesce(fields[name].cast("string"), F.lit(""))]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*out)


def envelopes(manifest: DataFrame, master: DataFrame, key: str, template: str, prefix: str, config: dict) -> DataFrame:
    """``key, line`` of every entry of a frozen manifest (B3); fails if one is unknown or its lemma or part of speech drifted."""
    own = master.select(F.col(key).alias("_m"), F.col("lemma").alias("_lemma"), F.col("pos").alias("_pos"))
    told = manifest.join(own, F.col(key) == F.col("_m"), "left")
    same = F.col("_m").isNotNull() & F.col("lemma").eqNullSafe(F.col("_lemma")) & F.col("pos").eqNullSafe(F.col("_pos"))
    sound = F.when(~same, F.raise_error(F.concat(F.lit("manifest and master differ: "), F.col(key).cast("string")))).otherwise(F.concat(F.lit(prefix + "-CAND-"), F.col(key).cast("string")))
    prompt = templated(template, {c: F.col(c) for c in ("lemma", "pos", "cefr", key)})
    less = lambda x, front, back: F.substring(x, F.lit(1 + front), F.length(x) - front - back)
    request = F.to_json(F.struct(F.array(F.struct(F.lit("user").alias("role"), F.array(F.struct(prompt.alias("text"))).alias("parts"))).alias("contents")))
    body = F.concat(F.lit('{"key":'), less(F.to_json(F.array(F.col("_key"))), 1, 1), F.lit(',"request":'), less(request, 0, 1), F.lit(f',"generationConfig":{json.dumps(config, sort_keys=True)}}}}}'))
    return told.withColumn("_key", sound).select(F.col("_key").alias("key"), body.alias("line"))


def generation_records(rows: DataFrame, key: str, groups: dict[str, list[str]], output: str, status: str, known: list[str]) -> DataFrame:
    """``key, record`` of each output (Z11): the named groups and the output's hash, never the output itself.

    A missing field or an unknown status fails.
    """
    from .records import missing_fields

    gaps = missing_fields(groups)
    wrong = F.when(F.size(gaps) > 0, F.concat(F.lit("missing "), F.array_join(gaps, ","))).when(~F.coalesce(F.col(status).isin(known), F.lit(False)), "unknown status")
    record = F.to_json(F.struct(*[F.struct(*[F.col(f"{g}.{f}").alias(f) for f in sorted(fs)]).alias(g) for g, fs in sorted(groups.items())], F.struct(F.sha2(output, 256).alias("output_hash"), F.col(status).alias("status")).alias("integrity")))
    return rows.select(key, F.when(wrong.isNotNull(), F.raise_error(wrong)).otherwise(record).alias("record"))


def run_remaining(work: DataFrame, done: DataFrame, key: str, prompt: str, generate: Callable[[str], str], accept: Callable[[str], bool], retries: int = 2) -> DataFrame:
    """``key, attempts, answer`` of all work that is not done (B8, B10): each prompt until an answer is accepted.

    ``generate`` and ``accept`` run on the executors.  Where ``retries`` more attempts do not help, the answer is
    null: never a guess.  Append the result to ``done`` (only rows with an answer) and a later run goes on.
    """
    import pandas as pd

    kind = work.schema[key].dataType.simpleString()

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, text in zip(frame[key], frame[prompt], strict=True):
                for attempt in range(1, retries + 2):
                    try:
                        answer = generate(text)
                        answer = answer if accept(answer) else None
                    except Exception:  # a failed call is a failed attempt
                        answer = None
                    if answer is not None:
                        break
                out.append((k, attempt, answer))
            yield pd.DataFrame(out, columns=[key, "attempts", "answer"])

    return work.join(done.select(key), key, "left_anti").select(key, prompt).mapInPandas(each, f"{key} {kind}, attempts int, answer string")


def recorded_verdicts(table: DataFrame, key: str, fields: list[str], cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A reviewer's table of verdicts, a column a field, as ballots (B12), and the keys that name no card."""
    lost = table.select(key).join(cards.select(key), key, "left_anti")
    pairs = F.map_from_entries(F.array(*[F.struct(F.lit(f), F.coalesce(F.col(f), F.lit("unjudged"))) for f in fields]))
    return table.join(cards.select(key), key, "left_semi").select(key, pairs.alias("fields")), lost
