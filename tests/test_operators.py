import pytest
from pyspark.sql import functions as F

from lexloom.operators import adjudication, batch, cohorts, contracts, evidence, levels, migration, quality, ranking, records, rules, sampling


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_global_position_counts_every_row(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), "id")
    got = ranking.global_position(df, [F.col("k")], "n")
    assert got.where("n <> k + 1").count() == 0 and got.count() == 1000


def test_duplicates_get_ranks_by_part_of_speech(spark):
    df = spark.createDataFrame([("run", "noun", 5), ("run", "verb", 9), ("run", "adj", 2), ("sun", "noun", 7)], "word string, pos string, rank int")
    got = ranking.reorder_duplicates(df, "word", "pos", "rank").select("word", "pos", "new_rank")
    assert rows(got, "word", "new_rank") == [("run", "verb", 2), ("run", "noun", 5), ("run", "adj", 9), ("sun", "noun", 7)]


def test_copies_are_spaced(spark):
    df = spark.createDataFrame([("a", "A1", 1), ("a", "A1", 2), *[(f"w{i}", "B1", i) for i in range(3, 203)]], "word string, level string, rank int")
    got = {(r.word, r["rank"]): r.new_rank for r in ranking.space_copies(df, "word", "level", "rank").collect()}
    assert got["a", 1] == 1 and got["a", 2] == 100 and got["w3", 3] == 2


@pytest.mark.parametrize(("level", "pos", "rank", "word", "score"), [("A1", "num", 500, "ten", 2), ("C2", "conj", 9000, "notwithstanding", 10), (None, None, None, "cat", 5), ("A1", "noun", 1, "cat", 2)])
def test_difficulty_is_half_even_and_bounded(spark, level, pos, rank, word, score):
    df = spark.createDataFrame([(level, pos, rank, word)], "l string, p string, r int, w string")
    assert df.select(levels.difficulty(F.col("l"), F.col("p"), F.col("r"), F.col("w"))).first()[0] == score


def test_units_spread_evenly_not_as_ntile(spark):
    df = spark.createDataFrame([("A1", f"w{i:02d}", i) for i in range(10)], "level string, word string, rank int")
    got = levels.assign_units(df, "level", "word", "rank", per_unit=3).groupBy("unit_id").count()
    assert rows(got, "unit_id") == [("A1_01", 3), ("A1_02", 2), ("A1_03", 3), ("A1_04", 2)]


def test_exactly_one(spark):
    master = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, id int")
    got = evidence.exactly_one(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), master, "k", ["id"])
    assert rows(got, "k") == [("a", 1, "ok", 1), ("b", 2, "ambiguous", None), ("c", 0, "not found", None)]


def test_cascade_first_class_wins(spark):
    master = evidence.universe(spark.createDataFrame([("run", "verb")], "lemma string, pos string"), "lemma", "pos")
    df = spark.createDataFrame([(1, " ", "noun"), (2, "run up", "verb"), (3, "zap", "noun"), (4, "run", None), (5, "run", "verb"), (6, "run", "noun"), (7, None, None)], "id int, lemma string, pos string")
    got = [r["class"] for r in evidence.cascade(df, master, "lemma", "pos").orderBy("id").collect()]
    assert got == [*evidence.CLASSES, "UNRESOLVED_MALFORMED"]


def test_accounting_aborts_on_anything_odd(spark):
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    lines = spark.createDataFrame([("a", 1, False, False), ("a", 2, False, False), ("z", 3, False, False), ("b", 4, True, False), ("b", 5, False, True), (None, 6, False, False)], "k string, line int, bad boolean, err boolean")
    told = batch.account(lines, expected, "k", "line", F.col("bad"), F.col("err"))
    assert [r.outcome for r in told.orderBy("line").collect()] == ["successful", "duplicate", "unknown", "malformed", "failed", "unknown"]
    got = batch.accounting(told, expected, "k").first()
    assert (got.mapped, got.missing, got.unknown, got.aborts) == (2, 1, 2, True)


def test_allocation_sums_and_takes_small_cells_whole(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 2), ("c", 50), ("d", 30), ("e", 20)], "cell string, size long")
    got = {r.cell: r.quota for r in sampling.allocate(sizes, "cell", "size", 23).collect()}
    assert got == {"a": 1, "b": 2, "c": 10, "d": 6, "e": 4}
    with pytest.raises(Exception, match="floors exceed"):
        sampling.allocate(sizes, "cell", "size", 4).collect()


def test_sample_is_the_same_each_time_and_another_with_another_seed(spark):
    df = spark.range(200).select("id", F.lit("x").alias("cell"))
    quota = spark.createDataFrame([("x", 20)], "cell string, quota long")
    draw = lambda seed, n: [r.id for r in sampling.stratified(df.repartition(n), quota, "cell", "id", seed, 20).orderBy("id").collect()]
    assert draw("s", 1) == draw("s", 7) and len(draw("s", 3)) == 20 and draw("s", 1) != draw("t", 1)


def test_agreement_order(spark):
    df = spark.createDataFrame([("tie", "tie"), ("cannot-judge", "cannot-judge"), ("unjudged", "legacy"), ("candidate", "legacy"), ("tie", "legacy")], "h string, m string")
    assert [r[0] for r in df.select(adjudication.agreement(F.col("h"), F.col("m"))).collect()] == ["agree", "agree", "abstain", "flip", "mismatch"]


def test_migration_applies_verifies_and_undoes(spark):
    before = spark.createDataFrame([(1, "a", 10), (2, None, 20), (3, "c", None)], "id long, name string, n int")
    changes = spark.createDataFrame([(1, "name", "a", "A"), (2, "name", None, "B"), (3, "n", None, "30")], "id long, field string, before string, after string")
    assert migration.drifted(changes, before, "id").count() == 0
    after = migration.apply_cells(before, changes, "id", ["name", "n"])
    assert rows(after, "id") == [(1, "A", 10), (2, "B", 20), (3, "c", 30)]
    assert rows(migration.differences(before, after, "id"), "id") == rows(changes, "id")
    bad = spark.createDataFrame([(1, "name", "x", "A"), (9, "name", "a", "b"), (1, "n", "10", "10")], "id long, field string, before string, after string")
    assert {r.why for r in migration.drifted(bad, before, "id").collect()} == {"drift", "unknown cell", "no change"}
    assert migration.logical_hash(before).first() == migration.logical_hash(before.repartition(5)).first() != migration.logical_hash(after).first()


def test_quality_and_rates(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, " ")], "id int, v string")
    assert rows(quality.repeated_keys(df, ["id"], "pk"), "entity") == [("pk", "1", "2")]
    assert rows(quality.null_rates(df, ["v"]), "field") == [("v", 2, 0.6667)]
    assert [r.rejected for r in quality.gate(df, {"NO_VALUE": F.trim("v") != ""}).orderBy("id", F.col("v").desc()).collect()] == [[], ["NO_VALUE"], ["NO_VALUE"]]


@pytest.mark.parametrize(
    ("old", "new", "action", "ov", "nv", "state", "ok", "kind"),
    [
        ("", "x", "replace", False, True, None, True, "fill"),
        ("", "", "null", False, False, None, True, "remain_null"),
        ("x", "X ", "preserve", True, True, None, True, "preserved"),
        ("x", "x", "improve", True, True, None, True, "redundant_replace"),
        ("x", "y", "replace", False, True, None, True, "repair"),
        ("x", "y", "replace", False, False, None, True, "changed_defective"),
        ("x", "", "null", True, False, None, True, "justified_nullification"),
        ("x", "", "null", True, False, None, False, "unjustified_nullification"),
        ("x", "bad", "replace", True, False, None, True, "regression"),
        ("x", "y", "replace", True, True, None, True, "changed"),
        ("x", "y", "replace", True, True, None, False, "unjustified_change"),
        ("x", "y", "preserve", True, True, None, True, "field_decision_conflict"),
        ("x", "y", "replace", True, True, "null", True, "field_decision_conflict"),
    ],
)
def test_preservation_ladder(spark, old, new, action, ov, nv, state, ok, kind):
    df = spark.range(1)
    c = rules.preservation(F.lit(old), F.lit(new), F.lit(action), F.lit(ov), F.lit(nv), F.lit(state).cast("string"), F.lit(ok), F.lit(ok), F.lit(ok), F.lit(ok))
    assert df.select(c).first()[0] == kind


def test_quota_breach_is_strict(spark):
    df = spark.createDataFrame([("definition", "KEEP")] * 8 + [("definition", "LLM_REVIEW")] * 2, "field string, status string")
    assert rules.quota_report(df).first().breached is False


def test_a_null_is_written_and_restored(spark):
    before = spark.createDataFrame([(1, None, 5), (2, "b", 6)], "id long, name string, n int")
    changes = spark.createDataFrame([(1, "name", None, "new"), (2, "name", "b", None)], "id long, field string, before string, after string")
    after = migration.apply_cells(before, changes, "id", ["name", "n"])
    assert rows(after, "id") == [(1, "new", 5), (2, None, 6)]
    back = migration.rolled_back(after, migration.audit_rows(changes, "id"), "id", ["name", "n"])
    assert rows(back, "id") == rows(before, "id")


def test_logical_hash_tells_separators_nulls_and_repeats_apart(spark):
    of = lambda *data: migration.logical_hash(spark.createDataFrame(list(data), "a string, b string")).first().sha256
    hashes = [of(("a|b", "c")), of(("a", "b|c")), of(("a", None)), of(("a", "null")), of(("a", "")), of(("a", "b"), ("a", "b")), of(("a", "b"))]
    assert len(set(hashes)) == len(hashes)


def test_a_null_scope_keeps_its_words(spark):
    words = spark.createDataFrame([("en", "a"), ("en", "a"), ("en", "b"), (None, "a")], "scope string, word string")
    got = ranking.word_frequency(words, "scope", "word")
    assert sorted((r.scope or "", r.word, r.n, r.zipf) for r in got.collect()) == [("", "a", 1, 9.0), ("en", "a", 2, 8.823909), ("en", "b", 1, 8.522879)]


def test_ranks_of_one_value_that_most_rows_have(spark):
    df = spark.range(5000).selectExpr("id", "if(id < 4900, 1, id) as v", "'s' as s")
    got = ranking.dense_rank_in_scope(df, "s", "v")
    assert got.count() == 5000 and got.where("v = 1 and rank <> 101").count() == 0 and got.where("v = 4999").first()["rank"] == 1


def test_observations_of_two_scopes_are_refused(spark):
    df = spark.createDataFrame([("apple", "v1", 5.0, 1), ("banana", "v1", 5.0, 2), ("cat", "v1", 4.9, 3), ("cat", "v1", 4.8, 4)], "w string, version string, zipf double, seq int")
    got = ranking.ranked_observations(df, ["w"], ["version"], "zipf", "seq")
    assert rows(got.select("w", "rank", "zipf"), "w") == [("apple", 1, 5.0), ("banana", 1, 5.0), ("cat", 2, 4.8)]
    with pytest.raises(ValueError, match="several scopes"):
        ranking.ranked_observations(df.union(spark.createDataFrame([("dog", "v2", 1.0, 5)])), ["w"], ["version"], "zipf", "seq")


def test_selection_hash_in_several_levels(spark):
    import hashlib

    keys = sorted(str(i) for i in range(1000))
    runs = [hashlib.sha256("\n".join(keys[i : i + 7]).encode()).hexdigest() for i in range(0, 1000, 7)]
    while len(runs) > 1:
        runs = [hashlib.sha256("\n".join(runs[i : i + 7]).encode()).hexdigest() for i in range(0, len(runs), 7)]
    df = spark.range(1000).repartition(9)
    assert tuple(records.selection_hash(df, "id", chunk=7).first()) == (1000, runs[0])
    assert records.selection_hash(df.where("false"), "id").first().n == 0


def plain_draw(cards, quotas, floors, total, key):
    """The greedy draw row by row."""
    (a, qa), (b, qb) = quotas.items()
    left, taken = {c["id"]: c for c in cards}, []
    need, covered = [dict(qa), dict(qb)], dict.fromkeys(floors, 0)

    def take(c, turn):
        taken.append((c["id"], turn))
        del left[c["id"]]
        for n, col in zip(need, (a, b), strict=True):
            n[c[col]] = n.get(c[col], 0) - 1
        for f in floors:
            covered[f] += c[f]

    for c in [c for c in cards if c["must"]]:
        take(c, 0)
    turn = 0
    while len(taken) < total:
        wants = [sorted((-v, k) for k, v in n.items() if v > 0) for n in need]
        if not all(wants):
            break
        x, y = wants[0][0][1], wants[1][0][1]
        for test in (lambda c: c[a] == x and c[b] == y, lambda c: c[a] == x, lambda c: c[b] == y, lambda c: True):
            some = [c for c in left.values() if test(c)]
            if some:
                break
        else:
            break
        turn += 1
        take(min(some, key=lambda c: (-sum(c[f] and covered[f] < floors[f] for f in floors), key(c["id"]), c["id"])), turn)
    return sorted(taken)


def test_greedy_draw_equals_a_draw_row_by_row(spark):
    import hashlib
    import random

    rng = random.Random(3)
    cards = [{"id": i, "pos": rng.choice(["noun", "verb", "adj"]), "level": rng.choice(["A1", "B1", "C1"]), "tech": rng.random() < 0.1, "multi": rng.random() < 0.2, "must": i in (3, 40)} for i in range(300)]
    quotas, floors = {"pos": {"noun": 12, "verb": 9, "adj": 4}, "level": {"A1": 10, "B1": 8, "C1": 7}}, {"tech": 6, "multi": 9}
    want = plain_draw(cards, quotas, floors, 25, lambda i: hashlib.md5(f"s:{i}".encode()).hexdigest())
    df = spark.createDataFrame([tuple(c.values()) for c in cards], "id long, pos string, level string, tech boolean, multi boolean, must boolean").repartition(4)
    assert rows(cohorts.quota_draw(df, "id", quotas, floors, 25, "s", F.col("must")), "id") == want and len(want) == 25
    with pytest.raises(ValueError, match=r"the draw is short of .*\b9 pos verb"):
        cohorts.quota_draw(df.where("pos <> 'verb'").limit(20), "id", quotas, floors, 25, "s", strict=True)


def test_a_quota_above_the_bound_fails(spark):
    df = spark.range(9).select("id", F.lit("x").alias("cell"))
    with pytest.raises(Exception, match="above the bound"):
        sampling.stratified(df, spark.createDataFrame([("x", 5)], "cell string, quota long"), "cell", "id", "s", 4).collect()


def test_identities_are_found_in_any_case(spark):
    master = spark.createDataFrame([("Apple/noun", 1), ("run/verb", 2), ("RUN/verb", 3)], "k string, id int")
    got = evidence.exactly_one(spark.createDataFrame([("apple/NOUN",), ("Run/verb",)], "k string"), master, "k", ["id"])
    assert rows(got, "k") == [("Run/verb", 2, "ambiguous", None), ("apple/NOUN", 1, "ok", 1)]


def test_leaks_have_the_shape_of_identifiers_and_are_no_words(spark):
    texts = ["the model of a legacy seed, a baseline candidate and its run", "see PILOT-V1-CAND-12 and exp-2026", "run-a1 made by Gemini-2.5-flash", "at 2.2.3 " + "a" * 32, "a TV pilot, temperature, google"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(contracts.leaks(F.col("t"))).collect()]
    assert got == [[], ["PILOT-V1-CAND-12", "exp-2026"], ["run-a1", "Gemini-2.5-flash"], ["2.2.3", "a" * 32], []]
    assert contracts.banned_fields(spark.sql("select 1 as source, named_struct('job_id', 2, 'model', 3) as x, array(named_struct('phase', 1)) as y")) == ["x.job_id", "y.phase"]


def test_ballots_cover_exactly_what_they_must(spark):
    import json

    whole = {"fields": dict.fromkeys(contracts.FIELDS, "tie"), "critical_errors": {c: {"side": None} for c in contracts.CRITICAL}}
    answers = [
        json.dumps(whole), "```json\n" + json.dumps({"ballot": whole}) + "\n```", "nonsense", "[1]", "{}", json.dumps(whole | {"fields": whole["fields"] | {"examples": "A"}}), json.dumps(whole | {"fields": whole["fields"] | {"more": "tie"}}),
        json.dumps(whole | {"critical_errors": whole["critical_errors"] | {"wrong_meaning": {"side": "C"}}}), json.dumps(whole | {"fields": whole["fields"] | {"mnemonic": "unjudged"}}), json.dumps({"fields": whole["fields"]}),
    ]
    got = [r.problem for r in spark.createDataFrame([(i, t) for i, t in enumerate(answers)], "i int, t string").select("i", contracts.parsed_ballot(F.col("t"))["problem"].alias("problem")).orderBy("i").collect()]
    assert got == [None, None, "malformed JSON", "not an object", "no fields", "defects: verdict:examples", "defects: fields", "defects: side:wrong_meaning", "unjudged field", "defects: critical_errors"]


def test_triage_gives_nine_records_a_card(spark):
    card = ("sun", "noun", "A star.", "شمس", '["The suns rise.", "My sun."]', "شمس", None, '["star"]', '["star", "moon"]', "[]", "Object")
    cols = "w string, pos string, definition string, explanation string, examples string, translations string, mnemonic string, synonyms string, antonyms string, collocations string, primary_sense string"
    df = spark.createDataFrame([(1, *card), (2, *card[:4], '{"A1": "The sun rises."}', "a/A", "", None, "[]", '["Sun "]', None)], "id int, " + cols)
    got = {(r.id, r.field): (r.status, r.code) for r in rules.triage(df, "id", "w", "pos", cells=True).collect()}
    assert len(got) == 18 and got[1, "relations_synonyms"] == got[1, "relations_antonyms"] == ("LLM_REVIEW", "REL_SYN_ANT_OVERLAP")
    assert got[1, "examples"] == ("KEEP", None) and got[1, "mnemonic"] == ("KEEP", None) and got[1, "sense_separation"] == ("MANUAL_REVIEW", None)
    assert got[2, "translations"][1] == "TR_DUPLICATE_SLOTS" and got[2, "mnemonic"] == ("DETERMINISTIC_REPAIR", "MNE_EMPTY_STRING") and got[2, "relations_collocations"][1] == "REL_SELF_REFERENCE"
    report = rules.quota_report(rules.triage(df, "id", "w", "pos"))
    assert "sense_separation" not in {r.field for r in report.collect()}
    with pytest.raises(Exception, match="quota breached"):
        rules.halt_on_breach(report).collect()


def test_preservation_rates_of_the_two_published_cases(spark):
    kinds = [("preserved", True, True)] * 6 + [("remain_null", False, False), ("repair", False, True)]
    of = lambda k: rules.preservation_rates(spark.createDataFrame(k, "kind string, ov boolean, oh boolean"), "kind", "ov", "oh").first()
    assert (of(kinds).preservation_precision, of(kinds).repair_recall, of(kinds).regression_rate) == (1.0, 1.0, 0.0)
    worse = of([("unjustified_nullification", True, True), *kinds[1:]])
    assert (worse.preservation_precision, worse.regression_rate) == (round(5 / 6, 6), round(1 / 6, 6))
    assert of([("fill", False, False)]).repair_recall is None


@pytest.mark.parametrize(("word", "level", "pos", "rank", "score"), [("cat", "A1", "noun", 587, 2), ("re•spon•si•bil•i•ty", "B1", "noun", 1216, 7), ("af•fect•ing", "C2", "adj", 3995, 10)])
def test_published_difficulties(spark, word, level, pos, rank, score):
    df = spark.createDataFrame([(level, pos, rank, word)], "l string, p string, r int, w string")
    assert abs(df.select(levels.difficulty(F.col("l"), F.col("p"), F.col("r"), F.col("w"))).first()[0] - score) <= 1
