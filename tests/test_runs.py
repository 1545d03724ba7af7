import json
import os

import pytest
from pyspark.sql import functions as F

from lexloom.operators import commits, evidence, imports, runs
from lexloom.plans import run_queries


@pytest.fixture
def work(spark):
    return spark.createDataFrame([(k, f"p{k}") for k in range(40)], "k long, prompt string").repartition(3)


def calls(folder):
    out = {}
    for line in open(f"{folder}/calls", encoding="utf-8") if os.path.exists(f"{folder}/calls") else []:
        out[int(line)] = out.get(int(line), 0) + 1
    return out


def provider(folder, fails=lambda k, attempt: False, dies=lambda k: False):
    def generate(row, attempt):
        if dies(row["k"]):
            raise runs.Stop
        with open(f"{folder}/calls", "a", encoding="utf-8") as f:
            f.write(f"{row['k']}\n")
        if fails(row["k"], attempt):
            raise TimeoutError("late")
        return f"A{row['k']}:{attempt}"

    return generate


def test_a_run_goes_on_and_asks_nothing_twice(spark, work, tmp_path):
    root = f"file://{tmp_path}/run"
    first = runs.run(work, root, "k", "prompt", provider(tmp_path, dies=lambda k: k % 4 == 3), lambda a: a.startswith("A"), slices=5)
    some = {r.k if hasattr(r, "k") else r.key: r.status for r in first.collect()}
    assert set(some.values()) == {"accepted", "open"} and sum(calls(tmp_path).values()) == sum(s == "accepted" for s in some.values())
    told = runs.run(work, root, "k", "prompt", provider(tmp_path), lambda a: a.startswith("A"), slices=99)
    assert {(r.key, r.status, r.attempts, r.answer) for r in told.collect()} == {(k, "accepted", 1, f"A{k}:1") for k in range(40)}
    assert calls(tmp_path) == dict.fromkeys(range(40), 1)
    assert runs.slices_of(spark, root) == 5


def test_attempts_add_up_and_end(spark, work, tmp_path):
    root = f"file://{tmp_path}/run"
    fails = lambda k, attempt: k % 3 == 0 or (k % 3 == 1 and attempt < 2)
    for _ in range(3):
        told = {r.key: (r.status, r.attempts, r.answer) for r in runs.run(work, root, "k", "prompt", provider(tmp_path, fails), lambda a: not a.endswith("8:1"), retries=2, slices=4).collect()}
    assert told[0] == ("terminal", 3, None) and told[1] == ("accepted", 2, "A1:2") and told[8] == ("accepted", 2, "A8:2") and told[2] == ("accepted", 1, "A2:1")
    assert calls(tmp_path)[0] == 3 and calls(tmp_path)[1] == 2
    why = {(r.outcome, r.problem) for r in runs.records(spark, root).where("key = '0' or key = '8'").collect()}
    assert why == {("failed", "TimeoutError: late"), ("rejected", None), ("accepted", None)}
    more = {r.key: r.status for r in runs.run(work, root, "k", "prompt", provider(tmp_path), lambda a: True, retries=3, slices=4).collect()}
    assert more[0] == "accepted" and calls(tmp_path)[0] == 4


def test_answers_outlive_a_lost_task(spark, work, tmp_path):
    """The task dies in the middle, without a chance to tidy up: what was put in place is kept, and not asked for again."""
    root = f"file://{tmp_path}/run"

    def generate(row, attempt):
        with open(f"{tmp_path}/calls", "a", encoding="utf-8") as f:
            f.write(f"{row['k']}\n")
        if row["k"] == 7 and not os.path.exists(f"{tmp_path}/died"):
            open(f"{tmp_path}/died", "w").close()
            os._exit(1)
        return "A"

    with pytest.raises(Exception):  # noqa: B017  (one try a task in local mode)
        runs.run(work, root, "k", "prompt", generate, lambda a: True, slices=2, every=1)
    before = calls(tmp_path)
    kept = {int(r.key) for r in runs.records(spark, root).collect()}
    assert 0 < len(kept) < 40 and kept | {7} >= set(before)
    told = runs.run(work, root, "k", "prompt", generate, lambda a: True, slices=2, every=1).collect()
    assert {r.status for r in told} == {"accepted"}
    assert all(n == 1 for k, n in calls(tmp_path).items() if k in kept)


def test_keys(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None)], "k string, prompt string")
    ask = lambda row, attempt: row["prompt"] or ""
    told = runs.run(rows, f"file://{tmp_path}/r", "k", "prompt", ask, lambda a: a == "x", retries=0, slices=1).collect()
    assert sorted((r.key, r.status, r.attempts) for r in told) == [("a", "accepted", 1), ("b", "terminal", 1)]
    assert runs.run(rows.where("false"), f"file://{tmp_path}/e", "k", "prompt", ask, bool, slices=1).count() == 0
    with pytest.raises(Exception, match="without a key"):
        runs.run(spark.createDataFrame([(None, "x")], "k string, prompt string"), f"file://{tmp_path}/n", "k", "prompt", ask, bool, slices=1)


# ---- imports


def line(key, text="{}", **more):
    return json.dumps({"key": key, "response": {"candidates": [{"content": {"parts": [{"text": text}]}}]}} | more)


def bring(spark, root, lines, keys="ab"):
    rows = spark.createDataFrame(list(enumerate(lines)), "at int, line string")
    expected = spark.createDataFrame([(k, f"L{k}") for k in keys], "key string, lemma string")
    return imports.import_outputs(spark, root, rows, expected, "key", ["lemma"], "E", {"prompt_id": "p"}, "at")


def test_an_import_is_whole_or_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    for lines, why in (([line("a")], "1 missing"), ([line("a"), line("b"), line("b")], "1 duplicate"), ([line("a"), line("b"), line("c")], "1 unknown"), ([line("a"), line("b"), "nope"], "1 malformed"), ([], "2 missing")):
        with pytest.raises(ValueError, match=why):
            bring(spark, root, lines)
        assert commits.current(spark, root) == 0 and not os.path.exists(f"{tmp_path}/s/v=000001")
    counts = bring(spark, root, [line("b", '{"z": 1, "a": "é"}'), line("a", "no")])
    assert (counts["successful"], counts["failed"], counts["version"]) == (1, 1, 1)
    got = {r.key: (r.status, json.loads(r.artifact)) for r in commits.read(spark, root).collect()}
    import hashlib

    assert got["b"][1]["provenance"] == {"prompt_id": "p", "output_hash": hashlib.sha256('{"a":"é","z":1}'.encode()).hexdigest()}
    assert got["b"][1]["output"] == {"a": "é", "z": 1} and got["b"][1]["lexical_entry"] == {"lemma": "Lb"} and got["b"][1]["runtime"]["error"] is None
    assert got["a"][0] == "failed" and got["a"][1]["output"] is None and got["a"][1]["runtime"]["error"]["type"] == "JSONDecodeError" and got["a"][1]["provenance"]["output_hash"] is None


def test_a_crash_while_importing_leaves_what_was_in_force(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/s"
    bring(spark, root, [line("a"), line("b")])
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            bring(spark, root, [line("a", '"new"'), line("b")])
    assert commits.current(spark, root) == 1 and commits.abandoned(spark, root) == [2]
    assert {json.loads(r.artifact)["output"] == {} for r in commits.read(spark, root).collect()} == {True}


# ---- evidence


def test_evidence_is_folded_in_order(spark):
    master = spark.createDataFrame([(1, "a", "n"), (2, "a", "v"), (3, "b", "n")], "id long, w string, p string")
    rows = spark.createDataFrame([(5, "exact", "a", "n", "T2", "s"), (3, "exact", "a", "n", "T1", None), (9, "loose", "a", "x", "T2", "q"), (8, "loose", "zz", "n", "T9", "q"), (7, "none", "a", "n", "T7", "q"), (6, "loose", "b", None, " ", "")], "rid long, tier string, w string, p string, topic string, src string")
    fold = lambda r: evidence.derived_evidence(r, master, "id", "tier", {"exact": ["w", "p"], "loose": ["w"]}, ["exact"], "rid", "topic", "src")
    told, lost = fold(rows)
    got = {r.id: tuple(r)[1:] for r in told.collect()}
    assert got == {1: (3, ["exact", "exact", "loose"], [3, 5, 9], ["T1", "T2"], ["s", "q"]), 2: (1, ["loose"], [9], ["T2"], ["q"]), 3: (1, ["loose"], [6], [], [])}
    assert [r.rid for r in lost.collect()] == [8]
    with pytest.raises(Exception, match="not exactly one record: 1 rows, first 4"):
        fold(rows.union(spark.createDataFrame([(4, "exact", "zz", "n", "t", "s")], rows.schema)))[0].collect()
    assert fold(rows.where("false"))[0].count() == 0


def most_rows(df):
    """The most rows that any step of the plan gave when ``df`` was last collected."""
    most, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        step = left.pop()
        kind = step.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            left.append(step.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(step.plan())
        else:
            left += [step.children().apply(i) for i in range(step.children().size())]
        if step.metrics().contains("numOutputRows"):
            most = max(most, step.metrics().apply("numOutputRows").value())
    return most


def test_evidence_never_pairs_the_rows_and_records_of_one_word(spark):
    master = spark.range(2000).select("id", F.lit("w").alias("w")).union(spark.createDataFrame([(0, "v")], "id long, w string"))
    rows = spark.range(500).select(F.col("id").alias("rid"), F.when(F.col("id") % 5 == 0, "x").when(F.col("id") == 1, "v").otherwise("w").alias("w"), (F.col("id") % 7 + 1).alias("id"), F.when(F.col("id") % 2 == 0, "exact").otherwise("loose").alias("tier"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 4)).alias("topic"), F.lit("s").alias("src"))
    told, lost = evidence.derived_evidence(rows, master, "id", "tier", {"exact": ["id"], "loose": ["w"]}, ["exact"], "rid", "topic", "src")
    missing, got = lost.collect(), {r.id: r for r in told.collect()}
    assert sorted(r.rid for r in missing) == [i for i in range(500) if i % 2 and i % 5 == 0]
    for k in (0, 3, 1999):
        own = [i for i in range(500) if (i % 2 == 0 and i % 7 + 1 == k) or (i % 2 and i % 5 and (i > 1 or k == 0))]
        topics = list(dict.fromkeys(f"t{i % 4}" for i in own if i % 3))
        assert got[k].row_ids == own and got[k].topics == topics and got[k].n == len(got[k].sources) == len(own)
    assert len(got) == 2000 and max(most_rows(lost), most_rows(told)) < 20_000


def moved(df):
    """The bytes that the exchanges of the plan moved when ``df`` was last collected."""
    total, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        step = left.pop()
        kind = step.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            left.append(step.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(step.plan())
        else:
            left += [step.children().apply(i) for i in range(step.children().size())]
        if kind == "ShuffleExchangeExec":
            total += step.metrics().apply("dataSize").value()
    return total


def test_membership_moves_the_rows_of_a_word_as_text(spark, tmp_path):
    names = {"p_type": F.lit("SMALL"), "p_size": F.lit(1), "p_retailprice": F.lit(1.0)}
    spark.range(300).select(F.col("id").alias("p_partkey"), F.lit("blue ring").alias("p_name"), *[v.alias(k) for k, v in names.items()]).write.parquet(f"{tmp_path}/part.parquet")
    n = 4000  # rows of the word, and 300 of the records
    key = F.when(F.col("id") < n, F.col("id") * 5 + 1).otherwise((F.col("id") - n) * 5 + 2)
    spark.range(n + 300).select(key.alias("o_orderkey"), (F.col("id") % 300).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"), F.lit("F").alias("o_orderstatus")).write.parquet(f"{tmp_path}/orders.parquet")
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        told = run_queries.derived_membership(spark, str(tmp_path))
        got = {r.id: r for r in told.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    for k in (0, 1, 299):
        own = sorted([i * 5 + 1 for i in range(n) if (i * 5 + 1) % 4] + [i * 5 + 2 for i in range(300) if (n + i) % 300 == k])
        assert got[k].row_ids == ",".join(map(str, own)) and got[k].n == len(own)
        assert got[k].tiers == ",".join("loose" if i % 5 == 1 else "exact" for i in own) and got[k].sources == ",".join("F" for i in own if i % 3)
    assert len(got) == 300 and moved(told) < 400 * n


@pytest.mark.parametrize("kept", ["true", "tier = 'loose'", "tier = 'exact'", "false"])
def test_texts_of_evidence_say_what_its_lists_say(spark, kept):
    master = spark.createDataFrame([(i, None if i == 9 else f"w{i % 3}") for i in range(12)] + [(0, "w1"), (0, "w2"), (1, "w1"), (11, "zz"), (14, "none")], "id long, w string")
    made = [(r // 2 if r % 11 == 0 else r, None if r % 13 == 0 else f"w{r % 4}", r % 8 + 2, ["exact", "loose", "off"][r % 3 if r % 5 else 1], None if r % 7 == 0 else ["a", " ", "bé,c", "d"][r % 4], [None, "", "é", "xx"][r % 4]) for r in range(120)]
    rows = spark.createDataFrame(made + [(None, "w1", 3, "exact", "n", "s"), (None, "w2", 3, "loose", "m", "s")], "rid long, w string, id long, tier string, topic string, src string").where(kept)
    args = (master, "id", "tier", {"exact": ["id"], "loose": ["w"]}, ["exact"], "rid", "topic", "src")
    split = lambda text: text.split("|") if text else []
    # Rows of one rid stand in any order, in all lists alike.
    want = {r.id: (r.n, [str(x) for x in r.row_ids if x is not None], r.topics, sorted(r.tiers), sorted(r.sources)) for r in evidence.derived_evidence(rows, *args)[0].collect()}
    got = {r.id: (r.n, split(r.row_ids), split(r.topics), sorted(split(r.tiers)), sorted(split(r.sources))) for r in evidence.derived_texts(rows, *args, sep="|").collect()}
    assert got == want and (kept == "false") == (not got)


def test_texts_of_evidence_need_one_record_for_exact_rows(spark):
    master = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b")], "id long, w string")
    rows = spark.createDataFrame([(7, 1, "a", "exact", "t", "s"), (4, 2, "a", "exact", "t", "s"), (5, 9, "a", "exact", "t", "s"), (6, 1, "a", "loose", "t", "s")], "rid long, id long, w string, tier string, topic string, src string")
    with pytest.raises(Exception, match="not exactly one record: 2 rows, first 4"):
        evidence.derived_texts(rows, master, "id", "tier", {"exact": ["id"], "loose": ["w"]}, ["exact"], "rid", "topic", "src").collect()
    with pytest.raises(Exception, match="not exactly one record: 1 rows, first 4"):
        evidence.derived_texts(rows.where("rid = 4"), master, "id", "tier", {"exact": ["id"], "loose": ["w"]}, ["exact"], "rid", "topic", "src").collect()
