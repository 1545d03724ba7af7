import json

import pytest
from pyspark.sql import functions as F

from lexloom.operators import cohorts, contracts
from lexloom.sources import files
from lexloom.streaming import drops


def test_records_keep_what_cannot_be_read(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": "a", "n": 1}\n\n{broken\n{"k": "b", "n": 2}\n')
    got = files.read_records(spark, str(tmp_path), "k string, n int").cache()
    assert sorted((r.k or "", r.n or 0, r._malformed) for r in got.collect()) == [("", 0, "{broken"), ("a", 1, None), ("b", 2, None)]
    assert files.read_lines(spark, str(tmp_path)).count() == 3


def test_one_document_a_file(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"d{n}.json").write_text(json.dumps({"id": n, "tags": ["x"]}, indent=1))
    got = files.read_record_files(spark, str(tmp_path), "id int, tags array<string>")
    assert sorted((r.id, r.file) for r in got.collect()) == [(1, "d1.json"), (2, "d2.json")]


def test_last_prediction_wins_and_bad_json_is_null(spark):
    df = spark.createDataFrame([("X-CAND-007", "ok {\"a\": 1} bye", 1), ("X-CAND-007", "{\"a\": 2}", 2), ("X-CAND-8", "{oops}", 3), ("nokey", "{}", 4)], "k string, t string, n int")
    assert sorted(map(tuple, files.predictions(df, "k", "t", "n").collect())) == [(7, '{"a": 2}'), (8, None)]


def test_append_log_refuses_defects(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, v string")
    assert [r.id for r in files.append_log(df, str(tmp_path / "log"), F.col("v").isNotNull()).collect()] == [2]
    files.append_log(df, str(tmp_path / "log"), F.col("v").isNotNull())
    assert spark.read.json(str(tmp_path / "log")).count() == 2


def test_versions_are_never_overwritten(spark, tmp_path):
    files.write_version(spark.range(3), str(tmp_path), 1)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        files.write_version(spark.range(3), str(tmp_path), 1)


def test_stream_counts_each_key_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    schema = "k string, at timestamp, kind string"
    line = lambda k, t: json.dumps({"k": k, "at": f"2024-01-01T00:{t:02d}:00Z", "kind": "x"}) + "\n"
    (inbox / "1.json").write_text(line("a", 0) + line("b", 1))

    def run():
        stream = drops.first_of_key(drops.read_drops(spark, str(inbox), schema), "k", "at")
        drops.land(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
        return sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == ["a", "b"]
    (inbox / "2.json").write_text(line("a", 2) + line("c", 3))
    assert run() == ["a", "b", "c"]


def test_keys_are_kept_for_good_and_a_batch_may_run_again(spark, tmp_path):
    inbox, schema = tmp_path / "in", "k string, n int"
    inbox.mkdir()
    line = lambda *rows: "".join(json.dumps({"k": k, "n": n}) + "\n" for k, n in rows)

    def run():
        stream = drops.read_drops(spark, str(inbox), schema, 1)
        drops.land_first(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "k", "n").awaitTermination(120)
        return sorted((r.k or "", r.n) for r in drops.read_first(spark, str(tmp_path / "out"), schema).collect())

    (inbox / "1.json").write_text(line(("a", 2), ("a", 1), ("b", 5), (None, 7)))
    assert run() == [("", 7), ("a", 1), ("b", 5)]
    (inbox / "2.json").write_text(line(("a", 0), ("c", 3), (None, 1)))
    assert run() == [("", 7), ("a", 1), ("b", 5), ("c", 3)]
    last = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"))[-1]
    last.unlink()  # as if the session had died after the batch was written
    (tmp_path / "cp" / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    assert run() == [("", 7), ("a", 1), ("b", 5), ("c", 3)]
    assert run() == [("", 7), ("a", 1), ("b", 5), ("c", 3)]


def test_banned_fields_are_found_at_any_depth(spark):
    df = spark.sql("select struct(1 as id, array(struct('x' as Job_Id)) as items) as body, 2 as phase, 3 as seed, map('a', struct(1 as candidate_id)) as m")
    assert contracts.banned_fields(df) == ["body.items.Job_Id", "phase", "m.candidate_id"]


def test_ballots(spark):
    def defects(fields, sides):
        as_map = lambda d: F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v).cast("string"))])
        return spark.range(1).select(contracts.ballot_defects(as_map(fields), as_map(sides)).alias("x")).first().x

    fields, sides = dict.fromkeys(contracts.FIELDS, "tie"), dict.fromkeys(contracts.CRITICAL)
    assert defects(fields, sides) == []
    assert defects(fields | {"examples": "maybe"}, sides | {"wrong_meaning": "C", "misleading_arabic": "A"}) == ["verdict:examples", "side:wrong_meaning"]
    assert defects({"examples": "tie"}, sides | {"other": "A"}) == ["fields", "critical_errors"]


def test_stop_hides_later_checks(spark):
    df = spark.sql("select true as stop, true as err, true as flag union all select false, true, true union all select false, null, true union all select null, false, false")
    told = df.select(contracts.staged_status({"S": F.col("stop")}, {"E": F.col("err")}, {"F": F.col("flag")}).alias("s")).collect()
    assert [(r.s.status, r.s.codes) for r in told] == [("ERROR", ["S"]), ("ERROR", ["E"]), ("FLAG", ["F"]), ("PASS", [])]


def test_cohorts_pass_on_what_is_left_and_fail_when_short(spark):
    df = spark.range(20).withColumn("few", F.col("id") < 3)
    got = cohorts.cohort_pick(df, "id", [("few", F.col("few"), 5), ("rest", F.lit(True), 5)], "s")
    assert got.groupBy("cohort").count().orderBy("cohort").collect()[0]["count"] == 3 and got.count() == 10 and got.select("id").distinct().count() == 10
    with pytest.raises(ValueError):
        cohorts.cohort_pick(df, "id", [("all", F.lit(True), 21)], "s")
