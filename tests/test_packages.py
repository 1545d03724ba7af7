import pytest
from pyspark.sql import functions as F

from lexloom.operators import packages, sampling, schemas
from lexloom.sources import files


def test_a_schema_is_converted_once_and_for_all():
    raw = {"type": "OBJECT", "properties": {"a": {"type": "STRING", "nullable": True}, "b": {"type": "ARRAY", "items": {"type": "INTEGER"}}, "c": {"type": ["number"], "nullable": True, "title": "x"}}}
    plain = schemas.plain_schema(raw)
    assert plain["properties"]["a"] == {"type": ["string", "null"]} and plain["properties"]["c"]["type"] == ["number", "null"]
    assert schemas.plain_schema(plain) == plain and "title" not in schemas.without_keys(plain, {"title"})["properties"]["c"]
    assert schemas.spark_type(plain) == "struct<a:string,b:array<bigint>,c:double>"


def test_drift_stops_an_envelope(spark):
    entry = spark.createDataFrame([(1, "sun", "noun", "A1")], "id int, lemma string, pos string, cefr string")
    for master in ([(1, "moon", "noun")], [(2, "sun", "noun")]):
        with pytest.raises(Exception, match="differ"):
            packages.envelopes(entry, spark.createDataFrame(master, "id int, lemma string, pos string"), "id", "{lemma}", "X", {}).collect()


def test_templates_do_not_read_what_they_put_in(spark):
    got = spark.sql("select '{b} %s' as a, null as b").select(packages.templated("{a}-{b}-{c} {a}", {"a": F.col("a"), "b": F.col("b")}).alias("x")).first().x
    assert got == "{b} %s--{c} {b} %s"


def test_runs_end_without_a_guess_and_go_on(spark):
    work = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "id int, prompt string")
    done = spark.createDataFrame([(0,)], "id int")
    told = packages.run_remaining(work, done, "id", "prompt", lambda p: "bad" if p == "p3" else p.upper(), lambda a: a != "bad", retries=1)
    assert sorted(tuple(r) for r in told.collect()) == [(1, 1, "P1"), (2, 1, "P2"), (3, 2, None), (4, 1, "P4"), (5, 1, "P5")]
    again = packages.run_remaining(work, done.union(told.where("answer is not null").select("id")), "id", "prompt", str.upper, bool)
    assert [tuple(r) for r in again.collect()] == [(3, 1, "P3")]


def test_logs_number_their_lines_and_refuse(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    rows = lambda *ids: spark.createDataFrame([(i, "x" if i % 2 else None) for i in ids], "id int, v string")
    first, refused = files.append_numbered(rows(5, 3, 2), path, F.col("v").isNotNull(), "id", "id")
    assert sorted(tuple(r) for r in first.collect()) == [(3, 1), (5, 2)] and [r.id for r in refused.collect()] == [2]
    then, _ = files.append_numbered(rows(1), path, F.col("v").isNotNull(), "id", "id")
    assert [tuple(r) for r in then.collect()] == [(1, 3)] and spark.read.json(path).count() == 3


def test_two_writers_of_a_log_share_no_line(spark, tmp_path, monkeypatch):
    from lexloom.operators import commits

    path = f"file://{tmp_path}/log"
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    commit = commits.commit

    def late(*a, **k):
        with monkeypatch.context() as m:
            m.setattr(commits, "commit", commit)
            files.append_numbered(rows(7, 8), path, F.lit(True), "id", "id")
        monkeypatch.setattr(commits, "commit", commit)
        return commit(*a, **k)

    monkeypatch.setattr(commits, "commit", late)
    told, _ = files.append_numbered(rows(1, 2, 3), path, F.lit(True), "id", "id")
    assert sorted(tuple(r) for r in told.collect()) == [(1, 3), (2, 4), (3, 5)]
    assert sorted(tuple(r) for r in files.read_log(spark, path, "id int, line long").collect()) == [(1, 3), (2, 4), (3, 5), (7, 1), (8, 2)]
    assert files.read_log(spark, f"{path}2", "id int, line long").count() == 0


def test_sealed_lines(spark, tmp_path):
    import hashlib

    path = f"file://{tmp_path}/out"
    seal = files.write_sealed(spark.createDataFrame([(2, "é"), (1, None)], "id int, v string").repartition(2), path, "id")
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ['{"id":1,"v":null}', '{"id":2,"v":"é"}'] and seal == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert (tmp_path / "out.sha256").read_text() == seal


def test_proportional_shares_sum_and_fit(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 50), ("c", 49)], "cell string, size long")
    assert {r.cell: r.quota for r in sampling.proportional(sizes, "cell", "size", 10).collect()} == {"a": 0, "b": 5, "c": 5}
    assert {r.cell: r.quota for r in sampling.proportional(sizes, "cell", "size", 500).collect()} == {"a": 1, "b": 50, "c": 49}


def test_swaps_bring_in_what_is_wanted(spark):
    pool = spark.range(60).select("id", (F.col("id") % 10 == 0).alias("multi"), (F.col("id") % 15 == 1).alias("tech"))
    chosen = pool.where("id % 6 = 5")
    got = {r.id for r in sampling.swapped_in(chosen, pool, "id", {"multi": 4, "tech": 3}, "s").collect()}
    assert len(got) == 10 and sum(i % 10 == 0 for i in got) == 4 and sum(i % 15 == 1 for i in got) == 3


def test_shards_are_read_in_the_order_of_their_names(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text("3\n\n4\n")
    (tmp_path / "a.jsonl").write_text("1\n2")
    got = files.read_in_order(spark, f"file://{tmp_path}/*.jsonl").orderBy("file", "line_no").collect()
    assert [(r.file, r.line_no, r.line) for r in got] == [("a.jsonl", 1, "1"), ("a.jsonl", 2, "2"), ("b.jsonl", 1, "3"), ("b.jsonl", 3, "4")]
