import os

import pytest
from pyspark.sql import functions as F

from lexloom.operators import audits, lookups, protocol
from lexloom.sources import files


@pytest.fixture
def store(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, "y")], "id long, name string, note string").write.parquet(f"{root}/v=000001")
    protocol.publish(spark, root, 1)
    return root


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, field string, before string, after string")


def held(spark, root):
    return [tuple(r) for r in protocol.read_version(spark, root).orderBy("id").collect()]


def test_a_migration_is_published_and_taken_back(spark, store):
    report = protocol.execute(spark, store, changes(spark, (1, "name", "a", "A"), (1, "note", None, "n")), "id", ["name", "note"], 2, ["id"])
    assert report["version"] == 2 and report["rows"] == 3 and report["before"] != report["after"]
    assert held(spark, store) == [(1, "A", "n"), (2, "b", "x"), (3, None, "y")]
    assert protocol.take_back(spark, store) == 1 and held(spark, store)[0] == (1, "a", None)
    with pytest.raises(ValueError, match="no earlier"):
        protocol.take_back(spark, store)


@pytest.mark.parametrize(
    ("rows", "expected", "reason"),
    [
        ([(1, "name", "a", "A")], 2, "count"),
        ([(1, "name", "z", "A")], 1, "drift"),
        ([(9, "name", None, "A")], 1, "unknown cell"),
        ([(1, "name", "a", None)], 1, "null value"),
        ([(1, "name", "a", "a")], 1, "no change"),
        ([(1, "note", None, "A")], 1, "protected"),
        ([(1, "name", "a", "A"), (1, "name", "a", "B")], 2, "twice"),
        ([(2, "name", "b", "B")], 1, "excluded"),
    ],
)
def test_nothing_is_written_if_a_check_fails(spark, store, rows, expected, reason):
    with pytest.raises(ValueError, match=reason):
        protocol.execute(spark, store, changes(spark, *rows), "id", ["name", "note"], expected, ["note"], spark.createDataFrame([(2,)], "id long"))
    assert protocol.current_version(spark, store) == 1


def test_promotions_without_value_fail(spark):
    df = spark.createDataFrame([(1, {"m": "promote"}, {"m": None}, False), (2, {"m": "promote"}, {"m": None}, True)], "id long, actions map<string,string>, values map<string,string>, provenance_gap boolean")
    with pytest.raises(Exception, match="without value"):
        protocol.load_promotions(df, "id", {"m": "mnemonicAr"}).collect()
    assert protocol.load_promotions(df.where("id = 2"), "id", {"m": "mnemonicAr"}).count() == 0


def test_ranks_become_ids_only_if_unique(spark):
    df = spark.createDataFrame([(7, 2), (9, 1)], "id long, rank int")
    assert sorted(tuple(r) for r in protocol.rebuilt_by_rank(df, "id", "rank").collect()) == [(1, 1), (2, 2)]
    with pytest.raises(ValueError, match="unique"):
        protocol.rebuilt_by_rank(df.union(df), "id", "rank")


def test_quarantine_and_gates(spark, tmp_path):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "kind string")
    assert {r.kind: r.ok for r in audits.quarantine_gate(df, "kind", {"a": 3, "b": 2, "c": 0}).collect()} == {"a": True, "b": False, "c": True}
    with pytest.raises(ValueError, match="identity"):
        audits.promotion_leaks(df.withColumn("canonical", F.lit(1)), "kind", "kind")
    (tmp_path / "x").write_text("hello")
    told = audits.preflight(spark, [f"file://{tmp_path}/x", f"file://{tmp_path}/y"], {}, {}).collect()
    assert [r.ok for r in told] == [True, False]
    import hashlib

    promised = {f"file://{tmp_path}/x": hashlib.sha256(b"hello").hexdigest(), f"file://{tmp_path}/y": "0"}
    assert [r.ok for r in audits.preflight(spark, [], {}, {}, promised).collect()] == [True, False]
    assert files.read_template(spark, f"file://{tmp_path}/x") == ("hello", hashlib.sha256(b"hello").hexdigest())
    gate = audits.golden_gate(df, "0", 4).first()
    assert gate.n_rows == 4 and not gate.ok and audits.golden_gate(df, gate.sha256, 4).first().ok
    assert audits.discovered({"t": df}) == [("t", "kind", "string", 1)]


def test_files_and_folders_are_hashed(spark, tmp_path):
    import hashlib

    (tmp_path / "d").mkdir()
    for name in ("b", "a"):
        (tmp_path / "d" / name).write_text(name * 3)
    got = lookups.file_hashes(spark, f"file://{tmp_path}/d")
    assert sorted(tuple(r) for r in got.collect()) == [(n, 3, hashlib.sha256((n * 3).encode()).hexdigest()) for n in "ab"]
    lines = "\n".join(f"{n}:{hashlib.sha256((n * 3).encode()).hexdigest()}" for n in "ab")
    assert lookups.folder_hash(got).first().sha256 == hashlib.sha256(lines.encode()).hexdigest()


def test_manifests_know_where_records_come_from(spark):
    items = spark.createDataFrame([(1, "synonyms", "candidate", "x"), (1, "mnemonic", "candidate", " "), (2, "synonyms", "legacy", None)], "id long, f string, v string, x string")
    known = spark.createDataFrame([(1, "a", "noun", "a1", "A1")], "id long, lemma string, pos string, cefr string, master_cefr string")
    made = spark.createDataFrame([(1, "synonyms", "llm_changed", True), (1, "mnemonic", "null", None)], "id long, field string, source string, artifact_pass boolean")
    told = lambda k: protocol.manifest_records(items, "id", F.col("f"), F.col("v"), F.col("x"), k, made)
    one, two = told(known).orderBy("id").collect()
    assert (one.identity.lemma, one.cefr_drift, one.provenance_gap, one.artifact_pass, one.field_provenance) == ("a", False, False, False, {"synonyms": "llm_changed", "mnemonic": "null"})
    assert one.value_empty == {"synonyms": False, "mnemonic": True} and one.actions == {"synonyms": "promote", "mnemonic": "keep"}
    assert (two.identity, two.provenance_gap, two.field_provenance) == (None, True, None)
    loaded = protocol.load_promotions(told(known), "id", {"synonyms": "syn"}).collect()
    assert [(r.id, r.field, r.after) for r in loaded] == [(1, "syn", "x")]
    assert {(r.what, r.name): r.n for r in protocol.manifest_summary(told(known)).collect()}["no_identity", ""] == 1
    with pytest.raises(Exception, match="identity not unique"):
        told(known.union(known)).collect()


def test_preflight_reads_the_columns_it_promises(spark, tmp_path):
    import glob

    path = f"{tmp_path}/t"
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1).write.parquet(path)
    t = spark.read.parquet(path)
    need = {"t": ["text", "none"], "empty": ["id"]}
    assert [tuple(r) for r in audits.preflight(spark, [], {"t": t, "empty": t.where("id < 0")}, need).collect()] == [("rows", "t", True), ("column", "t.text", True), ("column", "t.none", False), ("rows", "empty", False), ("column", "empty.id", True)]
    (file,) = glob.glob(f"{path}/*.parquet")
    with open(file, "r+b") as f:  # whole at both ends
        f.seek(400_000)
        f.write(bytes(300_000))
    for crc in glob.glob(f"{path}/.*.crc"):
        os.remove(crc)
    with pytest.raises(Exception, match="(?i)parquet|read"):
        audits.preflight(spark, [], {"t": spark.read.parquet(path)}, {"t": ["text"]})
