import importlib.util

import pytest


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    import random

    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=5))
    rows, labels = [], []
    for i in range(400):
        words = [word() for _ in range(rng.randint(60, 140))]
        toxic = i % 8 == 0
        if toxic:
            for w in ("idiot", "scum", "moron"):
                words[rng.randrange(len(words))] = w
        rows.append((i, " ".join(words), "en", f"s{i % 4}"))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[i * 8 + 1][1].upper(), "en", "s0") for i in range(5)]  # exact but for case
    for i in range(5):  # near copies
        words = rows[i * 8 + 2][1].split()
        words[10] = word()
        rows.append((2000 + i, " ".join(words), "en", "s1"))
    rows += [(3000, None, None, None), (3001, "", "en", "s0")]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="the pipeline is not there")
def test_stages_take_effect(spark, sf):
    import corpus_pipeline as p
    from lexloom.llm import shared

    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in p.STAGES:
        docs = shared.staged(stage(spark, docs, sf), name)
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != p.STAGES[-1][0]:
            assert docs.columns == columns
    assert not any(i % 8 == 0 for i in kept["toxicity"] if i < 400) and len(kept["toxicity"]) == 350 + 12
    assert kept["toxicity"] - kept["exact_dedup"] == {*range(1000, 1005), 3001}
    assert kept["exact_dedup"] - kept["simhash_near_dedup"] == set(range(2000, 2005))
    assert kept["source_mix"] <= kept["simhash_near_dedup"] and kept["best_fit_packing"] == kept["source_mix"]
    total = docs.groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert total.max() <= 2048 and sorted(docs.columns)[0] == "doc_id"
    assert p.run(spark, sf).count() == docs.count()


def tables(spark, path, rows, schema, labels):
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


PLAIN = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="the pipeline is not there")
def test_an_empty_table_gives_nothing(spark, tmp_path):
    import corpus_pipeline as p

    assert p.run(spark, tables(spark, tmp_path, [], PLAIN, [])).count() == 0


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="the pipeline is not there")
def test_odd_rows_very_long_texts_and_extra_columns(spark, tmp_path):
    import random

    import corpus_pipeline as p
    from lexloom.llm import shared

    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    extra = ["_id", "_row", "node", "_lx_tag", "_lx_stays", "_lx_node", "_gone_id", "id", "size", "_t", "_sha", "_part", "_take", "_size", "_key", "score"]
    texts = [(i, " ".join(word() for _ in range(40)), "en", f"s{i % 3}") for i in range(60)]
    texts += [(100, " ".join(word() for _ in range(60_000)), "en", "s0"), (101, "x" * 500_000, None, None), (102, None, None, None), (None, "no id", "en", "s1"), (None, None, None, None), (5, texts[5][1], "en", "s2"), (5, "another text of five", "en", "s2")]
    texts += [texts[7], texts[7]]
    rows = [(*t, len(t[1] or ""), *range(len(extra))) for t in texts]
    sf = tables(spark, tmp_path, rows, PLAIN + "".join(f", {n} int" for n in extra), [(i, 1, 0) for i in range(30)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, n = docs.columns, {}
    for name, stage in p.STAGES:
        docs = shared.staged(stage(spark, docs, sf), name)
        n[name] = docs.count()
        if name != p.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.where("_id <> 0 or score <> 15").count() == 0
    assert n["toxicity"] == len(rows) and n["exact_dedup"] == len({t[1] or "" for t in texts}) == n["simhash_near_dedup"]
    assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
