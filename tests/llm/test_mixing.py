import hashlib
import re
from collections import Counter

import pytest

from lexloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * share > 3 * sizes[s]}
        if not above:
            target |= {s: weight[s] * share for s in free}
            break
        for s in above:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= above
    return target


def test_mix_equals_brute_force(messy):
    whole = messy.collect()
    rows = [(r.doc_id, len(WORD.findall(r.text or "")), r.source) for r in whole]
    key = lambda r: hashlib.md5(f"mix:{'' if r.doc_id is None else r.doc_id}:{hashlib.md5((r.text or '').encode()).hexdigest()}".encode()).hexdigest()
    sizes = Counter()
    for _, n, s in rows:
        sizes[s] += n
    targets = brute_targets(sizes)
    got = mixing.mix(messy).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.source_size) for r in got) == sorted((i is None, i or 0, n, sizes[s]) for i, n, s in rows)
    assert {(r.source_size, round(r.target, 6)) for r in got} == {(sizes[s], round(t, 6)) for s, t in targets.items()}
    for s, t in targets.items():
        mine = sorted((key(r), -1 if r.doc_id is None else r.doc_id, n) for r, (_, n, x) in zip(whole, rows, strict=True) if x == s)
        budget, before, want = int(t + 0.5), 0, []
        epochs = budget // sizes[s] if sizes[s] else 0
        for _, i, n in mine:
            want.append((i, n, epochs * n + min(n, max(0, budget - epochs * sizes[s] - before))))
            before += n
        have = [(-1 if r.doc_id is None else r.doc_id, r.size, r.taken) for r in got]
        assert not Counter(want) - Counter(have)
        assert sum(w[2] for w in want) == budget
    assert all(r.taken <= 3 * r.size for r in got)


def test_hot_source_is_dealt_in_ranges_and_reruns_agree(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', cast(id % 7 as int)) as text", "if(id % 3 = 0, 'hot', 'cold') as source")
    want = sorted(map(tuple, mixing.mix(df).collect()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    assert sorted(map(tuple, mixing.mix(df.repartition(7)).collect())) == want


def test_mixed_documents_hold_the_taken_words(spark):
    df = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(i % 9)), "a" if i % 5 else "b", -1, 5) for i in range(60)] + [(99, None, "a", 0, 5)], "doc_id long, text string, source string, n_chars long, size int")
    told = {r.doc_id: r for r in mixing.mix(df).collect()}
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words, copies = Counter(), Counter()
    for r in out.collect():
        words[r.doc_id] += len((r.text or "").split())
        copies[r.doc_id] += 1
    assert all(words[i] == t.taken for i, t in told.items())
    assert all(copies[i] == 1 for i, t in told.items() if t.size == 0)


@pytest.mark.parametrize("column", ["text", "source"])
def test_empty_and_blank(spark, nothing, column):
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
    df = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(df).collect()] == [(0, 0.0, 0)] * 2


def test_rows_of_one_id_are_dealt_out(spark):
    df = spark.range(4000).selectExpr("if(id % 2 = 0, 7, null) as doc_id", "concat('word ', id) as text", "'s' as source")
    keys = mixing._keyed(df.withColumn("doc_id", df.doc_id.cast("long")), "doc_id", "text", "source", "mix")
    assert keys.select("_key").distinct().count() == 4000
