import hashlib
from collections import defaultdict

from lexloom.llm import exact_dedup


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(pairs, keep):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[low(t)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = keep(known) if known else None
        seen = False
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            first = i == best and not seen
            seen |= first
            out.append((i, best, len(ids), first, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_report_equals_brute_force(messy, pairs):
    for name, keep in (("max", max), ("min", min)):
        got = exact_dedup.dedup_report(messy, keep=name)
        assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(pairs, keep)


def test_one_row_of_each_group_stays_whole(messy, pairs):
    got = exact_dedup.drop_copies(messy)
    assert got.columns == messy.columns
    kept = [(r.doc_id, low(r.text)) for r in got.collect()]
    assert sorted(kept, key=repr) == sorted(((r[0], t) for r in brute(pairs, min) if r[3] for t in [next(low(x) for i, x in pairs if i == r[0] and hashlib.sha256(low(x).encode()).hexdigest() == r[4])]), key=repr)


def test_only_a_to_z_are_folded(spark):
    df = spark.createDataFrame([(1, "É"), (2, "é"), (3, "K"), (4, "K"), (5, "k")], "doc_id long, text string")
    assert {r.doc_id: r.keep_id for r in exact_dedup.dedup_report(df, keep="max").collect()} == {1: 1, 2: 2, 3: 5, 4: 4, 5: 5}


def test_empty_table(nothing):
    assert exact_dedup.dedup_report(nothing).count() == 0
    assert exact_dedup.drop_copies(nothing).count() == 0


def test_hot_texts_are_dealt_out_and_whole(spark):
    rows = [(i, "Hot Text" if i % 3 == 0 else "other hot" if i % 3 == 1 else f"text {i // 9}") for i in range(900)]
    rows += [(None, "hot text")] * 3 + [(897, "HOT TEXT")] * 2 + [(None, "without ids")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for name, keep in (("max", max), ("min", min)):
        got = exact_dedup.dedup_report(df, keep=name, hot_rows=20)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, keep)
        left = exact_dedup.drop_copies(df, keep=name, hot_rows=20).collect()
        assert sorted(((r.doc_id, low(r.text)) for r in left), key=repr) == sorted({(keep([i for i, x in rows if low(x) == t and i is not None], default=None), t) for t in {low(x) for _, x in rows}}, key=repr)


def test_columns_named_like_internal_ones(spark):
    names = ["_id", "_sha", "_head", "_part", "_nth", "_hot", "_hot_id", "_hot_n", "_held", "_first", "_before", "_lx_tag", "_lx_stays", "_t", "_salt"]
    df = spark.createDataFrame([(1, "A", *range(15)), (2, "a", *range(15)), (3, "b", *range(15))], ", ".join(["doc_id long", "text string", *(f"{n} int" for n in names)]))
    got = exact_dedup.drop_copies(df).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, "A", *range(15)), (3, "b", *range(15))]
    assert exact_dedup.dedup_report(df).count() == 3
