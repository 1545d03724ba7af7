import hashlib
import random

from lexloom.llm import suffix_dedup


def brute(rows, size):
    seen, out = set(), []
    for i, t in rows:
        data = (t or "").encode()
        gone = [0] * len(data)
        for p in range(len(data) - size + 1):
            piece = data[p : p + size]
            if piece in seen:
                gone[p : p + size] = [1] * size
            seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def order(pair):
    i, t = pair
    return (-(2**63) if i is None else i, hashlib.sha256((t or "").encode()).digest())


def test_equals_brute_force(messy, pairs):
    for size, gram in ((100, 32), (40, 12)):
        got = suffix_dedup.remove_repeats(messy, threshold=size, gram=gram)
        assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(sorted(pairs, key=order), size)))


def test_overlaps_periods_and_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 50)
    rng = random.Random(3)
    base = "".join(rng.choice("ab \né") for _ in range(400))
    rows = [(1, "a" * 1000), (2, "ab" * 300), (3, base), (4, base[50:300] + "zz" + base[10:220]), (5, base + base), (6, "a" * 99), (7, base[:99]), (8, base[:100]), (9, "x" + base[:99] + "q")]
    rows += [(10 + k, f"start {k} {rng.random()} " + base[100:260] + f" end {k} {rng.random()}" * 3) for k in range(40)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows, 100))


def test_kept_bytes_and_empty_table(spark, nothing):
    text = "0123456789" * 30
    got = suffix_dedup.remove_repeats(spark.createDataFrame([(1, text), (2, "new" + text)], "doc_id long, text string"), keep_text=True).orderBy("doc_id").collect()
    # All but the first ten bytes of the first text are covered by strings that start ten bytes earlier, too.
    assert bytes(got[0].kept) == text.encode()[:10] and got[0].n_spans == 1
    assert bytes(got[1].kept) == b"new"
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_very_many_rows_without_id_or_of_one_id(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    rows = [(None if k % 2 else 7, f"{k} {rng.random()} {passage} {rng.random()}") for k in range(18_000)]
    rows += [(None, "same")] * 50 + [(7, passage)] * 20
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    want = brute(sorted(rows, key=order), 100)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert sum(w[2] >= 150 for w in want) == 18_000 - 1 + 20


def test_no_table_is_left(spark):
    suffix_dedup.remove_repeats(spark.createDataFrame([(1, "x" * 300)], "doc_id long, text string")).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("suffix_texts_")]
