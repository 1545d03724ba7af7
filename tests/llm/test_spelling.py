import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lexloom.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(rows, noise=97, least=5, count=3):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=2):
    form, out = {}, {}
    for w, n in words.items():
        found = [v for v in words if near(w, v)]
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
        out[w] = len(found)
    rows = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, out[w], words[form[w]] if form[w] else None))
    return sorted(rows)


def corpus(seed, n=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abÿé÷") for _ in range(rng.randint(4, 8))) for _ in range(12)] + ["aaaaaa", "AAAAA", "aaaaaaa", "ababab"]

    def word():
        w = rng.choice(stems)
        if rng.random() < 0.4:
            i = rng.randrange(len(w))
            w = w[:i] + rng.choice(["", "a", "É", "b" + w[i]]) + w[i + 1 :]
        return w

    return [(rng.choice([k, k, None]), rng.choice([None, "", *[" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(5)]])) for k in range(n)]


@pytest.mark.parametrize("seed, noise", [(1, 97), (2, 5), (3, 0)])
def test_equals_brute_force(spark, seed, noise):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(words_of(rows, noise))
    assert len(want) > 30 and any(r[1] for r in want)
    assert sorted(map(tuple, spelling.variants(docs, noise=noise).collect())) == want


def test_collisions_are_told_apart(spark, monkeypatch):
    """With a base of 1 every anagram collides; strings decide."""
    rows = corpus(4)
    monkeypatch.setattr(spelling, "BASE", 1)
    monkeypatch.setattr(spelling, "INVERSE", 1)
    before = spelling.deletion_keys(["abcde", "edcba"])
    assert before[3][0] == before[3][1]
    counted = spark.createDataFrame(sorted(words_of(rows).items()), "word string, n long")
    got = {r.word: r.n_near for r in spelling.near_words(counted).collect()}
    assert got == {r[0]: r[4] for r in brute(words_of(rows))}


def test_keys_are_hashes_of_the_deletions():
    words = ["hello", "aab", "ÿ", "abcabc"]
    of, place, first, key = spelling.deletion_keys(words)
    plain = lambda w: sum(ord(c) * pow(spelling.BASE, i, 1 << 64) for i, c in enumerate(w)) % (1 << 64)
    for k, at, fresh, h in zip(of, place, first, key, strict=True):
        w = words[k]
        assert int(h) == plain(w if at < 0 else w[:at] + w[at + 1 :])
        assert bool(fresh) == (at >= 0 and (at == 0 or w[at] != w[at - 1]))
    assert [len(x) for x in spelling.deletion_keys([])] == [0] * 4


def test_sorted_batches_may_cut_a_group():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    key = np.sort(rng.integers(0, 40, 400))
    place = rng.integers(-1, 3, 400)
    first = (place >= 0) & (rng.random(400) < 0.5)
    table = pa.table({"key": key, "id": np.arange(400), "place": place.astype(np.int32), "first": first})
    groups = defaultdict(list)
    for r in table.to_pylist():
        groups[r["key"]].append(r)
    want = set()
    for rows in groups.values():
        cells = Counter(r["place"] for r in rows)
        both = any(r["place"] < 0 for r in rows) and any(r["first"] for r in rows)
        want |= {r["id"] for r in rows if (r["place"] >= 0 and cells[r["place"]] > 1) or (both and (r["place"] < 0 or r["first"]))}
    for size in (1, 7, 400):
        got = [i for b in spelling._partnered(table.to_batches(max_chunksize=size)) for i in b.column("id").to_pylist()]
        assert sorted(got) == sorted(want)


def test_long_chains_and_long_words(spark):
    long = "ab" * 2000
    counts = [("aaaaa" + "b" * k, 3 << k) for k in range(12)] + [(long, 5), (long + "c", 9), ("c" + long, 9), (long[:-1], 20)]
    rows = brute(dict(counts))
    near = spelling.near_words(spark.createDataFrame(counts, "word string, n long"))
    assert sorted((r.word, r.n_near, r.near) for r in near.collect()) == sorted((r[0], r[4], min([v for v, _ in counts if globals()["near"](r[0], v)], key=lambda v: (-dict(counts)[v], v))) for r in rows)
    formed = spark.createDataFrame([(r[0], r[1]) for r in rows], "word string, form string")
    assert {r.word: r.root for r in spelling.rooted(formed).collect()} == {r[0]: r[2] for r in rows}


def test_messy_and_empty_tables(spark, messy, pairs, nothing):
    assert sorted(map(tuple, spelling.variants(messy).collect())) == brute(words_of(pairs))
    assert spelling.variants(nothing).count() == 0
