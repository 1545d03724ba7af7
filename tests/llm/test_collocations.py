import random
import re
from collections import Counter, defaultdict

import pytest

from lexloom.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, most, least, percent, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, most + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        kept = []
        for g, a in found.items():
            inside = lambda h, g=g: len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h)))
            if any(100 * b >= percent * a and inside(h) for h, b in found.items()):
                continue
            score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "é", "İ", "x y", "in", "der", "a b", "zz"]
    seps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "!?", "\x0b", "\x1c", ""]
    text = lambda: "".join(rng.choice(words[: rng.randint(3, 12)]) + rng.choice(seps) for _ in range(rng.randint(0, 60)))
    return [(rng.choice(["en", "en", "de", None, "und"]), rng.choice([None, "", text(), text(), text()])) for _ in range(n)]


@pytest.mark.parametrize("most, percent", [(2, 50), (3, 50), (3, 90), (5, 40)])
def test_equals_brute_force(spark, monkeypatch, most, percent):
    monkeypatch.setattr(collocations, "SLICE", 3)
    rows = corpus(most)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.collocations(docs, top=40, most_words=most, least_count=4, subsumed_percent=percent).collect()
    assert sorted(map(tuple, got)) == brute(rows, most, 4, percent, 40)


def test_small_blocks_give_the_same(spark):
    rows = [(r[0], r[1]) for r in corpus(9)]
    want = brute(rows, 3, 4, 50, 2000)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"lang": a or "und", "text": b or ""} for a, b in rows])
    before = collocations.BLOCK_WORDS, collocations.OPEN_WORDS, collocations.TaskContext
    try:
        collocations.BLOCK_WORDS, collocations.OPEN_WORDS = 50, 90
        collocations.TaskContext = type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": staticmethod(lambda: 5)}))})
        parts = list(collocations._blocks([batch]))
    finally:
        collocations.BLOCK_WORDS, collocations.OPEN_WORDS, collocations.TaskContext = before
    blocks = [r for p in parts for r in p.to_pylist() if r["local"] == 0]
    assert len({r["block"] for r in blocks}) == len(blocks) > 10
    totals = Counter()
    for r in blocks:
        totals[r["lang"]] += r["n"]
    assert {w[0]: w[6] for w in want}.items() <= totals.items()


def test_messy_and_empty_tables(spark, messy, nothing):
    got = collocations.collocations(messy, least_count=3).collect()
    rows = [(r.lang, r.text) for r in messy.select("lang", "text").collect()]
    assert sorted(map(tuple, got)) == brute(rows, 3, 3, 50, 2000)
    assert collocations.collocations(nothing).count() == 0


def test_scores_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("4000000000L AS f", "array(4000000001L, 5000000000L) AS begins", "array(7000000000L, 4000000000L) AS ends")
    cut = row.select(collocations._cuts(3).alias("c")).first().c
    a = 4_000_000_000
    scores = [1000000 * a * a // (4_000_000_001 * a), 1000000 * a * a // (5_000_000_000 * 7_000_000_000)]
    assert (cut.score, cut.k, cut.l, cut.r) == (scores[1], 2, 5_000_000_000, 7_000_000_000)
