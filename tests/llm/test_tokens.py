import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lexloom.llm import bpe, packing, shared, token_files

BYTE, WORD = bpe.public_path("byte_bpe_50k.json"), bpe.public_path("word_bpe_49k.json")


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_fast_path_equals_the_library(path):
    rng, slow, fast = random.Random(1), library(path), bpe.Encoder(path)
    letters = [chr(c) for c in range(9, 0x250)] + list("  \n\n\t''sstllΣσİ‐’“”…€™　​é漢☃") + ["<|endoftext|>", " don't", "   "]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert fast.encode(text).tolist() == slow(text)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    fast, slow = bpe.Encoder(BYTE), library(BYTE)
    text = " ".join(f"w{i}" for i in range(100))
    assert fast.encode(text).tolist() == slow(text) and len(fast.cache) <= 10


def test_files_round_trip(spark, messy, pairs):
    encode, start, want = library(BYTE), 0, []
    rows = [*pairs, (-1, "minus one"), (-(2**62), "far below")]
    for i, t in sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
        ids = [*encode(t), 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    more = messy.select("doc_id", "text").union(spark.createDataFrame(rows[-2:], "doc_id long, text string"))
    path = token_files.write_token_files(more, BYTE, partitions=3, file_bytes=2_000)
    manifest = json.loads(shared.read_file(f"{path}/manifest.json"))
    assert manifest["dtype"] == "<u2" and len(manifest["files"]) > 3 and manifest["n_tokens"] == start
    got = [tuple(r) for r in token_files.read_token_files(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == want


def test_no_files_from_nothing(spark, nothing):
    path = token_files.write_token_files(nothing, BYTE)
    assert json.loads(shared.read_file(f"{path}/manifest.json"))["files"] == []
    assert token_files.read_token_files(spark, path).count() == 0


def test_packing_holds_every_piece_once(messy, pairs):
    encode, want = library(WORD), []
    for i, t in pairs:
        ids = [*encode(t), 0]
        for k, s in enumerate(range(0, len(ids), 256)):
            part = ids[s : s + 256]
            want.append((i, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = packing.pack(messy, WORD, capacity=256).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, want)) == sorted(key(tuple(r)[:5]) for r in got)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    counts = defaultdict(int)
    for r in got:
        counts[r.length] += 1
    assert len(bins) <= packing.lower_bound(counts, 256) + 1


def test_packing_nothing(nothing):
    assert packing.pack(nothing, WORD).count() == 0


def held(bins, capacity):
    out = defaultdict(int)
    for pattern, n in bins.items():
        assert 0 < sum(pattern) <= capacity and n > 0
        for x in pattern:
            out[x] += n
    return dict(out)


def squared(bins):
    return sum(sum(p) ** 2 * n for p, n in bins.items())


def lengths_of(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 101, 400) if seed % 2 else rng.integers(20, 60, 300)
    return dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))


@pytest.mark.parametrize("seed", range(8))
def test_exchanges_save_bins_and_keep_all_pieces(seed):
    counts = lengths_of(seed)
    first = packing.next_fit(counts, 100)
    then = packing.swap_search(first, 100)
    assert held(first, 100) == held(then, 100) == counts
    assert packing.lower_bound(counts, 100) <= sum(then.values()) < sum(first.values()) and squared(then) > squared(first)
    best = packing.fewest_bins(counts, 100)
    assert held(best, 100) == counts and sum(best.values()) <= min(sum(then.values()), sum(packing.best_fit(counts, 100).values()))


def test_exchanges_empty_bins_that_best_fit_leaves():
    counts = lengths_of(0)
    greedy = sum(packing.best_fit(counts, 100).values())
    assert sum(packing.swap_search(packing.next_fit(counts, 100), 100).values()) < greedy
    lengths = np.random.default_rng(0).integers(300, 900, 3000)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    found = packing.fewest_bins(counts, 2048)
    assert sum(found.values()) == packing.lower_bound(counts, 2048) < sum(packing.best_fit(counts, 2048).values())


@pytest.mark.parametrize("bins", [{(60,): 1, (50, 30): 1, (40, 10): 1}, {(5, 4): 1, (6, 3): 1, (2,): 1}, {(7,): 2, (3,): 2}, {(6, 2): 1, (5, 3): 1, (4,): 1}])
def test_search_ends_where_no_exchange_is_left(bins):
    capacity = 100 if max(map(max, bins)) > 10 else 10
    left = packing.swap_search(bins, capacity)
    if sum(left.values()) == packing.lower_bound(held(bins, capacity), capacity):
        return
    one = lambda p: {(x,) for x in p}
    two = lambda p: set(packing._pairs(p))
    flat = [p for p, n in left.items() for _ in range(n)]
    for i, a in enumerate(flat):
        for b in flat[:i] + flat[i + 1 :]:
            for out, back in [*((x, ()) for x in one(a)), *((x, y) for x in one(a) | two(a) for y in one(b)), *((x, y) for x in one(a) for y in two(b))]:
                gain = sum(out) - sum(back)
                assert not (0 < gain <= capacity - sum(b) and (sum(b) + gain) ** 2 + (sum(a) - gain) ** 2 > sum(a) ** 2 + sum(b) ** 2)


def test_very_many_pieces_go_from_coarse_to_fine():
    counts = {n: 50_000 + n for n in range(1, 101)}
    found = packing.fewest_bins(counts, 100, coarse=5_000)
    assert held(found, 100) == counts and sum(found.values()) <= 1.001 * packing.lower_bound(counts, 100)
