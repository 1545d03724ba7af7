import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lexloom.llm import near_copies, simhash
from lexloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute_print(text, n=3):
    words = WORD.findall(low(text))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(pairs):
    prints = [(i, brute_print(t)) for i, t in pairs]
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, f"{p:016x}", least.get(find(k))) for k, (i, p) in enumerate(prints)]


def test_groups_equal_brute_force(messy, pairs):
    got = simhash.near_groups(messy)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute_groups(pairs)))


def test_empty_table(nothing):
    assert simhash.near_groups(nothing).count() == 0
    assert near_copies.drop_near_copies(nothing).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_prints_within_three_bits_share_a_cell(fp, flips):
    other = fp
    for b in flips:
        other ^= 1 << b
    a, b = simhash.popcount_cells(np.array([fp, other], np.uint64))
    assert set(a.tolist()) & set(b.tolist())


def test_chains_and_dense_cells_link_like_all_pairs(spark):
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 2**63, 4, dtype=np.uint64)
    prints = {int(c) for c in centres}
    for c in centres:
        at = int(c)
        for _ in range(60):  # a chain of single and double flips
            for b in rng.choice(64, rng.integers(1, 3), replace=False):
                at ^= 1 << int(b)
            prints.add(at)
    prints |= {int(x) for x in rng.integers(0, 2**63, 300, dtype=np.uint64)}
    fps = sorted(prints)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    got = {r.node: r.root for r in components(edges).collect()}
    parent = {f: f for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 3:
                x, y = find(signed[i]), find(signed[j])
                parent[max(x, y)] = min(x, y)
    assert {f: got.get(f, f) for f in signed} == {f: find(f) for f in signed}
    assert edges.count() <= 32 * len(fps)


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(5000, 5001), (5001, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(100)}, 5000: 5000, 5001: 5000}


def test_near_copies_go_and_others_stay(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    rows, gone = [], set()
    for g in range(12):
        base = [word() for _ in range(200)]
        rows.append((g * 10, " ".join(base)))
        close, far = base.copy(), base.copy()
        close[50] = word()  # shares 191 of 201 shingles
        for k in range(0, 200, 12):
            far[k] = word()  # shares less than half
        rows += [(g * 10 + 1, " ".join(close)), (g * 10 + 2, " ".join(far))]
        gone.add(g * 10 + 1)
    rows += [(900, None), (901, ""), (902, "two words"), (903, "two words"), (None, rows[0][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    got = near_copies.drop_near_copies(df)
    assert got.columns == df.columns
    assert {r.doc_id for r in got.collect()} == {i for i, _ in rows if i is not None} - gone - {903}


def test_tally_counts_bits():
    rng = np.random.default_rng(1)
    counts = np.array([0, 1, 14, 15, 16, 100, 0, 3])
    hashes = rng.integers(0, 2**63, (counts.sum(), 2), dtype=np.uint64)
    got, at = simhash._tally(hashes, counts), 0
    for row, n in zip(got, counts, strict=True):
        part = hashes[at : at + n]
        assert row.tolist() == [int(((part[:, w] >> np.uint64(b)) & np.uint64(1)).sum()) for w in range(2) for b in range(64)]
        at += n


def test_other_distances_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4)


def test_narrow_segments_give_the_same_links(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    more = [int(x) ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for x in base for k in (1, 2, 3, 4)]
    prints = np.unique(np.array([*map(int, base), *more], np.uint64))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(prints.view(np.int64).tolist())], "id long, fp long")
    root = {v: v for v in prints.tolist()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints.tolist()):
        for b in prints.tolist()[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    want = {frozenset(x for x in root if find(x) == r) for r in {find(x) for x in root}}
    for width in (1, 2):
        got = {}
        for r in components(simhash.links(df, width=width)).collect():
            got.setdefault(r.root, set()).add(r.node % 2**64)
        assert {frozenset(g) for g in got.values()} == {g for g in want if len(g) > 1}
