import random

from lexloom.llm import near_copies, simhash
from lexloom.llm.components import components


def test_what_stays_is_what_exact_similarity_leaves(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    texts = []
    for n in range(5, 16):  # short texts, one longer by a word at its end, and one changed there
        for _ in range(6):
            base = [word() for _ in range(n)]
            texts += [base, [*base, word()], [*base[:-1], word()]]
    for n in (30, 100, 400):  # the last words replaced: similarities from 0.75 to 0.9
        for tenths in range(15, 19):
            base = [word() for _ in range(n)]
            shared = round((n - 4) * tenths / 20 * 2 / (1 + tenths / 20))
            texts += [base, base[: shared + 4] + [word() for _ in range(n - shared - 4)]]
    sets = [{tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id for r in near_copies.drop_near_copies(df).collect()}
    assert got == set(root) and len(got) < len(texts)


def test_long_sets_are_hashed_block_by_block(monkeypatch):
    rng = random.Random(2)
    sets = [near_copies.shingle_set(" ".join(str(rng.random()) for _ in range(n)), 5) for n in (3, 700, 1, 2000)]
    whole = near_copies.min_hashes(sets)
    monkeypatch.setattr(near_copies, "BLOCK", 64)
    assert (near_copies.min_hashes(sets) == whole).all()


def test_columns_named_like_internal_ones(spark):
    names = ["_lx_node", "_gone_id", "_gone_node", "_own_id", "_own_node", "_row", "_id", "_node", "node", "root", "cell", "held"]
    text = " ".join(str(n) for n in range(100))
    df = spark.createDataFrame([(1, text, *range(12)), (2, text + " more", *range(12)), (3, "other", *range(12)), (None, None, *range(12))], ", ".join(["doc_id long", "text string", *(f"{n} int" for n in names)]))
    got = near_copies.drop_near_copies(df).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted([(1, text, *range(12)), (3, "other", *range(12)), (None, None, *range(12))], key=repr)


def test_a_large_group_and_a_very_long_text(spark):
    rng = random.Random(9)
    base = [str(rng.random()) for _ in range(60)]
    rows = [(i, " ".join([*base[:-1], str(i % 150)])) for i in range(600)]  # one group, some texts many times
    long = [str(rng.randint(0, 10**6)) for _ in range(60_000)]
    rows += [(1000, " ".join(long)), (1001, " ".join([*long[:-100], "changed"])), (1002, " ".join(long[:30_000]))]
    got = {r.doc_id for r in near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == {0, 1000, 1002}


def test_large_loose_components_are_split_without_losing_a_link(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    texts = []
    for n in (40, 80):  # chains: each text replaces a word of the one before, so that far ones are not similar
        now = [word() for _ in range(n)]
        for k in range(60):
            now = [*now[: k % n], word(), *now[k % n + 1 :]]
            texts.append(now)
    base = [word() for _ in range(100)]
    texts += [[*base[:k], word(), *base[k + 1 :]] for k in range(90)]  # a star
    rng.shuffle(texts)
    sets = [{tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "node long, text string").repartition(4)
    for chunk in (16, 1000):
        got = {r.node: r.root for r in components(near_copies.near_links(rows, 5, 0.8, chunk)).collect()}
        assert [got.get(i, i) for i in range(len(texts))] == root


def test_simhash_brings_near_copies_together_by_itself(spark, monkeypatch):
    rng = random.Random(4)
    texts = {}
    for i in range(0, 40, 2):
        base = [str(rng.randint(0, 10**6)) for _ in range(2000)]
        texts |= {i: " ".join(base), i + 1: " ".join([*base[:900], "changed", *base[901:]])}
    texts |= {100: "a b c " * 3000, 101: "a b c " * 3000 + " ".join(str(rng.random()) for _ in range(20)), 200: " ", 201: "\t", 202: None}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(near_copies, "_cells", lambda rows, words: spark.createDataFrame([], "cell long, node long, held binary"))
    got = {r.doc_id for r in near_copies.drop_near_copies(df).collect()}
    prints = simhash.simhash([simhash.shingle_hashes(texts[i], 3) for i in range(40)])
    gone = {i for i in range(1, 40, 2) if int(prints[i] ^ prints[i - 1]).bit_count() <= 3}
    assert len(gone) > 12 and got == {*range(40), 100, 101, 200, 201, 202} - gone  # 101 has the fingerprint of 100, but not its shingles
