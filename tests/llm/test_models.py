import random
import zlib

import numpy as np

from lexloom.llm import language, toxicity


def out_of_fit(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def corpus(spark, n=1500):
    rng = random.Random(5)
    parts = {"aa": "the ing tion er and".split(), "bb": "sch ung ein lich der".split(), "cc": "eau oui ment les que".split()}
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice(list(parts))
        words = ["".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(8, 60))]
        toxic = rng.random() < 0.12
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(["idiot", "scum", "zorkel" + rng.choice(parts[lang]), "zorkel" + rng.choice(parts[lang])])
        rows.append((i, " ".join(words), lang if rng.random() < 0.8 else None))
        if rng.random() < 0.7:
            labels.append((i, int(toxic)))
    truth = {i: int("zorkel" in t or "idiot" in t or "scum" in t) for i, t, _ in rows}
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int"), rows, truth


def test_language_on_held_out_rows(spark):
    docs, _, rows, _ = corpus(spark)
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert all(r.held_out == out_of_fit(i) and 0 <= r.score <= 1 for i, r in got.items())
    own = [(got[i].lang_pred, lang) for i, _, lang in rows if lang and out_of_fit(i)]
    assert np.mean([a == b for a, b in own]) > 0.98


def test_language_does_not_see_held_out_labels(spark):
    docs, _, _, _ = corpus(spark, 300)
    from pyspark.sql import functions as F

    from lexloom.llm.sampling import held_out

    other = docs.withColumn("lang", F.when(held_out("doc_id"), "zz").otherwise(F.col("lang")))
    assert sorted(map(tuple, language.identify(docs).collect())) == sorted(map(tuple, language.identify(other).collect()))


def test_language_of_odd_texts(messy, nothing, spark):
    got = language.identify(messy)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == messy.count()
    by = {r.doc_id: r.lang_pred for r in got.collect()}
    assert by[50] == by[51] == by[52] == "und" and by[53] in ("en", "de", "fr")
    assert language.identify(nothing).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert tuple(language.identify(unlabelled).first()) == (1, out_of_fit(1), "und", 0.0)


def test_batch_scores_equal_plain_sums():
    grams, starts = language.gram_buckets(["ab", "", "ABC"])
    assert starts.tolist() == [0, 3, 4]
    assert (grams[:3] < language.BUCKETS).sum() == 3 and (grams[3] == language.BUCKETS).all() and (grams[4:] < language.BUCKETS).sum() == 6
    model = language.LanguageModel(["x", "y"], np.random.default_rng(0).normal(size=(language.BUCKETS + 1, 2)).astype(np.float32) * (np.arange(language.BUCKETS + 1) < language.BUCKETS)[:, None], np.log([0.5, 0.5]))
    together, alone = model.scores(["abc", "dd", "e f"]), np.concatenate([model.scores([t]) for t in ["abc", "dd", "e f"]])
    assert np.allclose(together, alone)


def test_toxicity_on_held_out_rows(spark):
    docs, labels, rows, truth = corpus(spark)
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    held = [i for i, _, _ in rows if out_of_fit(i)]
    assert all(got[i].predicted == (got[i].score >= 0.5) and got[i].held_out == out_of_fit(i) for i in got)
    hit = np.mean([got[i].predicted for i in held if truth[i]])
    wrong = np.mean([got[i].predicted for i in held if not truth[i]])
    assert hit > 0.9 and wrong < 0.02
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}


def test_toxicity_of_odd_texts(spark, messy, nothing):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(20)] + [(None, 1, "x"), (3, None, "x"), (4, 1, "x")], "doc_id long, toxic int, text string")
    got = toxicity.score(messy, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == messy.count()
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert toxicity.score(nothing, labels).count() == 0
    assert toxicity.drop_toxic(messy, labels).columns == messy.columns
    none = toxicity.score(messy, labels.where("false")).collect()
    assert len({r.score for r in none}) == 1 and not any(r.predicted for r in none)


def plain_em(votes, anchor, labels, size):
    """The label model by dense matrices, in floating point."""
    dense = lambda rows: np.array([[k in set(v.tolist()) for k in range(size)] for v in rows], float)
    x, z = dense(votes), dense(anchor)
    both, weight, prior = np.concatenate([x, z]), np.ones(size), None
    p = np.concatenate([np.zeros(0), labels.astype(float)])
    rows = z
    for turn in range(-1, toxicity.ROUNDS):
        t, n = p.sum(), len(rows)
        a = np.clip((rows.T @ p + 0.05) / (t + 1), 1e-6, 1 - 1e-4)
        b = np.clip((rows.T @ (1 - p) + 0.05) / (n - t + 1), 1e-6, 1 - 1e-4)
        if turn == -1 or turn in toxicity.CORRELATED:
            within = rows.T @ (rows * p[:, None]) - t * np.outer(a, a) + rows.T @ (rows * (1 - p)[:, None]) - (n - t) * np.outer(b, b)
            np.fill_diagonal(within, 0)
            spread = np.sqrt(t * a * (1 - a) + (n - t) * b * (1 - b)) + 1e-9
            close = within / np.outer(spread, spread)
            weight = 1 / (1 + np.where(close > toxicity.CLOSE, close, 0).sum(axis=1))
        prior = np.clip(t / n, 1e-3, 1 - 1e-3)
        odds = np.log(prior / (1 - prior)) + x @ (np.log(a / b) * weight)
        p = np.concatenate([1 / (1 + np.exp(-np.clip(odds, -40, 40))), labels])
        rows = both
    return a, b, weight, prior


def some_votes(n, seed, rates=(0.85, 0.85, 0.85, 0.6, 0.3), noise=(0.02, 0.02, 0.02, 0.05, 0.03)):
    """Three voters that are one family, and two alone; the sixth is the silence of all."""
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(int)
    said = rng.random((n, 5)) < np.where(y[:, None] == 1, rates, noise)
    said[:, 1] = said[:, 2] = said[:, 0]
    return y, [np.array(np.flatnonzero(r).tolist() or [5], "<u2") for r in said]


def test_label_model_equals_plain_em_wherever_counts_are_summed(spark):
    y, votes = some_votes(1500, 0)
    seen, anchored = votes[300:], votes[:300]
    rows = spark.createDataFrame([(bytearray(v.tobytes()), 1) for v in seen], "votes binary, n long").repartition(3)
    model = toxicity.LabelModel.fit(toxicity._counting(rows), anchored, y[:300], 6)
    a, b, weight, prior = plain_em(seen, anchored, y[:300], 6)
    assert np.allclose(model.toxic_rate, a, atol=1e-5) and np.allclose(model.clean_rate, b, atol=1e-5)
    assert np.allclose(model.weight, weight, atol=1e-4) and abs(model.prior - prior) < 1e-5
    grouped = rows.groupBy("votes").sum("n").withColumnRenamed("sum(n)", "n")
    again = toxicity.LabelModel.fit(toxicity._counting(grouped), anchored, y[:300], 6)
    assert (again.toxic_rate == model.toxic_rate).all() and (again.weight == model.weight).all()


def test_label_model_learns_from_unlabelled_votes_and_weighs_families_down(spark):
    y, votes = some_votes(4000, 1)
    few = range(60)
    rows = spark.createDataFrame([(bytearray(v.tobytes()), 1) for v in votes], "votes binary, n long")
    model = toxicity.LabelModel.fit(toxicity._counting(rows), [votes[i] for i in few], y[:60], 6)
    lift = model.toxic_rate / model.clean_rate
    assert lift[0] > 10 and lift[3] > 3 and lift[4] > 3 and lift[5] < 0.3
    assert model.weight[3] > 2 * model.weight[0]
    told = model.posterior(votes)
    assert np.mean((told > 0.5) == y) > 0.9


def test_the_classifier_follows_the_voters(spark, monkeypatch):
    docs, labels, rows, truth = corpus(spark, 900)
    plain = toxicity.train(docs, labels)
    monkeypatch.setattr(toxicity, "mined_voters", lambda *features: toxicity.Voters({"=scum": 0}))
    other = toxicity.train(docs, labels)
    assert plain.weights != other.weights


def test_long_runs_are_read_once():
    import time

    began = time.perf_counter()
    for text in ("A" * 1_000_000, "AB " * 4 + " " * 1_000_000, "AB" + " " * 1_000_000 + "CD", "*" * 1_000_000, "you are " * 100_000, "A!" * 500_000):
        for name in toxicity.PATTERNS:
            toxicity.pattern_found(name, text)
    assert time.perf_counter() - began < 5
    assert toxicity.pattern_found("shouting", "xABC DE FG HI JKL") and not toxicity.pattern_found("shouting", "ABC DE FG HI J")


def test_one_id_of_very_many_texts_is_bounded(spark):
    docs = spark.createDataFrame([(7, "idiot " + "".join("abcdefghij"[int(c)] for c in str(i))) for i in range(3000)] + [(i, f"clean {i}") for i in range(10, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), *[(i, 0) for i in range(10, 40)]], "doc_id long, toxic int")
    sample, others = toxicity._samples(docs, labels, "doc_id", "text", "toxic", 500)
    assert 200 < len(sample.words) < 900 and len(others.words) <= toxicity.OTHER_ROWS * 1.2


def test_language_equals_a_plain_naive_bayes(spark):
    import math
    from collections import Counter

    docs, _, rows, _ = corpus(spark, 200)

    def bucket(gram):
        mixed = 0
        for k, c in enumerate(gram):
            mixed = ord(c) if k == 0 else (mixed * 0x9E3779B1 + ord(c)) % 2**32
        return ((mixed ^ (mixed >> 15)) * (0x85EBCA6B + 2 * (len(gram) - 1)) % 2**32) >> 16

    def grams(text):
        t = text.lower()
        return [bucket(t[i : i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)]

    seen, shares = {}, Counter()
    for i, t, lang in rows:
        if lang and not out_of_fit(i):
            seen.setdefault(lang, Counter()).update(grams(t))
            shares[lang] += 1
    size = {k: sum(c.values()) + language.BUCKETS * language.SMOOTHING for k, c in seen.items()}
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    for i, t, _ in rows:
        own = grams(t)
        odds = {k: math.log(shares[k] / sum(shares.values())) + sum(math.log((c[g] + language.SMOOTHING) / size[k]) for g in own) for k, c in seen.items()}
        best = max(sorted(odds), key=odds.get)
        assert got[i].lang_pred == best and abs(got[i].score - 1 / sum(math.exp(o - odds[best]) for o in odds.values())) < 1e-3


def test_a_rare_language_is_learned_from_all_its_rows(spark):
    from lexloom.llm.sampling import bounded_by_class

    rows = spark.range(5000).selectExpr("id", "if(id < 40, 'rare', 'common') as lang")
    got = {r.lang: r["count"] for r in bounded_by_class(rows, "id", "lang", {"rare": 40, "common": 4960}, 500).groupBy("lang").count().collect()}
    assert got["rare"] == 40 and 350 < got["common"] < 560
