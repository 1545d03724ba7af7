import random

import pytest

WORDS = "the of sun run cat river stone light idiot würde été niño house-keeping 'tis 42 A.B x".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and ids, clashing columns."""
    rng = random.Random(7)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(25)]
    rows = [(i, t, rng.choice(["en", "de", None]), f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(30 + i, base[i], "en", "s0") for i in range(4)]  # copies
    rows += [(40 + i, base[i].upper(), "en", "s9") for i in range(2)]
    rows += [(50, None, "en", "s1"), (51, "", None, None), (52, " \t\n", "de", None), (53, "word", None, "s1"), (54, "Ünïcödé ☃ 漢字 é", "fr", "s2")]
    rows += [(60, base[5], "en", "s1")] * 3  # rows repeated as a whole
    rows += [(61, base[6], "en", "s1"), (61, base[7], "de", "s2")]  # an id with two texts
    rows += [(None, base[8], "en", "s0"), (None, None, None, None)]
    rows += [(70, prose(rng, 30_000), "en", "s0"), (71, "a" * 3000, "en", "s0")]
    full = [(*r, len(r[1]) if r[1] is not None else None, 1, "x", 2.0, True, "y", 7) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, id string, score double, kept boolean, node string, _t int"
    return spark.createDataFrame(full, schema).repartition(5)


@pytest.fixture(scope="session")
def pairs(messy):
    return [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.where("false")
