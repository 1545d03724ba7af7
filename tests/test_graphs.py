import json
import random
from collections import defaultdict

from lexloom.operators import artifacts, graphs


def test_walks_equal_breadth_first_search(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(45)] + [(3, 3), (5, None), (None, 5)]
    marks = {n: rng.choice("xyz") for n in range(0, 30, 7)}
    out = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None:
            out[a].add(b)
    want, near, fams = set(), {}, {}
    for s in range(30):
        seen, fresh = {s: 0}, {s}
        for d in range(1, 6):
            fresh = {b for a in fresh for b in out[a]} - set(seen)
            seen |= dict.fromkeys(fresh, d)
        want |= {(s, n, d) for n, d in seen.items()}
        near[s] = min(((d, marks[n]) for n, d in seen.items() if n in marks), default=(None, None))
        fams[s] = {k: min(((d, f"n{n:02d}") for n, d in seen.items() if d and n % 3 == k), default=(0, ""))[1] for k in range(3)}
    starts = spark.createDataFrame([(n,) for n in [*range(30), 4, None]], "s long")
    frame = spark.createDataFrame(edges, "a long, b long")
    walked = graphs.walks(starts, "s", frame, "a", "b", 5)
    assert sorted(tuple(r) for r in walked.collect()) == sorted(want)
    labels = spark.createDataFrame([*marks.items(), (7, "zz"), (9, None)], "n long, l string")
    got = graphs.nearest_labels(starts, "s", frame, "a", "b", labels, "n", "l", 5).collect()
    assert {r.start: (r.depth, r.label) for r in got} == near and len(got) == 30
    nodes = spark.createDataFrame([(n, f"k{n % 3}", f"n{n:02d}") for n in range(30)], "n long, kind string, name string")
    told = graphs.families(walked, nodes, "n", "kind", "name", ["k0", "k1", "k2"]).collect()
    assert {r.start: {k: r[f"k{k}"] for k in range(3)} for r in told} == fams
    assert graphs.walks(starts.where("false"), "s", frame, "a", "b", 3).count() == 0
    assert graphs.nearest_labels(starts, "s", frame.where("false"), "a", "b", labels.where("false"), "n", "l", 3).where("label is null").count() == 30


FAMILY = {k: "" for k in artifacts.ENTRY_FAMILY}
GOOD = {
    "id": 7, "lemma": "ice cream", "pos": "Noun", "cefr_level": "a1", "difficulty_score": "3", "category": "Food & Drink", "ai_confidence": 1, "phonetic_us": "", "phonetic_uk": None, "phonetic_ar": "", "definition_en": "a cold sweet", "explanation_ar": "x",
    "examples": [{"example_text": t, "intended_cefr": "A1"} for t in ("Ice cream!", "The cream is ice.", "I like ice-cream")], "mnemonic_ar": None, "senses": [{"sense_no": 1, "is_primary": True, "definition_en": "cold"}],
    "collocations": [], "synonyms": [], "antonyms": [], "related_words": {"en": [], "ar": []}, "word_family": FAMILY, "translations": {"arabic_ar": "مثلجات"},
}
CASES = [
    (GOOD, []),
    (None, ["NO_PARSE"]),
    ([1], ["NO_PARSE"]),
    ({k: v for k, v in GOOD.items() if k not in ("id", "senses")}, ["MISSING_FIELDS:id,senses", "ID_MISMATCH", "NO_SENSES", "PRIMARY_COUNT:0"]),
    (GOOD | {"difficulty_score": 3, "category": None, "pos": "verb", "cefr_level": "B1"}, ["POS_MISMATCH", "CEFR_MISMATCH", "DIFFICULTY_BAD", "CATEGORY_BAD"]),
    (GOOD | {"senses": [{"sense_no": 2, "is_primary": "true", "definition_en": "my ICE CREAM"}]}, ["SENSE_NO_NONSEQ", "PRIMARY_COUNT:0", "SENSE_DEF_CONTAINS_LEMMA[0]"]),
    (GOOD | {"examples": [None, {"example_text": "ice", "intended_cefr": "A9"}], "definition_en": "Ice cream", "mnemonic_ar": "an ice cream"}, ["EXAMPLES_COUNT:2", "EXAMPLE_MISSING_LEMMA[0]", "EXAMPLE_BAD_CEFR[0]", "EXAMPLE_MISSING_LEMMA[1]", "EXAMPLE_BAD_CEFR[1]", "DEFINITION_CONTAINS_LEMMA", "MNEMONIC_CONTAINS_LEMMA"]),
    (GOOD | {"collocations": None, "synonyms": [1] * 6, "antonyms": "x", "related_words": {"en": []}, "translations": {}, "word_family": {"noun": None}}, ["COLLOCATIONS_BOUND", "SYNONYMS_BOUND", "ANTONYMS_BOUND", "RELATED_WORDS_MISSING_EN_AR", "ARABIC_TRANSLATION_EMPTY", "WF_MISSING_verb", "WF_MISSING_adj", "WF_MISSING_adv"]),
]


def test_entry_issues(spark):
    rows = spark.createDataFrame([(7, "noun", "A1", i, None if c is None else json.dumps(c)) for i, (c, _) in enumerate(CASES)], "id long, pos string, level string, i int, raw string")
    got = artifacts.entry_issues(rows, "raw", "id", "pos", "level").orderBy("i").collect()
    assert [r.issues for r in got] == [want for _, want in CASES]
