from lexloom.llm import licenses


def test_notices_are_found_beside_other_words(spark):
    mit, gpl = licenses.TEMPLATES["MIT"][2], licenses.TEMPLATES["GPL-2.0"][0]
    words, code = mit.split(), " ".join(f"a{i} = b{i * 7};" for i in range(60))
    wrapped = "\n".join("# " + " ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    texts = [
        "This file is released under the MIT License. See LICENSE for details.",
        code + "\n" + wrapped + "\n" + code[::-1],
        code + " " + mit + " " + code[::-1],
        code + " Released under the MIT License. and then " + gpl + " " + code,
        "Released under the MIT License.\nand this one is Released under CC0 1.0 Universal. or so they say",
        "the license of this file is not known to anyone under the sun",
        "Released under the MIT License.\n\nReleased under the MIT License.",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.license, r.dice, r.n_matches) for r in licenses.scan(df, windows=True).collect()}
    assert [got[i] for i in (0, 1, 2)] == [("MIT", 1.0, 1)] * 3
    assert got[3] == ("GPL-2.0", 1.0, 2) and got[4] == ("CC0-1.0", 1.0, 2)
    assert got[5] == (None, 0.0, 0) and got[6] == ("MIT", 1.0, 1)


def test_two_and_three_clauses_are_told_apart(spark):
    two, three = licenses.TEMPLATES["BSD-2-Clause"][0], licenses.TEMPLATES["BSD-3-Clause"][0]
    opening = licenses.TEMPLATES["BSD-unspecified"][0]
    wrap = lambda t, by: t.replace(". ", "." + by)
    rows = [(1, two), (2, three), (3, opening), (4, wrap(two, "\n")), (5, wrap(three, "\n")), (6, "Some words.\n\n" + wrap(three, "\n\n")), (7, "x " * 50 + two + " y" * 50)]
    got = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), windows=True).collect()}
    assert got == {1: "BSD-2-Clause", 2: "BSD-3-Clause", 3: "BSD-unspecified", 4: "BSD-2-Clause", 5: "BSD-3-Clause", 6: "BSD-3-Clause", 7: "BSD-2-Clause"}


def test_signal_words_may_stand_apart(spark):
    texts = ["Released   UNDER -- the\nMIT/License!", "released" + " " * 200_000 + "under the MIT license", "released" + " " * 200_000, "unreleased under the MIT licence"]
    got = [r.license for r in licenses.scan(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")).orderBy("doc_id").collect()]
    assert got == ["MIT", "MIT", None, None]
