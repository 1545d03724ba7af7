import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from lexloom.llm import bpe, pieces

MODEL = bpe.public_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def table():
    return pieces.Pieces(MODEL)


def ids(x):
    return np.frombuffer(x, "<u4").tolist()


def test_encoding_equals_the_library(library, table):
    rng = random.Random(1)
    letters = [chr(c) for c in range(0, 0x250)] + list("   \n\t'‐’“”…€™　​é漢☃▁▁字あいうéе́ния") + ["<s>", "</s>", "<unk>", "<0x0A>", "....", "----", "\U0001f600"]
    names = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    for pool, most in ((letters, 30), (names, 12), (list("aeinrst "), 25), ([" ", "  ", "a", "\n"], 60)):
        for _ in range(3000):
            text = "".join(rng.choice(pool) for _ in range(rng.randint(0, most)))
            got = table.encode(text)
            assert ids(got) == library.encode(text, add_bos=True, add_eos=True), text
            assert table.decode(got) == library.decode(ids(got)), text


def test_decoding_of_any_ids_equals_the_library(library, table):
    rng = random.Random(2)
    for _ in range(6000):
        row = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(131, 259), 28705, 0, 1, 2]) for _ in range(rng.randint(0, 9))]
        assert table.decode(np.array(row, "<u4").tobytes()) == library.decode(row), row


def test_caches_are_bounded(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_STRETCHES", 7)
    monkeypatch.setattr(pieces, "CACHE_PAIRS", 5)
    small, text = pieces.Pieces(MODEL), " ".join(f"wörter{i}abc" for i in range(200))
    assert ids(small.encode(text)) == library.encode(text, add_bos=True, add_eos=True)
    assert len(small.stretches) <= 7 and len(small.pairs) <= 5


def test_one_stretch_without_a_cut(library, table):
    text = "abcdefghijklmnopqrstuvwxyz" * 8000
    assert ids(table.encode(text)) == library.encode(text, add_bos=True, add_eos=True)
    assert max(map(len, table.stretches)) <= pieces.LONGEST


def test_a_space_within_a_piece_leaves_texts_whole():
    assert pieces._cutter(["a b", "a", "b"]).findall(" a b\nc") == [" a b\nc"]
    assert pieces._cutter(["ab", " ab", "a", "b", ".."]).findall(" ab.. xb") == [" ab", "..", " x", "b"]


def test_table_round_trip(messy, pairs, library, nothing):
    want = []
    for i, text in pairs:
        row = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((i, len(row), hashlib.sha256(np.array(row, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(row).encode()).hexdigest()))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    got = [tuple(r) for r in pieces.round_trip(messy, MODEL).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert pieces.round_trip(nothing, MODEL).count() == 0


def test_columns_stay_and_names_may_clash(spark, messy, monkeypatch):
    clash = messy.withColumnsRenamed({"size": "_read", "node": "IDS", "id": "decoded"})
    both = pieces.decode(pieces.encode(clash, MODEL), MODEL)
    assert both.columns == [c for c in clash.columns if c not in ("IDS", "decoded")] + ["ids", "decoded"]
    assert both.where("coalesce(text, '') <> decoded").count() == 0
    at_once = pieces.encode(clash, MODEL, back_col="Decoded")
    assert at_once.columns == [*[c for c in clash.columns if c not in ("IDS", "decoded")], "ids", "Decoded"]
    assert at_once.select("doc_id", "ids", "Decoded").exceptAll(both.select("doc_id", "ids", "decoded")).count() == 0
    assert pieces.decode(spark.createDataFrame([(1, None)], "a int, ids binary"), MODEL).first().decoded == ""
