"""SentencePiece encoding and decoding by a table of last tokens.

Merging repeatedly replaces the adjacent pair whose joined piece has the best score, the leftmost one of equals.
Every token has a trace: the merges that make it of its characters, in their order.  Two tokens side by side
stay as they are if, while both traces run with the better head first, no pair across their border ever beats
both heads.  The pairs of a longer row of tokens do not influence each other, as the best head of all is the best
of any two that it belongs to; so a row of tokens is what merging gives if and only if all its neighbours are
compatible, and each prefix of a text has one last token.  That token is found among the vocabulary's pieces
that end at the prefix's end (an automaton lists them, longest first), as the one compatible with the last
token of what is left before it.  Going back from the end of the text through this table gives the ids.

A text is cut where no piece of the vocabulary could reach across; what is between two cuts repeats, and a
bounded cache keeps its ids.  A character without a piece becomes its UTF-8 bytes' pieces.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import hold_name, text_column
from .shipping import ship

#: Cached stretches of text, and cached pairs of tokens, a worker; beyond it a cache starts anew.
CACHE_STRETCHES, CACHE_PAIRS = 400_000, 500_000
#: Longer stretches, in characters, are not kept.
LONGEST = 256
#: Bytes of results that go out together.
OUT_BYTES = 8 << 20
#: The sign that stands for a space within pieces.
SPACE = "▁"
_FREE = float("inf")

codecs.register_error("lexloom-each", lambda wrong: ("\ufffd", wrong.start + 1))


def _groups(pieces: list[str]) -> list[str]:
    """Sets of characters, such that no piece holds neighbours of two sets (a piece's leading spaces apart)."""
    parent: dict[str, str] = {}

    def root(c: str) -> str:
        while parent.setdefault(c, c) != c:
            parent[c] = c = parent[parent[c]]
        return c

    for piece in pieces:
        body = piece.lstrip(" ")
        for a, b in pairwise(body):
            parent[root(a)] = root(b)
    sets: dict[str, list[str]] = {}
    for c in parent:
        sets.setdefault(root(c), []).append(c)
    return ["".join(sorted(s)) for s in sets.values()]


def _cutter(pieces: list[str]) -> re.Pattern:
    """Finds stretches: spaces with a run of characters of one set, or of characters that no piece joins."""
    if any(" " in p.lstrip(" ") for p in pieces):
        return re.compile(r"(?s).+")  # a space may be inside a piece: the whole text is one stretch
    groups = sorted(_groups(pieces), key=len, reverse=True)
    classes = ["[" + "".join(map(re.escape, g)) + "]+" for g in groups]
    rest = "[^ " + "".join(re.escape(c) for g in groups for c in g) + "]"
    return re.compile(" *(?:" + "|".join([*classes, rest]) + ")| +")


class _Stretches(dict):
    def __init__(self, ids_of):
        self.ids_of = ids_of

    def __missing__(self, stretch: str) -> bytes:
        if len(self) >= CACHE_STRETCHES:
            self.clear()
        out = self.ids_of(stretch)
        if len(stretch) <= LONGEST:
            self[stretch] = out
        return out


class Pieces:
    """``encode(text)`` gives little-endian unsigned 32-bit ids with begin and end, ``decode(ids)`` the text again."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.rank = {names[i].replace(SPACE, " "): -model.get_score(i) for i in plain}
        self.ids = {names[i].replace(SPACE, " "): i for i in plain}
        self.find = _cutter(list(self.ids)).findall
        self.tails, self.heads, self.names = {}, {}, {}
        automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self._trace(piece, i):
                automaton.add_word(piece, (len(piece), i))
        automaton.make_automaton()
        self.matches = automaton.iter
        self.pairs: dict[int, bool] = {}
        self.stretches = _Stretches(self._ids)
        self.bytes_of = [b"" if model.is_control(i) else names[i].replace(SPACE, " ").encode() for i in range(size)]
        for b, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([b])
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.unknown = model.unk_id()
        self.bytes_of[self.unknown] = " ⁇ ".encode()

    def _trace(self, piece: str, token: int) -> bool:
        """Merge ``piece`` by itself; keep what stands at its ends after each merge.  False if it never becomes one token."""
        row, rank = list(piece), self.rank
        if any(c not in rank for c in row):
            return len(row) == 1
        tails, heads, costs = [row[-1]], [row[0]], []
        while len(row) > 1:
            cost, at = min((rank.get(row[k] + row[k + 1], _FREE), k) for k in range(len(row) - 1))
            if cost == _FREE:
                return False
            row[at : at + 2] = [row[at] + row[at + 1]]
            costs.append(cost)
            tails.append(row[-1])
            heads.append(row[0])
        costs.append(_FREE)
        self.tails[token], self.heads[token] = (costs, tails), (costs, heads)
        return True

    def _compatible(self, a: int, b: int) -> bool:
        """Does no merge cross the border of these neighbours?  Of equal scores the leftmost goes first."""
        (left, tails), (right, heads), rank, i, j = self.tails[a], self.heads[b], self.rank, 0, 0
        while True:
            x, y, across = left[i], right[j], rank.get(tails[i] + heads[j], _FREE)
            if across < x and across <= y:
                return False
            if x == y == _FREE:
                return True
            if x <= y:
                i += 1
            else:
                j += 1

    def _ids(self, stretch: str) -> bytes:
        n, pairs = len(stretch), self.pairs
        last: list = [None] * (n + 1)  # None: the character before has no piece
        for at, match in self.matches(stretch):
            if last[at + 1] is not None:
                continue
            size, token = match
            before = last[at + 1 - size]
            if before is not None:
                key = before[1] << 32 | token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= CACHE_PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self._compatible(before[1], token)
                if not fits:
                    continue
            last[at + 1] = match  # the automaton's own pair: a place costs one pointer
        out = []
        while n:
            if last[n] is None:
                n -= 1
                out.extend(self.byte_ids[b] for b in reversed(stretch[n].encode()))
            else:
                out.append(last[n][1])
                n -= last[n][0]
        return array("I", reversed(out)).tobytes()

    def encode(self, text: str) -> bytes:
        body = b"".join(map(self.stretches.__getitem__, self.find(" " + text.replace(SPACE, " ")))) if text else b""
        return self.begin.to_bytes(4, "little") + body + self.end.to_bytes(4, "little")

    def decode(self, ids: bytes) -> str:
        """The text of any ids: one leading space goes; bytes that are no UTF-8 become U+FFFD each."""
        row = np.frombuffer(ids, "<u4").tolist()
        row = row[row[:1] == [self.begin] : len(row) - (row[-1:] == [self.end])]
        marks = [k for k, i in enumerate(row) if i in (self.begin, self.end)] if self.begin in row or self.end in row else []
        runs = [row[a + 1 : b] for a, b in pairwise([-1, *marks, len(row)])]  # bytes do not join across such an id
        out = "".join(b"".join(map(self.bytes_of.__getitem__, run)).decode(errors="lexloom-each") for run in runs)
        first = next((run[0] for run in runs if run), self.unknown)
        return out[1:] if first != self.unknown and first not in self.byte_of and out.startswith(" ") else out


@cache
def pieces(path: str) -> Pieces:
    """One table a worker process, kept between tasks."""
    return Pieces(path)


def _made(batches: Iterator[pa.RecordBatch], make, columns: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """All but the last column of each batch, and what ``make`` gives of the last, some megabytes at a time."""
    for batch in batches:
        kept, rows, start, held = batch.columns[:-1], [], 0, 0

        def slab(stop: int, kept=kept, batch=batch):
            made = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*[c.slice(start, stop - start) for c in kept], *made], names=[*batch.schema.names[:-1], *columns])

        for k, value in enumerate(batch.columns[-1]):
            rows.append(make(value.as_py()))
            held += sum(map(len, rows[-1]))
            if held >= OUT_BYTES:
                yield slab(k + 1)
                rows, start, held = [], k + 1, 0
        if rows:
            yield slab(batch.num_rows)


def encode(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids", keep: list[str] | None = None, back_col: str | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the ids of every whole text as binary little-endian unsigned 32-bit integers.

    Ids begin with the begin id and end with the end id.  With ``back_col`` they are decoded at once, in the same
    pass.  Null text is empty: those two ids alone.  Rows are independent of each other, so repeated rows and ids, ties,
    null ids and very long texts need nothing special, and nothing is shuffled; an empty table gives none.
    ``ids_col`` and ``back_col`` replace columns of these names.
    """
    ship(docs.sparkSession)
    new = [ids_col] if back_col is None else [ids_col, back_col]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in {n.lower() for n in new}]
    read = hold_name(kept, "_read")
    rows = docs.select(*kept, text_column(text_col).alias(read))
    schema = docs.select(*kept, F.lit(b"").alias(ids_col), *([F.lit("").alias(back_col)] if back_col else [])).schema
    kinds = [pa.binary(), pa.string()][: len(new)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(model)

        def both(text: str) -> tuple:
            ids = table.encode(text)
            return (ids, table.decode(ids)) if back_col else (ids,)

        return _made(batches, both, new, kinds)

    return rows.mapInArrow(work, schema)


def decode(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of its ids, whoever made them; null ids are none and give an empty text."""
    ship(rows.sparkSession)
    kept = [c for c in rows.columns if c.lower() != text_col.lower()]
    read = hold_name(kept, "_read")
    schema = rows.select(*kept, F.lit("").alias(text_col)).schema
    given = rows.select(*kept, F.coalesce(F.col(ids_col), F.lit(b"")).alias(read))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(model)
        return _made(batches, lambda ids: (table.decode(ids),), [text_col], [pa.string()])

    return given.mapInArrow(work, schema)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of every row: ids made of its text, and the text made of those ids."""
    both = encode(docs, model, text_col, "_ids", keep=[id_col], back_col="_back")
    return both.select(
        id_col,
        F.shiftright(F.octet_length("_ids").cast("long"), 2).alias("n_tokens"),
        F.sha2("_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("_back").cast("binary"), 256).alias("decoded_sha256"),
    )
