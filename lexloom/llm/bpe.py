"""Encoding many texts with a public BPE tokenizer, fast and exactly as its library does.

Both vocabularies split a text into pieces by a fixed pattern and merge within a piece only, so the
ids of a text are those of its pieces in turn.  Pieces repeat; a bounded cache keeps theirs.  A text
that holds any character on which the two pattern engines or case tables could differ goes to the
library whole.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from functools import cache

import numpy as np

#: Cached pieces per worker; beyond it the cache starts anew, so its memory is bounded.
CACHE_PIECES = 800_000

# Letters and numbers below U+0180, where classes and lower case are settled.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_NUMBER = "0-9²³¹¼-¾"
_SETTLED = re.compile(r"[\t-\r\x20-\x7e\xa1-ſ‐-‧‰-›€™…]*")
# The piece patterns of the two public vocabularies, over those characters.
_PIECES = {
    "byte": rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+",
    "word": rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+",
}


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level BPE: bytes without one get the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Cache(dict):
    def __init__(self, ids_of):
        self.ids_of = ids_of

    def __missing__(self, piece):
        if len(self) >= CACHE_PIECES:
            self.clear()
        out = self[piece] = array("I", self.ids_of(piece)).tobytes()
        return out


class Encoder:
    """``encode(text)`` gives the ids of a text as unsigned 32-bit integers.

    Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.words = self.library.normalizer is not None
        self.find = re.compile(_PIECES["word" if self.words else "byte"]).findall
        model, letters = self.library.model, _byte_letters()
        self.cache = _Cache(lambda piece: [t.id for t in model.tokenize(piece.encode().decode("latin1").translate(letters))])

    def encode(self, text: str) -> np.ndarray:
        if not _SETTLED.fullmatch(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        if self.words:
            text = unicodedata.normalize("NFC", text).lower()
        return np.frombuffer(b"".join(map(self.cache.__getitem__, self.find(text))), "<u4")


@cache
def encoder(path: str) -> Encoder:
    """One encoder a worker process, kept between tasks."""
    return Encoder(path)


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
