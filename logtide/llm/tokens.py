"""Token ids of whole texts, as bytes of little-endian unsigned 32-bit ids.

The tokenizers library makes every id. A byte-level tokenizer joins text neither
across the ends of a run of white space nor between words and punctuation, so a
text is cut there and the ids of each distinct unit are asked for once; the tasks of one
stage in a Python worker share what they know.
Outside the common alphabets it is cut at white space only; a text with characters on
whose kind libraries differ, or with the string of a special token, is encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array

from logtide.llm.words import stage_memo

# Entries of the memo of pieces and of that of other units; the largest take about 150
# bytes each. Words, most of what is remembered, are in the first alone.
MEMO_PIECES, MEMO_UNITS = 500_000, 100_000
_UNIT = re.compile(r" ?\S+|\s+(?!\S)|\s")
# Letters, digits and apostrophes between them; white space; other characters.
_FINE_UNIT = re.compile(
    r" ?[^\W_]+(?:'[^\W_]+)*|'[^\W_]+(?:'[^\W_]+)*|\s+(?!\S)| ?(?:[^\w\s]|_)+|\s"
)
_WIDE_SPACE = re.compile(r" (?=\s|$)")
_UNCOMMON = re.compile("[^\x00-\u052f\u2010-\u2027]")
# White space to Python, but not to the tokenizer's pattern.
_UNSAFE = re.compile("[\x1c-\x1f﻿᠎]")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def largest_id(path: str) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: printable Latin-1
    as it is, the other bytes from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + n) for n, b in enumerate(others)}


class _Ids(dict):
    """Id bytes of a unit, asked from the tokenizer the first time.

    A unit of letters is one word to a byte-level tokenizer, so its model alone
    is asked; what else there is goes through the whole tokenizer.
    """

    def __init__(self, path: str, special_as_text: bool):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        strings = [re.escape(t.content) for t in added if not (special_as_text and t.special)]
        self.added = re.compile("|".join(strings)) if strings else None
        self._model = self.tokenizer.model
        self._letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self._space = _byte_letters()[0x20]
        self.bare = (
            self.tokenizer.normalizer is None
            and isinstance(self._model, BPE)
            and isinstance(self.tokenizer.pre_tokenizer, ByteLevel)
            and not self.tokenizer.pre_tokenizer.add_prefix_space
        )

    def __missing__(self, unit: str) -> bytes:
        ids = self[unit] = self.word(unit) if self.bare and unit.lstrip(" ").isalpha() else self.plain(unit)
        return ids

    def word(self, word: str) -> bytes:
        """Ids of letters, perhaps after one space."""
        letters = word.encode().decode("latin-1").translate(self._letters)
        return array("I", [token.id for token in self._model.tokenize(letters)]).tobytes()

    def spaced_ascii(self, word: str) -> bytes:
        """Ids of a space and letters that stand for themselves."""
        return array("I", [token.id for token in self._model.tokenize(self._space + word)]).tobytes()

    def plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class _SpacedIds(dict):
    """Id bytes of a piece of text with the space before it, joined from its units."""

    def __init__(self, units: _Ids):
        super().__init__()
        self.units = units

    def __missing__(self, piece: str) -> bytes:
        if not piece.isalpha():
            word, mark = piece[:-1], piece[-1:]
            if word.isalpha() and mark in ".,":
                ids = self[word] + self.units[mark]
            else:
                first, *rest = _FINE_UNIT.findall(" " + piece)
                ids = self.spaced(first) + b"".join(map(self.units.__getitem__, rest))
        elif not self.units.bare:
            ids = self.units.plain(" " + piece)
        elif piece.isascii():
            ids = self.units.spaced_ascii(piece)
        else:
            ids = self.units.word(" " + piece)
        self[piece] = ids
        return ids

    def spaced(self, unit: str) -> bytes:
        """Ids of the first unit of a text that begins with a space."""
        word = unit[1:]
        return self[word] if word.isalpha() else self.units[unit]


class Encoder:
    """``encode`` gives the id bytes of a text, as the library does with
    ``add_special_tokens=False``: the string of a special token has that token's id.

    With ``special_as_text`` such strings are ordinary text. A missing or empty text
    has no ids. The ids of units and pieces stay in a worker for the tasks of a stage.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        def made() -> _SpacedIds:
            return _SpacedIds(_Ids(path, special_as_text))

        self._pieces = stage_memo((path, special_as_text), made)
        self._units = self._pieces.units

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        added = self._units.added
        if _UNSAFE.search(text) or (added is not None and added.search(text)):
            return self._units.plain(text)
        for memo, most in ((self._pieces, MEMO_PIECES), (self._units, MEMO_UNITS)):
            if len(memo) > most:
                memo.clear()
        if not text.isascii() and _UNCOMMON.search(text):
            return b"".join(map(self._units.__getitem__, _UNIT.findall(text)))
        if _WIDE_SPACE.search(text):
            return b"".join(map(self._units.__getitem__, _FINE_UNIT.findall(text)))
        first, *rest = text.split(" ")
        ids = map(self._units.__getitem__, _FINE_UNIT.findall(first))
        return b"".join(ids) + b"".join(map(self._pieces.__getitem__, rest))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        return [self.encode(t) for t in texts]
