"""Token ids of whole texts, with the ids of words remembered.

A byte-level vocabulary cuts a text before most spaces, so the ids of a text are
those of its space-led words joined. Texts where a word's ids could depend on its
neighbours (two spaces together, special tokens) are encoded in one piece.
"""

from __future__ import annotations

import string
import sys
from array import array

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from .shared import remembered

if array("I").itemsize != 4 or sys.byteorder != "little":
    raise RuntimeError("ids are kept as little-endian 32-bit values")

#: The id that ends each document.
END_ID = 0
SPECIAL = "<|endoftext|>"


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _visible() -> dict[int, str]:
    """The printable stand-in of each byte, by the byte-level rule: printable bytes
    stand for themselves, the others are numbered from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Held(dict):
    """Results of a function, up to a fixed number of them."""

    limit = 20_000

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, text: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        self[text] = found = self.of(text)
        return found


class TokenCache(dict):
    """Ids of words after a space, as little-endian unsigned 32-bit bytes.

    A key is the word without the space; up to ``limit`` words are remembered.
    """

    limit = 150_000
    _held: dict[str, TokenCache] = {}

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.visible = _visible()
        self.space = self.visible[ord(" ")]
        self.marks, self.bare = _Held(self.merged), _Held(self.whole)
        self.line_end = self.whole("\n")

    @classmethod
    def of(cls, path: str | None = None) -> TokenCache:
        path = path or default_path()
        if path not in cls._held:
            cls._held[path] = cls(path)
            remembered(cls._held[path].forget)
        return cls._held[path]

    def forget(self) -> None:
        self.clear()
        self.marks.clear()
        self.bare.clear()

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def merged(self, stretch: str) -> bytes:
        """Ids of a stretch that is cut no further before the merges."""
        shown = stretch if stretch.isascii() else stretch.encode().decode("latin-1").translate(self.visible)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def after_space(self, word: str) -> bytes:
        """Ids of letters after a space."""
        if word.isascii():
            return array("I", [t.id for t in self.model.tokenize(self.space + word)]).tobytes()
        return self.merged(" " + word)

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():  # letters only
            ids = self.after_space(word)
        elif (stem := word.rstrip(string.punctuation)).isalpha():  # letters, then marks
            ids = self[stem] + self.marks[word[len(stem) :]]
        elif word.count("\n") == 1 and (at := word.index("\n")) and at < len(word) - 1 and not (word[at - 1].isspace() or word[at + 1].isspace()):
            ids = self[word[:at]] + self.line_end + self.bare[word[at + 1 :]]
        else:
            ids = self.whole(" " + word)
        if len(word) <= 40:
            if len(self) >= self.limit:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if "  " in text or SPECIAL in text:
            return self.whole(text)
        first, *rest = text.split(" ")
        head = self.bare[first] if first else b""
        return head + b"".join(map(self.__getitem__, rest))
