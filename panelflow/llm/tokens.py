"""Token ids of whole texts from a public tokenizer file, with repeated words encoded once.

A tokenizer that never merges across the start of a white-space run gives the same ids for a
text as for its pieces between those places.  So a text is cut there, each distinct piece is
encoded once per Python worker, and the ids are put together again.  Texts in which a cut
might matter are given to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# White space besides the ASCII marks below, or the start of a special token.
_OTHER_SPACES = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]
UNUSUAL = re.compile("[" + "".join(map(chr, _OTHER_SPACES)) + "]|<\\|")
SPACES = " \t\n\r\x0b\x0c"
RUNS = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
# A space after other white space may belong to that run instead of to the next word.
AFTER_SPACE = tuple(f"{c} " for c in SPACES)
MARKS = ".,;:!?"
# Pieces remembered per worker (twice as many at most), and the longest that is remembered.
KEPT_PIECES, KEPT_CHARS = 800_000, 40
# Longer pieces with a mark are put together from their parts each time.
SHORT = 8


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(moved)}


class Pieces(dict):
    """Piece -> ids as bytes.  A piece not seen lately is encoded when it is looked up."""

    def __init__(self, tokenizer: Tokenizer, code: str, lead: str, lowers: bool):
        self.tokenizer, self.model, self.code, self.lead, self.lowers = tokenizer, tokenizer.model, code, lead, lowers
        self.letters, self.older, self.tails = byte_letters(), {}, {}
        self.begin = lead.translate(self.letters)

    def _tail(self, marks: str) -> bytes:
        ids = self.tails.get(marks)
        if ids is None:
            ids = array(self.code, self.tokenizer.encode(marks, add_special_tokens=False).ids).tobytes()
            if len(marks) <= 4:
                self.tails[marks] = ids
        return ids

    def _encoded(self, piece: str) -> bytes:
        if piece.isalpha() and (piece.isascii() or max(piece) <= "\xff"):
            # Letters are a single unit of the pre-tokenizer, so the model can be asked at once.
            word = piece.lower() if self.lowers else piece
            if not piece.isascii():
                word = word.encode().decode("latin-1").translate(self.letters)
            return array(self.code, [t.id for t in self.model.tokenize(self.begin + word)]).tobytes()
        return array(self.code, self.tokenizer.encode(self.lead + piece, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            core = piece.rstrip(MARKS)
            if len(core) < len(piece) and core[-1:].isalpha() and core[-1] <= "\xff":  # marks after a letter stand alone
                ids = self[core] + self._tail(piece[len(core) :])
                if len(piece) > SHORT:
                    return ids
            else:
                ids = self._encoded(piece)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class PieceEncoder:
    """Ids as little-endian bytes of ``dtype``; ``spaced``: the tokenizer keeps white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.spaced = self._ids("a b") != self._ids("a  b")
        lowers = self._ids("\xc9A") == self._ids("\xe9a")
        self.first = Pieces(self.tokenizer, self.code, "", lowers)
        self.after_space = Pieces(self.tokenizer, self.code, " ", lowers) if self.spaced else self.first

    def _ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_text(self, text: str | None) -> bytes:
        if not text:
            return b""
        if text.isascii():
            if "<|" in text or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
                return self._ids(text)
        elif UNUSUAL.search(text):
            return self._ids(text)
        if not self.spaced:
            return b"".join(map(self.first.__getitem__, text.split()))
        if text[-1] == " " or any(pair in text for pair in AFTER_SPACE):
            return b"".join(map(self.first.__getitem__, RUNS.findall(text)))
        words = text.split(" ")
        head = self.first[words[0]] if words[0] else b""
        del words[0]
        return head + b"".join(map(self.after_space.__getitem__, words))

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        return [self.encode_text(t) for t in texts]


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One per Python worker and file."""
    return PieceEncoder(path)


def slices(texts: Sequence[str | None], most: int = 2_000_000):
    """Row ranges of about ``most`` characters, so that what a task holds stays small."""
    begin, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= most:
            yield slice(begin, i + 1)
            begin, total = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))
