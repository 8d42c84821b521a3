"""Cutting a text where no token crosses, so that tokens of recurring pieces are looked up.

Byte-level pre-tokenisation lets a single space join the word after it and lets
a single line break stand alone. Between such single breaks, with something
other than white space on both sides, every piece is tokenised alike wherever
it stands. Texts with any other white space are left in one piece.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: White space other than single spaces and line breaks inside the text.
ODD = re.compile(r"[^\S \n]|[ \n]{2}|\A[ \n]|[ \n]\Z")

#: Pieces of a generation: a worker remembers two, and forgets the older one when the newer is full.
#: Longer pieces are not remembered.
MOST_PIECES, LONGEST_PIECE = 1 << 16, 64


class PieceMemory(dict):
    """What ``make`` gives for each piece, remembered within bounds; pieces in use outlive the others."""

    def __init__(self, make: Callable, most: int = MOST_PIECES):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, piece):
        made = self.older.get(piece)
        if made is None:
            made = self.make(piece)
        if len(piece) <= LONGEST_PIECE:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[piece] = made
        return made


class PieceEncoder:
    """Encodings of a text's pieces in order; ``encode`` encodes any string."""

    def __init__(self, encode: Callable[[str], bytes], most: int = MOST_PIECES):
        self.encode = encode
        self.plain = PieceMemory(encode, most)
        self.spaced = PieceMemory(lambda word: encode(" " + word), most)

    def __call__(self, text: str) -> list[bytes]:
        if not text:
            return []
        if ODD.search(text):
            return [self.encode(text)]
        made: list[bytes] = []
        after_space, at_start = self.spaced.__getitem__, self.plain.__getitem__
        for k, line in enumerate(text.split("\n")):
            if k:
                made.append(at_start("\n"))
            first, *rest = line.split(" ")
            made.append(at_start(first))
            made.extend(map(after_space, rest))
        return made
