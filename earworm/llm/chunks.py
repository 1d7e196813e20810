"""Cutting a text where a tokenizer surely cuts, and a bounded cache by chunk.

A byte-level BPE pre-tokenizer, and a piece model whose pieces hold the space
mark only in front, never join the characters on the two sides of a single
space that has a non-space before and behind it.  The parts between such
spaces can therefore be encoded one by one; their results, joined, are those of
the whole text, and a part seen before need not be encoded again.
"""

from __future__ import annotations

import re

#: A space with a non-space on either side: a sure cut.
SURE_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Longer parts are encoded anew each time, so a full cache stays small.
CACHED_CHARS = 64

LETTERS, MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", ".,;:!?"
#: More sure cuts for pre-tokenizers that take letters, other marks and white
#: space apart: behind a run of letters that a mark or a line's end follows, and
#: on both sides of a single line feed between a letter or mark and a letter.
INNER_CUT = re.compile(
    f"(?<=[{LETTERS}])(?=[{MARKS}\n])|(?<=[{MARKS}])(?=\n[{LETTERS}])|(?<=[{LETTERS}{MARKS}]\n)(?=[{LETTERS}])")


class Unsure(Exception):
    """A part begins or ends with white space: the simple cut does not hold."""


class PartCache(dict):
    """``part -> encode(" " + part)`` of at most twice ``limit`` parts: when
    ``limit`` are held they become the old generation, in place of the last one,
    and those met again move to the new.  Parts of over ``CACHED_CHARS``
    characters are not kept.

    With ``join``, a part with inner cuts is put together from its pieces: the
    first is a part by itself, the others are kept as they stand (at most
    ``limit`` of them).  ``word``, if given, encodes a part of ASCII letters.
    """

    def __init__(self, encode, join=None, word=None, limit: int = 500_000):
        super().__init__()
        self.encode, self.join, self.word, self.limit, self.inner, self.old = encode, join, word, limit, {}, {}

    def __missing__(self, part: str):
        value = self.old.get(part)
        if value is None:
            if self.word and part.isalpha() and part.isascii():
                value = self.word(part)
            elif not part or part[0].isspace() or part[-1].isspace():
                raise Unsure
            else:
                value = self._composed(part) if self.join else self.encode(" " + part)
            if len(part) > CACHED_CHARS:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[part] = value
        return value

    def _composed(self, part: str):
        first, *rest = INNER_CUT.split(part)
        if not rest:
            return self.encode(" " + part)
        return self.join([self[first], *map(self._piece, rest)])

    def _piece(self, piece: str):
        value = self.inner.get(piece)
        if value is None:
            value = self.encode(piece)
            if len(piece) <= CACHED_CHARS:
                if len(self.inner) >= self.limit:
                    self.inner.clear()
                self.inner[piece] = value
        return value


def encode_parts(text: str, cache: PartCache) -> list:
    """The encodings of a text's parts, in order; joined, they are the text's.

    An empty text has no part.  A text with runs of white space is cut only at
    its sure places; the parts with the runs inside are encoded uncached.
    """
    if not text:
        return []
    head, *rest = text.split(" ")
    try:
        if not head or head[-1].isspace():
            raise Unsure
        return [cache.encode(head), *map(cache.__getitem__, rest)]
    except Unsure:
        head, *rest = SURE_CUT.split(text)
        return [cache.encode(head), *(cache.encode(" " + part) for part in rest)]
