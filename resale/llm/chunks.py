"""Byte-level BPE of whole texts through bounded caches of chunks and pieces.

A byte-level BPE splits a text by a pattern before it merges.  The pattern
used here begins a new match at every blank that a non-blank follows, so a text
cut at those blanks encodes to the same ids chunk by chunk; a chunk that starts
with white space is joined to the one before it.  Corpora repeat their words,
so most chunks come from the cache, and of the others most pieces (matches of
the pattern) do; only new pieces reach the tokenizer.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import regex

#: Entries of a generation of a cache; two generations are kept.
MAX_ENTRIES = 75_000
LONG = 64
#: Marks that make one piece of their own after letters, however many they are (the apostrophe begins contractions).
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_BLANK_RUN = re.compile(r" (?:\s|$)")


def byte_table() -> list[str]:
    """Character of each byte: printable Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in shown else chr(spare))
        spare += b not in shown
    return out


class _Cache(dict):
    """Values made on demand; long keys are not kept.

    A full generation becomes the old one and a new one begins; what is used
    again comes back from the old one, so frequent keys stay.
    """

    def __init__(self, make: Callable[[str], bytes], entries: int):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONG and "\n" not in key:  # words of two lines seldom meet again
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.entries:
            self.old = dict(self)
            self.clear()


class ChunkEncoder:
    """Id bytes of texts, from a ``tokenizers`` BPE model over byte characters and a split pattern.

    ``newline_alone`` says that the pattern makes a newline between two
    non-blanks a piece of its own, and begins a new one after it.
    """

    def __init__(self, model, pattern: str, typecode: str, entries: int = MAX_ENTRIES, newline_alone: bool = False):
        self.tokenize, self.matches, self.typecode = model.tokenize, regex.compile(pattern).findall, typecode
        self.to_char = dict(enumerate(byte_table()))
        self.blank = self.to_char[32]
        self.pieces = _Cache(self._piece, entries)
        self.chunks = _Cache(self._chunk, entries)  # of chunks that follow a blank, keyed without it
        self.newline = self.pieces["\n"] if newline_alone else None

    def _ids(self, shown: str) -> bytes:
        return array(self.typecode, [t.id for t in self.tokenize(shown)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._ids(piece.encode("utf-8").decode("latin-1").translate(self.to_char))

    def _text(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.matches(text)))

    def _word(self, word: str) -> bytes:
        """A blank and letters are one piece; it is kept as a chunk only."""
        return self._ids(self.blank + (word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.to_char)))

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._word(chunk)
        if self.newline and "\n" in chunk:
            first, *lines = chunk.split("\n")
            if first and not first[-1].isspace() and all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                return self.newline.join([self.chunks[first], *map(self._bare, lines)])
        word = chunk.rstrip(MARKS)
        if word.isalpha():
            known = self.chunks.get(word)
            return (self._word(word) if known is None else known) + self.pieces[chunk[len(word) :]]
        return self._text(f" {chunk}")

    def _bare(self, line: str) -> bytes:
        """The beginning of a line."""
        if line.isalpha():
            return self.pieces[line]
        word = line.rstrip(MARKS)
        if word.isalpha():
            return self.pieces[word] + self.pieces[line[len(word) :]]
        return self._text(line)

    def encode(self, texts: list[str]) -> list[bytes]:
        out, find = [], self.chunks.__getitem__
        for text in texts:
            head, *rest = text.split(" ")
            if _BLANK_RUN.search(text):
                out.append(self._joined(head, rest))
            else:
                out.append(self._text(head) + b"".join(map(find, rest)))
            self.pieces.trim()
            self.chunks.trim()
        return out

    def _joined(self, head: str, rest: list[str]) -> bytes:
        """Ids of a text with runs of white space: chunks that begin with it belong to the one before."""
        merged = [[head]]
        for c in rest:
            if c and not c[0].isspace():
                merged.append([c])
            else:
                merged[-1].append(c)
        first, *more = merged
        return self._text(" ".join(first)) + b"".join([self.chunks[m[0]] if len(m) == 1 else self._text(f" {' '.join(m)}") for m in more])
