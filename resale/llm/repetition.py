"""Repetition coverage of whole texts: rolling hashes of several n-gram lengths, in numpy over Arrow batches.

Words are ``[^\x20\x09-\x0D]+``.  The bytes of a slice of texts are hashed at
once: one polynomial hash modulo two primes per word, a rolling combination of
them per n-gram, one sort per n-gram length that finds the windows of a text which
occur in it again.  Coverage is the share of a text's word characters that lie
in such windows (each character once), and the share of its characters in
lines equal to an earlier line.

Defined results: a null or empty text has no words, covers nothing and fails
the base rule; repeated rows give repeated rows; an empty table gives an empty
table; other columns are not read.  Very long texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from resale.llm.common import keyed, slices, splitmix

#: n-gram lengths and the largest share of word characters in repeated n-grams of that length.
LIMITS = {5: 0.25, 6: 0.25, 7: 0.25, 8: 0.25, 9: 0.25, 10: 0.25}
LINE_LIMIT = 0.30
SYMBOL_LIMIT = 0.10
MIN_WORDS, BASE_NGRAM, BASE_PERCENT = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
#: Bytes hashed at once.
SLICE = 1 << 19
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"

_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
#: Two primes below 2**31 and a base for each (fixed values): sums of products stay within 64 bits.
_PRIMES, _BASES = (2147483629, 2147483587), (1270938503, 998244353)


def _is(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SPACE, _SYMBOL = _is(SPACE), _is(SYMBOLS)


def _powers(base: int, prime: int, size: int) -> np.ndarray:
    """The first powers of a base modulo a prime."""
    out = np.ones(1, np.uint64)
    while len(out) < size:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[:size]


@lru_cache(maxsize=4)
def _usual(base: int, prime: int) -> np.ndarray:
    return _powers(base, prime, SLICE).astype(np.uint32)


def _first_powers(base: int, prime: int, size: int) -> np.ndarray:
    return _usual(base, prime)[:size] if size <= SLICE else _powers(base, prime, size)


class ByteHash:
    """Polynomial hashes of any ranges of one array, from its prefix sums, modulo two primes.

    A modulus of 2**64 would not do: there, regular texts (Thue-Morse words) of
    one length collide for every odd base.
    """

    def __init__(self, data: np.ndarray):
        shifted = data.astype(np.uint64) + np.uint64(1)
        self.size, self.sums = len(data), []
        for prime, base in zip(_PRIMES, _BASES):
            sums = np.zeros(len(data) + 1, np.uint64)
            # terms are reduced, so that 2**33 of them can be added up
            np.cumsum(shifted * _first_powers(base, prime, len(data)) % np.uint64(prime), out=sums[1:])
            self.sums.append(sums)

    def of(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of non-empty ranges."""
        out = (ends - begins).astype(np.uint64) * _STEP
        for k, (prime, base, sums) in enumerate(zip(_PRIMES, _BASES, self.sums)):
            p = np.uint64(prime)
            own = (sums[ends] - sums[begins]) % p * _first_powers(pow(base, -1, prime), prime, self.size)[begins] % p
            out += own << np.uint64(32 * k)
        return splitmix(out)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    k = np.sort(keys)
    twice = np.unique(k[1:][k[1:] == k[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    return twice[np.minimum(at, len(twice) - 1)] == keys


def _again(keys: np.ndarray) -> np.ndarray:
    """Which keys equal an earlier key."""
    out = np.zeros(len(keys), bool)
    some = np.flatnonzero(_repeated(keys))
    order = some[np.argsort(keys[some], kind="stable")]
    out[order[1:]] = keys[order][1:] == keys[order][:-1]
    return out


def word_ranges(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of all words, and the number of the first word of each text (one more at the end)."""
    padded = np.r_[True, _SPACE[data], True]
    cuts = bounds[1:-1]
    edge = padded[:-1] != padded[1:]
    # a text's end also ends its last word
    starts, stops = edge & padded[:-1], edge & padded[1:]
    glued = cuts[(cuts > 0) & (cuts < len(data))]
    glued = np.unique(glued[~padded[glued] & ~padded[glued + 1]])
    starts[glued] = True
    stops[glued] = True
    begins, ends = np.flatnonzero(starts), np.flatnonzero(stops)
    return begins, ends, np.searchsorted(begins, bounds)


def measure(data: np.ndarray, bounds: np.ndarray, lengths: tuple[int, ...] = tuple(LIMITS)) -> dict[str, np.ndarray]:
    """Counts per text; ``data`` holds the UTF-8 bytes of all texts, text i lies at ``bounds[i]:bounds[i + 1]``."""
    n = len(bounds) - 1
    begins, ends, first = word_ranges(data, bounds)
    lead = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    chars = lead[ends] - lead[begins]  # code points of each word
    doc = np.repeat(np.arange(n), np.diff(first))
    hashed = ByteHash(data)
    words = hashed.of(begins, ends)
    out = {"n_words": np.bincount(doc, minlength=n), "word_chars": np.bincount(doc, chars, n).astype(np.int64)}
    total = np.r_[0, np.cumsum(_SYMBOL[data])]
    out["n_symbols"] = total[bounds[1:]] - total[bounds[:-1]]
    salt = splitmix(np.arange(n, dtype=np.uint64))
    rolling, at = words, 1
    where = np.arange(len(words))  # only where both shorter windows repeat can a longer one repeat
    for size in sorted({BASE_NGRAM, *lengths}):
        while at < size:  # hash of the window of `at + 1` words, from the one of `at`
            rolling = rolling[:-1] * _STEP + words[at:] if len(rolling) else rolling
            at += 1
        where = where[where + size <= len(words)]
        where = where[doc[where] == doc[where + size - 1]]
        twice = where[_repeated(splitmix(rolling[where]) ^ salt[doc[where]])]
        covered = np.zeros(len(words) + 1, np.int64)
        covered[twice] += 1
        covered[twice + size] -= 1
        inside = np.cumsum(covered)[: len(words)] > 0
        out[f"chars_{size}"] = np.bincount(doc, chars * inside, n).astype(np.int64)
        if size == BASE_NGRAM:
            out["n_repeat_words"] = np.bincount(doc, inside, n).astype(np.int64)
        where = twice[:-1][twice[1:] == twice[:-1] + 1]
    # lines that hold a word
    feeds = np.flatnonzero(data == 10)
    line_at = np.unique(np.r_[bounds[:-1], feeds + 1])
    line_at = line_at[line_at < len(data)]
    line_end = np.r_[line_at[1:], len(data)].astype(np.int64)
    line_end = line_end - (data[line_end - 1] == 10) if len(line_at) else line_at
    full = line_end > line_at
    line_at, line_end = line_at[full], line_end[full]
    has_word = np.searchsorted(begins, line_end) > np.searchsorted(begins, line_at)
    line_at, line_end = line_at[has_word], line_end[has_word]
    line_doc = np.searchsorted(bounds, line_at, side="right") - 1
    again = _again(hashed.of(line_at, line_end) ^ salt[line_doc])
    out["n_dup_lines"] = np.bincount(line_doc, again, n).astype(np.int64)
    size = lead[line_end] - lead[line_at]
    out["line_chars"] = np.bincount(line_doc, size, n).astype(np.int64)
    out["dup_line_chars"] = np.bincount(line_doc, size * again, n).astype(np.int64)
    return out


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def verdicts(m: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Base rule, coverage of each length and of lines, and the verdict of all rules."""
    all_chars = np.maximum(m["word_chars"], 1)
    out = {"base_failed": (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * m["n_words"])}
    bad = out["base_failed"] | (m["n_symbols"] > SYMBOL_LIMIT * all_chars)
    for size, limit in LIMITS.items():
        out[f"cover_{size}"] = m[f"chars_{size}"] / all_chars
        bad |= out[f"cover_{size}"] > limit
    out["cover_lines"] = m["dup_line_chars"] / np.maximum(m["line_chars"], 1)
    bad |= out["cover_lines"] > LINE_LIMIT
    return {"kept": ~bad, **out}


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, coverage and verdict of every row."""
    covers = [f"cover_{n}" for n in LIMITS] + ["cover_lines"]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            text = b.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            raw = text.buffers()[2]
            data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
            m = measure(data, offsets - offsets[0])
            m |= verdicts(m)
            names = [*COUNTS, "base_failed", "kept", *covers]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(m[c]) for c in names)], ["doc_id", *names])

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), "base_failed boolean, kept boolean", *(f"{c} double" for c in covers)])
    return keyed(df, id_col, text_col).mapInArrow(step, schema)
