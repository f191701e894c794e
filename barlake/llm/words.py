"""Words and word shingles of whole texts as 64-bit hashes, for use inside
Arrow batches. A word is ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

_LOWER = bytes(32 if c in b"\t\n\v\f\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a text that are hashed at a time.
PIECE_BYTES = 1 << 18
#: Words up to this many bytes are hashed as polynomials, all at once.
SHORT_WORD = 64
_FACTOR = 0xD6E8FEB86659FD93


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The values of an Arrow string column as UTF-8 bytes, a few at a time."""
    column = column.cast(pa.binary())
    for k in range(0, len(column), 128):
        yield from column.slice(k, 128).to_pylist()


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """Consecutive parts of ``text``, cut only at white space."""
    at = 0
    while len(text) - at > size:
        cut = _SPACE.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class WordHashes:
    """64-bit hashes of the words of a text, in order. A word's hash is a
    polynomial of its bytes modulo 2^64, mixed with its length; prefix sums over
    a whole piece give all of them without a loop. Longer words, for which such
    polynomials are weak, take a cryptographic hash."""

    #: Applied to the bytes of a text first; maps all white space to a space.
    table = _LOWER

    def __init__(self) -> None:
        self.up, self.down = (np.full(PIECE_BYTES + 1, f, np.uint64) for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64)))
        for powers in (self.up, self.down):
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)

    def of(self, text: bytes | None) -> np.ndarray:
        parts = [self._piece(piece.translate(self.table)) for piece in pieces(text or b"")]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def _piece(self, piece: bytes) -> np.ndarray:
        if len(piece) > PIECE_BYTES:  # it holds a very long word
            return np.array([self.word(w) for w in piece.split(b" ") if w], np.uint64)
        codes = np.frombuffer(piece, np.uint8)
        solid = np.zeros(len(codes) + 2, np.int8)
        solid[1:-1] = codes != 32
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.up[:len(codes)], out=sums[1:])
        lengths = ends - starts
        out = mix((sums[ends] - sums[starts]) * self.down[starts] + lengths.astype(np.uint64))
        for k in np.flatnonzero(lengths > SHORT_WORD):
            out[k] = self.word(piece[starts[k]:ends[k]])
        return out

    def word(self, word: bytes) -> np.uint64:
        """The hash of one word, to which the table has been applied."""
        if len(word) > SHORT_WORD:
            return np.uint64(int.from_bytes(blake2b(word, digest_size=8).digest(), "little"))
        value = sum((c + 1) * pow(_FACTOR, k, 1 << 64) for k, c in enumerate(word)) + len(word)
        return mix(np.array([value % (1 << 64)], np.uint64))[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, in order; a shorter text is one
    shingle, a text without words has none."""
    if not len(words):
        return words
    n = min(n, len(words))
    last = len(words) - n + 1
    h = words[:last] + np.uint64(n)
    for k in range(1, n):  # words are random already: a polynomial of them, mixed once
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[k:k + last]
    return mix(h)


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as Spark longs."""
    return x.view(np.int64)
