"""Words and word shingles of a batch of texts as 64-bit hashes, without a Python object per word.

The bytes of a word are taken eight at a time, each eight mixed into the hash so far, so that words of one
length that differ in one such eight cannot collide; words of more than 64 bytes are hashed by BLAKE2. A shingle
folds the hashes of its words in order. Sets are told apart by 128 bits (``set_print``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked off in pieces of about so many bytes; one text is never cut.
PIECE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: Bytes of a word that are worked off eight by eight; longer words are rare and go one by one.
LONG_WORD = 64
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as many as the longest piece so far needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, PIECE_BYTES)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


_powers = _Powers()


@dataclass
class Words:
    """Word hashes of a piece; those of text ``i`` lie from ``first[i]`` to ``first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def pieces(offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``size`` bytes."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def spans(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every run of true units; a run never crosses an offset in ``at``."""
    n = len(inside)
    before = np.zeros(n + 1, bool)
    before[1:] = inside
    before[at] = False
    begin = np.flatnonzero(inside & ~before[:n])
    follows = np.zeros(n + 1, bool)
    follows[:n] = inside
    follows[at] = False
    return begin, np.flatnonzero(inside & ~follows[1:]) + 1


def hash_spans(units: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the units of every span."""
    n = len(units)
    _powers.grow(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * _powers.up[:n], out=sums[1:])
    return mix((sums[end] - sums[begin]) * _powers.down[begin])


def hash_words(b: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of every span."""
    padded = np.concatenate([b, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(b) + 1,), "<u8", padded, 0, (1,))
    length = end - begin
    h = mix(length.astype(np.uint64) + np.uint64(_BASE))
    left = np.flatnonzero(length <= LONG_WORD)
    done = 0
    while len(left):
        chunk = eight[begin[left] + done] & _LOW_BYTES[np.minimum(length[left] - done, 8)]
        h[left] = mix(h[left] ^ (chunk * np.uint64(_BASE)))
        done += 8
        left = left[length[left] > done]
    for i in np.flatnonzero(length > LONG_WORD).tolist():
        h[i] = int.from_bytes(blake2b(b[begin[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """Words of texts that lie in ``data`` at ``offsets``; a word never crosses a text's end."""
    b = data[int(offsets[0]) : int(offsets[-1])]
    at = (offsets - offsets[0]).astype(np.int64)
    begin, end = spans(~_IS_SPACE[b], at)
    h = hash_words(_LOWER[b] if lower else b, begin, end)
    return Words(h, np.searchsorted(begin, at).astype(np.int64), begin, end)


def texts(column: pa.Array) -> list[str]:
    """Python strings of a column; null counts as empty, bytes that are no UTF-8 become U+FFFD."""
    raw = pc.fill_null(column.cast(pa.large_binary()), b"")
    return [x.as_py().decode("utf-8", "replace") for x in raw]


def fold(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, by its first word."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = mix(h[:n] + np.uint64(width))
    for k in range(1, width):
        out = mix(out + h[k : k + n] * np.uint64(2 * k + 1))
    return out


def shingle_sets(w: Words, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles; a shorter text is one shingle."""
    runs = fold(w.hashes, width)
    for a, z in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        n = z - a
        if n >= width:
            yield np.unique(runs[a : z - width + 1])
        elif n:
            yield fold(w.hashes[a:z], n)
        else:
            yield runs[:0]


def set_print(tokens: np.ndarray) -> bytes:
    """128 bits that tell sorted sets apart; empty for the empty set."""
    return blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else b""
