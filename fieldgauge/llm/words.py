"""Words of many texts at once, as arrays: where they lie, and a 64-bit hash of each.

A word is a run of bytes other than space and the five control blanks. A hash is a
polynomial over the bytes modulo 2**64, taken from prefix sums and then mixed, so a batch
of texts is hashed without a loop over words. Two words are taken as equal if their hashes
are: over a vocabulary of a billion words the expected number of collisions is below 0.1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on together; a longer text is taken alone.
CHUNK_BYTES = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))

SOLID = np.ones(256, bool)
SOLID[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_RAW = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _RAW.copy()
_LOWER[ord("A") : ord("Z") + 1] = _RAW[ord("a") : ord("z") + 1]
_powers = np.ones((2, 1), np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2**64."""
    global _powers
    if _powers.shape[1] <= n:
        grown = np.ones((2, n + 1 + n // 4), np.uint64)
        for row, factor in zip(grown, (_ODD, _ODD_INVERSE), strict=True):
            row[1:] = factor
            np.cumprod(row, out=row)
        _powers = grown
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Texts side by side. ``bounds[d]:bounds[d+1]`` are the words of text ``d``."""

    buf: np.ndarray  # the bytes of all texts
    offsets: np.ndarray  # text d is buf[offsets[d]:offsets[d+1]]
    start: np.ndarray  # of each word
    end: np.ndarray
    bounds: np.ndarray
    sums: np.ndarray  # prefix sums of the polynomial

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of each span of bytes."""
        _, back = powers(len(self.buf))
        raw = (self.sums[end] - self.sums[start]) * back[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def hashes(self) -> np.ndarray:
        return self.spans(self.start, self.end)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))

    def total(self, per_byte: np.ndarray) -> np.ndarray:
        """The sum of ``per_byte`` over each text."""
        sums = np.concatenate([[0], np.cumsum(per_byte, dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def split(texts: pa.Array, lower: bool = False, solid_bytes: np.ndarray = SOLID) -> Words:
    """The words of every text, runs of the bytes marked in ``solid_bytes``; a null text has none."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    buf, at = raw[at[0] : at[-1]], at - at[0]
    n = len(buf)
    solid = solid_bytes[buf]
    begin, stop = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    stop[:-1] &= ~solid[1:]
    full = at[1:] > at[:-1]
    first, last = at[:-1][full], at[1:][full] - 1
    begin[first], stop[last] = solid[first], solid[last]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    up, _ = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER if lower else _RAW)[buf] * up[:n], out=sums[1:])
    return Words(buf, at, start, end, np.searchsorted(start, at), sums)


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together, or of one text."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, to
        at = to


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each run of ``size`` words within a text, and the word where it starts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joined = np.zeros(n, np.uint64)
    for k in range(size):
        joined = mix(joined * _ODD + hashes[k : k + n] + np.uint64(k))
    inside = np.ones(n, bool)
    for edge in range(1, size):  # a run that begins less than size words before a text's end
        late = bounds[1:] - edge
        inside[late[(late >= 0) & (late < n)]] = False
    # the marks above may hit the text before, if this one is shorter; those runs leave it too
    at = np.flatnonzero(inside)
    return joined[at], at
