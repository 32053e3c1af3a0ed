"""Sets of word shingles as sorted arrays of 64-bit hashes, computed for a batch of texts at once."""

from __future__ import annotations

import numpy as np

WORDS = 5
WIDE = 256  # sets from this size on have twice as many parity places
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.default_rng(20240917)
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of the text it stands in."""
    coded = [t.encode() for t in texts]
    data = LOWER[np.frombuffer(b" ".join([*coded, b""]), dtype=np.uint8)]
    if not len(data):
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    blank = BLANK[data]
    start = ~blank
    start[1:] &= blank[:-1]
    at = np.flatnonzero(start)
    if not len(at):
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    sizes = np.diff(at, append=len(data))
    inner = np.arange(at[0], len(data), dtype=np.int64) - np.repeat(at, sizes)
    with np.errstate(over="ignore"):
        powers = np.full(int(inner.max()) + 1, BASE, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        values = BYTE[data[at[0] :]] * powers[inner]
        values[blank[at[0] :]] = 0
        hashes = mix(np.add.reduceat(values, at - at[0]))
    ends = np.cumsum([len(c) + 1 for c in coded])
    return hashes, np.searchsorted(ends, at, side="right")


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted; a text of fewer words has one of all of them, without words none."""
    hashes, of = word_hashes(texts)
    n = np.bincount(of, minlength=len(texts))
    firsts = np.concatenate([[0], np.cumsum(n)])
    out = []
    with np.errstate(over="ignore"):
        if len(hashes) >= WORDS:
            rows = len(hashes) - WORDS + 1
            all_shingles = np.zeros(rows, dtype=np.uint64)
            for k in range(WORDS):
                all_shingles += hashes[k : k + rows] * PLACE[k]
            all_shingles = mix(all_shingles)
        for i in range(len(texts)):
            a, b = firsts[i], firsts[i + 1]
            if b - a >= WORDS:
                out.append(np.unique(all_shingles[a : b - WORDS + 1]))
            elif b > a:
                whole = (hashes[a:b] * PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                out.append(mix(mix(np.array([whole], dtype=np.uint64))))
            else:
                out.append(np.empty(0, dtype=np.uint64))
    return out


def parity_bits(shingles: np.ndarray) -> bytes:
    """Bit k tells whether an odd number of shingles falls on k: two sets differ in no fewer shingles than bits."""
    size = 64
    while size < len(shingles):
        size *= 2
    flags = (np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)
    return np.packbits(flags, bitorder="little").tobytes()


def parity_longs(shingles: np.ndarray) -> tuple[list[int], list[int] | None]:
    """Parity over 512 places as eight longs; for larger sets also the upper half of the parity over 1024 places."""

    def longs(size: int) -> np.ndarray:
        odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)

    return longs(512).tolist(), longs(1024)[8:].tolist() if len(shingles) >= WIDE else None


def bits_apart(a: bytes, b: bytes) -> int:
    """Least number of shingles by which two sets differ; the longer bits are folded to the shorter."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    if len(x) > len(y):
        x, y = y, x
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())
