"""Word shingles: plain sets, hashed sets of many texts at once, parity bitmaps, thresholds."""

from __future__ import annotations

import numpy as np

from tessera.llm.common import PrefixHash, mix64

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Least width in bits of a parity bitmap.
LEAST_BITS = 256


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def shingle_set(words: list[bytes], size: int) -> set[bytes]:
    """The full set of a document, the ground truth of the links."""
    if not words:
        return set()
    n = max(1, len(words) - size + 1)
    return {b" ".join(words[i:i + size]) for i in range(n)}


def linked(x: set, y: set, percent: int) -> bool:
    both = len(x & y)
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def least_overlap(n: int, m: int, percent: int) -> int:
    """Fewest common shingles that link sets of n and m."""
    return -(-percent * (n + m) // (100 + percent))


def hashed_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each document's distinct shingles, and where each set starts."""
    n_docs = len(offsets) - 1
    # documents are kept apart by one space after each
    lengths = np.diff(offsets)
    low = np.full(len(data) + n_docs, 32, np.uint8)
    starts = offsets[:-1] + np.arange(n_docs)
    place = np.arange(len(data)) + np.repeat(np.arange(n_docs), lengths)
    low[place] = _LOWER[data]
    space = np.concatenate(([True], _SPACE[low]))
    begin = np.flatnonzero(space[:-1] & ~space[1:])
    end = np.flatnonzero(~space[:-1] & space[1:])
    if len(begin) > len(end):
        end = np.append(end, len(low))
    ph = PrefixHash(low)
    word = mix64(ph.of(begin, end - begin) + (end - begin).astype(np.uint64))
    doc = np.searchsorted(starts, begin, "right") - 1
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    # a shingle's hash folds the words in order; short documents fold what they have
    n_words = np.diff(first)
    count = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    at = np.concatenate(([0], np.cumsum(count)))
    start = np.repeat(first[:-1], count) + np.arange(at[-1]) - np.repeat(at[:-1], count)
    last = np.repeat(first[1:], count)
    h = np.zeros(len(start), np.uint64)
    padded = np.concatenate((word, np.zeros(size, np.uint64)))
    for k in range(size):
        here = np.where(start + k < last, padded[start + k], np.uint64(k + 1))
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + here)
    parts = [np.unique(h[at[i]:at[i + 1]]) for i in range(n_docs)]
    sizes = np.fromiter(map(len, parts), np.int64, n_docs)
    return (np.concatenate(parts) if parts else h), np.concatenate(([0], np.cumsum(sizes)))


def parity_bitmaps(hashes: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Per set a bitmap: each hash flips one bit; about as many bits as the set has members."""
    sizes = np.diff(at)
    width = np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    base = np.concatenate(([0], np.cumsum(width)))
    own = np.repeat(np.arange(len(sizes)), sizes)
    bit = base[own] + (hashes & (width[own] - 1).astype(np.uint64)).astype(np.int64)
    flipped = (np.bincount(bit, minlength=int(base[-1])) & 1).astype(np.uint8)
    raw = np.packbits(flipped, bitorder="little").tobytes()
    return [raw[a:b] for a, b in zip((base[:-1] // 8).tolist(), (base[1:] // 8).tolist())]


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the members that only one of two sets has, from their bitmaps.

    Widths are powers of two and a member's bit is the low part of its hash, so the halves
    of a bitmap, one flipped by the other, are the bitmap of half the width.
    """
    while len(x) > len(y):
        half = len(x) // 2
        x = (int.from_bytes(x[:half], "little") ^ int.from_bytes(x[half:], "little")).to_bytes(half, "little")
    while len(y) > len(x):
        half = len(y) // 2
        y = (int.from_bytes(y[:half], "little") ^ int.from_bytes(y[half:], "little")).to_bytes(half, "little")
    return (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count()
