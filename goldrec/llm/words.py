"""Words and word shingles of many texts at once, as numpy operations on their UTF-8 bytes.

A word hash is a polynomial of its bytes modulo 2**64, taken from prefix sums and then mixed. A shingle hash
mixes the hashes of consecutive words and keeps 52 bits, so that the row number fits in front of it in one
64-bit integer, which sorts fast.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15
#: BASE times INVERSE is 1 modulo 2**64.
INVERSE = pow(BASE, -1, 1 << 64)
HASH_BITS = 52
MASK = U((1 << HASH_BITS) - 1)
STEPS = [U(pow(BASE, 3 * i + 7, 1 << 64)) for i in range(16)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words are runs of anything but white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of digits, lower-case letters and everything outside ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = True
ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 8 << 20:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def find_words(data: np.ndarray, off: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, hash) of each word of each row, after A-Z became a-z; positions are bytes in data."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, U)
    d = LOWER[data]
    inside = word_bytes[d]
    borders = off[1:-1]
    borders = borders[(borders > 0) & (borders < n)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[borders] = inside[borders]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[borders - 1] = inside[borders - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, U)
    terms = sums[1:]
    np.add(d, U(1), out=terms)
    terms *= powers(BASE, n)
    np.cumsum(terms, out=terms)
    hashes = mix((sums[end] - sums[start]) * powers(INVERSE, n)[start])
    row = np.searchsorted(off, start, "right") - 1
    return row, start, end, hashes


def shingles(row: np.ndarray, hashes: np.ndarray, rows: int, width: int = 5) -> np.ndarray:
    """Distinct shingles as sorted integers row << 52 | hash; fewer than width words are one shingle."""
    found = []
    if len(hashes) >= width:
        m = len(hashes) - width + 1
        whole = row[:m] == row[width - 1 :]
        h = np.zeros(m, U)
        for i in range(width):
            h += hashes[i : i + m] * STEPS[i]
        found.append((row[:m][whole].astype(U) << U(HASH_BITS)) | (mix(h[whole]) >> U(12)))
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    for k in range(1, width):
        short = np.flatnonzero(count == k)
        if len(short):
            h = np.full(len(short), k, U)
            for i in range(k):
                h += hashes[first[short] + i] * STEPS[i]
            found.append((short.astype(U) << U(HASH_BITS)) | (mix(h) >> U(12)))
    if not found:
        return np.zeros(0, U)
    packed = np.sort(np.concatenate(found))
    return packed[np.concatenate(([True], packed[1:] != packed[:-1]))]


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): the sorted distinct shingle hashes of row i are hashes[bounds[i]:bounds[i + 1]]."""
    row, _, _, h = find_words(data, off, NOT_SPACE)
    rows = len(off) - 1
    packed = shingles(row, h, rows, width)
    bounds = np.searchsorted(packed, np.arange(rows + 1, dtype=U) << U(HASH_BITS)) if rows < 1 << 12 else None
    if bounds is None:
        bounds = np.append(np.searchsorted(packed, np.arange(rows, dtype=U) << U(HASH_BITS)), len(packed))
    return bounds, packed & MASK
