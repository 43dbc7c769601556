"""Word shingles as 64-bit hashes, computed with numpy over a whole text."""

from __future__ import annotations

import hashlib

import numpy as np

#: Words longer than this are replaced by their digest, so that no table grows with one giant word.
LONG_WORD = 1 << 16
#: Words hashed at once; neighbouring pieces overlap by n - 1 words.
PIECE = 100_000

_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: A random number for each byte, for each place in a word, and for each place of a word in a shingle.
_BYTE, _PLACE, _ORDER = (np.random.default_rng(20 + k).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                         for k, n in enumerate((256, LONG_WORD + 1, 64)))


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def words(text: str | None) -> list[bytes]:
    """Maximal runs outside space and 0x09-0x0D, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(items: list[bytes]) -> np.ndarray:
    """A hash of each word: the sum of a mixed number for every byte at its place, which no algebra of places ties together."""
    joined = b" ".join(items)
    if len(joined) > LONG_WORD:
        items = [w if len(w) <= LONG_WORD else hashlib.blake2b(w).hexdigest().encode() for w in items]
        joined = b" ".join(items)
    codes = np.frombuffer(joined, np.uint8)
    starts = np.concatenate(([0], np.flatnonzero(codes == 32) + 1))
    sizes = np.diff(np.append(starts, len(codes) + 1)) - 1
    places = np.arange(len(codes)) - np.repeat(starts, sizes + 1)[:len(codes)]
    values = (_BYTE[codes] ^ _PLACE[places]) * _PRIME
    values ^= values >> np.uint64(29)
    values *= _BYTE[codes]
    values ^= values >> np.uint64(32)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix(sums[starts + sizes] - sums[starts] + sizes.astype(np.uint64) * _PRIME)


def hashes(items: list[bytes], n: int = 5) -> np.ndarray:
    """Hash of each run of ``n`` words, in text order; fewer words give the one hash of the whole sequence."""
    if not items:
        return np.empty(0, np.uint64)
    n = min(n, len(items))
    if len(items) > PIECE + n:
        return np.concatenate([hashes(items[i:i + PIECE + n - 1], n) for i in range(0, len(items) - n + 1, PIECE)])
    each = word_hashes(items)
    found = np.full(len(each) - n + 1, n, np.uint64)
    for k in range(n):
        found += mix(each[k:len(each) - n + 1 + k] ^ _ORDER[k % len(_ORDER)])
        found *= _PRIME
    return mix(found)


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(hashes(words(text), n))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
