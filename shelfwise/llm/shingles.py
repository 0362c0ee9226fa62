"""Hashes of words and word shingles, for many texts at once in numpy.

A word is a run of letters, digits and non-ASCII characters, A-Z as lower case.
Its hash is a polynomial in its bytes modulo 2**64, taken from running sums over
the whole buffer, so no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

SHINGLE_WORDS = 5
#: Bytes that are hashed at once; a longer word is hashed whole.
CHUNK = 1 << 20
#: Bits of a shingle's number.
SHINGLE_BITS = 48

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_BYTES = np.random.default_rng(5).integers(1, 2**63, 256, np.uint64)
_BYTES[32] = 0
_PLACES = np.random.default_rng(6).integers(1, 2**63, SHINGLE_WORDS, np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of the public splitmix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, n of them at least."""
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, base in enumerate((_BASE, inverse)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors)
    return _powers


def _chunks(texts: Sequence[bytes]):
    """Buffers of about CHUNK bytes that end between words, with the document borders in them."""
    parts: list[bytes] = []
    size, first = 0, 0
    for number, text in enumerate(texts):
        at = 0
        while len(text) - at > CHUNK:
            cut = text.rfind(b" ", at, at + CHUNK)
            if cut <= at:
                cut = text.find(b" ", at + CHUNK)
            if cut < 0:
                break
            parts.append(text[at:cut])
            yield first, parts
            parts, size, first = [], 0, number
            at = cut
        parts.append(text[at:] if at else text)
        size += len(parts[-1]) + 1
        if size >= CHUNK:
            yield first, parts
            parts, size, first = [], 0, number + 1
    if parts:
        yield first, parts


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the place of each text's first word (and the end)."""
    folded = [t.encode("utf-8", "surrogatepass").translate(_FOLD) if t else b"" for t in texts]
    found, counts = [np.empty(0, np.uint64)], np.zeros(len(folded), np.int64)
    for first, parts in _chunks(folded):
        raw = np.frombuffer(b" ".join(parts), np.uint8)
        edges = np.diff((raw != 32).view(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        powers, inverses = _power_tables(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * powers[: len(raw)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * inverses[starts]
        found.append(mix(hashes + (ends - starts).astype(np.uint64)))
        borders = np.cumsum([len(p) + 1 for p in parts])
        which = np.searchsorted(borders, starts, "right")
        counts[first : first + len(parts)] += np.bincount(which, minlength=len(parts))
    return np.concatenate(found), np.concatenate([[0], np.cumsum(counts)])


def content_keys(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's word sequence; 0 for texts without words."""
    place = (np.arange(len(words)) - np.repeat(offsets[:-1], np.diff(offsets))).astype(np.uint64)
    keys = []
    for salt in (0x1234567, 0x89ABCDE):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(words + mix(place + np.uint64(salt))))])
        keys.append((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))
    return keys[0], keys[1]


def shingles(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (text number, shingle, how often), sorted by the first two.

    Five consecutive words; a text of fewer words, but not none, is one shingle.
    """
    n, counts = len(words), np.diff(offsets)
    padded = np.concatenate([words, np.zeros(SHINGLE_WORDS, np.uint64)])
    sums = np.zeros(n, np.uint64)
    for k, factor in enumerate(_PLACES):
        inside = padded[k : k + n] * factor
        if k:  # words of the next text do not count in a text of fewer words
            short = np.repeat(np.where(counts < SHINGLE_WORDS, offsets[1:], n + SHINGLE_WORDS), counts)
            inside[np.arange(n) + k >= short] = 0
        sums += inside
    number = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(n) - offsets[:-1][number]
    keep = (place == 0) | (place <= counts[number] - SHINGLE_WORDS)
    number = number[keep]
    bits = np.uint64(64 - SHINGLE_BITS)
    value = mix(sums[keep] + np.minimum(counts[number], SHINGLE_WORDS).astype(np.uint64)) >> bits
    if len(counts) >= 1 << int(bits):
        raise ValueError("too many texts at once")
    both, times = np.unique((number.astype(np.uint64) << np.uint64(SHINGLE_BITS)) | value, return_counts=True)
    return (both >> np.uint64(SHINGLE_BITS)).astype(np.int64), both & np.uint64(2**SHINGLE_BITS - 1), times
