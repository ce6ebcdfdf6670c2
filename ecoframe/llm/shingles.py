"""Word shingles of many texts at once, with numpy.

Words are runs of characters other than blank and U+0009 to U+000D, lower-cased in
A-Z only.  They are hashed on the UTF-8 bytes of a whole chunk of texts (a polynomial
over random byte values, modulo 2**64, then mixed), so no Python object is made per word.
A text's shingle set is the different hashes of its runs of ``width`` words; with fewer
words the whole sequence is the one shingle; without words the set is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together, one text at least."""
    begin = 0
    while begin < len(texts):
        end, size = begin + 1, len(texts[begin])
        while end < len(texts) and size + len(texts[end]) <= limit:
            size += len(texts[end])
            end += 1
        yield begin, end
        begin = end


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 of a string column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of the texts in order, number of words of each text)."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = _BLANK[raw]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers(_P, len(raw)), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(_P_INVERSE, len(raw))[starts] + (ends - starts).astype(np.uint64))
    limits = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, limits), prepend=0)


def word_counts(texts: list[bytes]) -> np.ndarray:
    """Number of words of each text."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = _BLANK[raw]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    limits = np.cumsum([len(t) + 1 for t in texts])
    return np.diff(np.searchsorted(starts, limits), prepend=0) + np.array([len(t) > 0 and not _BLANK[t[0]] for t in texts[:1]] + [0] * (len(texts) - 1))


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(different shingle hashes, sorted within each text, text after text; size of each set)."""
    words, counts = word_hashes(texts)
    first = np.cumsum(counts) - counts
    reach = np.minimum(counts, width)  # words of a shingle of this text
    number = np.where(counts > 0, counts - reach + 1, 0)
    owner = np.repeat(np.arange(len(texts)), number)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number) + first[owner]
    h = np.zeros(len(at), np.uint64)
    for j in range(width):
        inside = j < reach[owner]
        next_word = words[np.where(inside, at + j, 0)] if len(words) else np.zeros(0, np.uint64)
        h = np.where(inside, mix(h * _P + next_word + np.uint64(j)), h)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.bincount(owner[new], minlength=len(texts))
