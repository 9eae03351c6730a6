"""Word hashes of UTF-8 text, computed for whole blocks of documents with numpy.

A word is a run of bytes of one class. Its hash mixes two polynomials over its bytes, one
modulo 2**64 and one modulo a prime, each taken as a difference of prefix sums; what
collides in the first for any base (Thue-Morse strings) differs in the second. Results
that must be exact compare the words themselves (words_of()). All helpers run in tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes hashed at once; longer documents are hashed in pieces that end between words.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: The prime, and a primitive root's power as base.
_PRIME = (1 << 31) - 1
_PRIME_BASE = pow(7, 1_234_577, _PRIME)
#: Bytes whose products with powers below the prime add up to less than 2**64.
_EXACT = 1 << 22


def _lower() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = _lower()
#: Words between white space.
SPACED = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
#: Runs of digits, lower-cased letters and everything beyond ASCII.
ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n + 1, base, dtype=U)
        p[0] = 1
        out.append(np.cumprod(p, dtype=U))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least ``n`` bytes."""
    return _powers(max(BLOCK, 1 << (n - 1).bit_length()))


@lru_cache(maxsize=2)
def _prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_PRIME_BASE, pow(_PRIME_BASE, -1, _PRIME)):
        p = np.ones(1, dtype=U)
        while len(p) <= n:
            p = np.concatenate([p, p * U(pow(base, len(p), _PRIME)) % U(_PRIME)])
        out.append(p[: n + 1].astype(np.uint32))
    return out[0], out[1]


def _prime_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial modulo the prime of each run of bytes."""
    up, down = _prime_powers(max(BLOCK, 1 << len(data).bit_length()))
    c = np.zeros(len(data) + 1, dtype=U)
    for i in range(0, len(data), _EXACT):
        j = min(len(data), i + _EXACT)
        np.cumsum((data[i:j].astype(U) + U(1)) * up[i:j], out=c[i + 1 : j + 1])
        if j < len(data) or i:
            c[i + 1 : j + 1] %= U(_PRIME)
            c[i + 1 : j + 1] += c[i]
            c[j] %= U(_PRIME)
    return (c[ends] + U(4 * _PRIME) - c[starts]) % U(_PRIME) * down[starts] % U(_PRIME)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``c`` such that ``(c[j] - c[i]) * inverse**i`` is the polynomial of bytes i to j."""
    up, _ = powers(len(data) + 1)
    c = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=c[1:])
    return c


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def _words(data: np.ndarray, firsts: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words; no word runs over one of ``firsts``."""
    is_word = word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[firsts] = True
    edge[-1] = True
    before = np.empty_like(is_word)
    before[:1] = False
    before[1:] = is_word[:-1]
    starts = np.flatnonzero(is_word & (~before | edge[:-1]))
    after = np.empty_like(is_word)
    after[-1:] = False
    after[:-1] = is_word[1:]
    ends = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    lowered = LOWER[data]
    c = prefix_sums(lowered)
    _, down = powers(len(data) + 1)
    h = mix((c[ends] - c[starts]) * down[starts] + (ends - starts).astype(U))
    return starts, ends, mix(h + _prime_hashes(lowered, starts, ends) * U(_BASE))


def word_hashes(column: pa.Array, word: np.ndarray, block: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block of rows: first row, word bounds by row, hashes, byte starts and ends.

    Row ``first + k`` owns the words ``bounds[k]`` to ``bounds[k + 1]``; byte positions
    count from the start of the block. A row longer than a block is a block of its own
    and is hashed in pieces.
    """
    data, offsets = texts_of(column)
    for i, j in blocks(offsets, block):
        part = data[offsets[i] : offsets[j]]
        if len(part) <= 4 * block:
            if not len(part):
                yield i, np.zeros(j - i + 1, dtype=np.int64), np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
                continue
            local = offsets[i : j + 1] - offsets[i]
            starts, ends, h = _words(part, local[:-1][local[:-1] < len(part)], word)
            yield i, np.searchsorted(starts, local), h, starts, ends
        else:
            pieces, at = [], 0
            while at < len(part):
                to = min(len(part), at + 4 * block)
                while to < len(part) and word[part[to]]:  # to the next gap
                    gaps = np.flatnonzero(~word[part[to : to + BLOCK]])
                    to = to + int(gaps[0]) if len(gaps) else min(len(part), to + BLOCK)
                s, e, h = _words(part[at:to], np.zeros(1, dtype=np.int64), word)
                pieces.append((s + at, e + at, h))
                at = to
            starts, ends, h = (np.concatenate(x) for x in zip(*pieces, strict=True))
            yield i, np.array([0, len(h)]), h, starts, ends


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes, in order."""
    if len(h) < width:
        return np.zeros(0, dtype=U)
    up, _ = powers(width)
    out = np.zeros(len(h) - width + 1, dtype=U)
    for k in range(width):
        out += h[k : k + len(out)] * up[k + 1]
    return mix(out ^ U(width))


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


_ALNUM_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes, word: np.ndarray) -> list[bytes]:
    """The words of one text themselves, A-Z lower-cased; ``word`` is SPACED or ALNUM."""
    return text.lower().split() if word is SPACED else _ALNUM_WORD.findall(text.lower())
