"""Hashes of words and shingles, many texts at a time in numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.  Its hash is a polynomial in a random odd
base over random 64-bit values of its bytes, summed for all words at once (blanks count as nothing, and each word is
divided by the power of the base at its start), then mixed.  Nothing is kept between texts but tables of a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes that are hashed at once; only a word longer than this takes more.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_K = np.uint64(_BASE)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
_VALUE[_BLANK] = 0
_powers: list[np.ndarray] = []


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64(salt * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, from 0 up; one table of ``CHUNK`` of them stays."""
    if _powers and n <= CHUNK:
        return _powers[0], _powers[1]
    size = max(n, CHUNK)
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(size, base, dtype=np.uint64)
        p[0] = 1
        made.append(np.cumprod(p, dtype=np.uint64))
    if size == CHUNK:
        _powers[:] = made
    return made[0], made[1]


def _hashed(buf: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of a buffer; a word also starts anew at each of ``firsts``."""
    blank = _BLANK[buf]
    start = ~blank
    start[1:] &= blank[:-1]
    firsts = firsts[firsts < len(buf)]
    start[firsts] = ~blank[firsts]
    at = np.flatnonzero(start)
    if not len(at):
        return np.zeros(0, dtype=np.uint64), at
    up, down = _table(len(buf))
    return mix(np.add.reduceat(_VALUE[buf] * up[: len(buf)], at) * down[at], 1), at


def _long(text: bytes) -> np.ndarray:
    """Hashes of the words of one text of any length, a piece at a time; pieces end behind a blank."""
    buf, out, at = np.frombuffer(text, dtype=np.uint8), [], 0
    while at < len(buf):
        end = min(at + CHUNK, len(buf))
        while end < len(buf):
            blanks = np.flatnonzero(_BLANK[buf[max(at, end - CHUNK) : end]])
            if len(blanks):
                end = max(at, end - CHUNK) + int(blanks[-1]) + 1
                break
            end = min(end + CHUNK, len(buf))
        out.append(_hashed(buf[at:end], np.zeros(1, dtype=np.int64))[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def word_hashes(texts: Iterable[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of neighbouring texts: hashes of their words, and the edges between texts in it (texts + 1)."""
    held: list[bytes] = []
    size = 0

    def done() -> tuple[np.ndarray, np.ndarray]:
        if len(held) == 1 and len(held[0]) > CHUNK:
            h = _long(held[0])
            return h, np.array([0, len(h)])
        offsets = np.cumsum([0, *map(len, held)])
        h, at = _hashed(np.frombuffer(b"".join(held), dtype=np.uint8), offsets)
        return h, np.searchsorted(at, offsets)

    for text in texts:
        text = text or b""
        if held and size + len(text) > CHUNK:
            yield done()
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield done()


def of_each(texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
    """Hashes of the words of each text."""
    for h, edges in word_hashes(texts):
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield h[a:b]


def runs(h: np.ndarray, k: int, salt: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words of an array of word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    s = h[:n].copy()
    for i in range(1, k):
        s *= _K
        s += h[i : n + i]
    return mix(s, salt)


def shingle_sets(texts: Iterable[bytes | None], words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; with fewer words the whole sequence is one."""
    for h, edges in word_hashes(texts):
        full = runs(h, words, words)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a >= words:
                s = np.sort(full[a : b - words + 1])
                new = np.empty(len(s), dtype=bool)
                new[0] = True
                np.not_equal(s[1:], s[:-1], out=new[1:])
                yield s[new]
            else:
                yield runs(h[a:b], b - a, b - a) if b > a else h[:0]
