"""Vectorised word and shingle hashes over batches of texts (numpy, inside tasks).

A word is a maximal run of bytes outside space and TAB..CR after ASCII lower-casing, which is
what ``bytes.lower().split()`` gives.  A word's 64-bit hash is a polynomial over random byte
values; a shingle's hash chains the hashes of its words.  Nothing depends on the process, so
every task and every rerun gets the same numbers.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHAIN = np.uint64(0xD6E8FEB86659FD93)
#: Bytes hashed at once; a batch is cut at white space, so memory does not follow the text.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (finaliser with two multiplications)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = _powers(256)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte position of every word of ``data`` (lower-cased here)."""
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        h, s = _piece(np.frombuffer(data[at:end].lower(), dtype=np.uint8))
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def _piece(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = (a != 32) & ((a < 9) | (a > 13))
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        return np.empty(0, np.uint64), first.astype(np.int64)
    size = last - first
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(int(size.sum())) - np.repeat(begin, size)
    powers = _POWERS if size.max() <= len(_POWERS) else _powers(int(size.max()))
    total = np.add.reduceat(_BYTE[a[inside]] * powers[place], begin)
    return mix(total + size.astype(np.uint64) * _CHAIN), first.astype(np.int64)


def chain(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words (``len(words) - k + 1`` of them)."""
    n = len(words) - k + 1
    out = words[:n].copy()
    for i in range(1, k):
        out = out * _CHAIN + words[i : n + i]
    return mix(out + np.uint64(k))


def batch_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all ``texts`` in one array, and where each text's words begin (one more entry at the end)."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    hashes, starts = word_hashes(b"\n".join(raw))
    offsets = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
    return hashes, np.searchsorted(starts, offsets)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes: runs of ``k`` words, or the whole sequence if it is shorter; empty without words."""
    if not len(words):
        return words
    return np.unique(chain(words, min(k, len(words))))


def shingle_sets(texts: list[str | None], k: int, at_once: int = 4 << 20):
    """``shingle_set`` of each text, hashing several texts together."""
    group: list[str | None] = []
    held = 0
    for t in texts:
        group.append(t)
        held += len(t or "")
        if held >= at_once:
            yield from _sets(group, k)
            group, held = [], 0
    yield from _sets(group, k)


def _sets(texts: list[str | None], k: int):
    if texts:
        words, cut = batch_words(texts)
        for i in range(len(texts)):
            yield shingle_set(words[cut[i] : cut[i + 1]], k)
