"""Words as decontamination and near-duplicate search read them: runs of lower-cased ASCII letters,
digits and all characters beyond ASCII.

Works on UTF-8 bytes, where every byte of a character beyond ASCII is a word byte."""

from __future__ import annotations

from functools import cache

import numpy as np

_WORD = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _WORD else 32 for c in range(256))
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes that are hashed together; a longer word is hashed with tables of its own length.
SEGMENT = 1 << 18


def fold(data: bytes) -> bytes:
    """The same number of bytes: letters lower-cased, a space for each byte outside words."""
    return data.translate(_FOLD)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    ones = np.ones(size, np.uint64)
    up, down = ones.copy(), ones.copy()
    up[1:], down[1:] = _BASE, _INVERSE
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _edges(folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(folded) + 2, np.int8)
    inside[1:-1] = folded != 32
    turns = np.diff(inside)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where words start and end."""
    return _edges(np.frombuffer(fold(data), np.uint8))


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and the number of words of each text."""
    joined = fold(b" ".join(texts))
    data, hashes, starts_at = np.frombuffer(joined, np.uint8), [], []
    at = 0
    while at < len(data):
        end = at + SEGMENT
        if end < len(data):
            space = joined.find(b" ", end)
            end = len(data) if space < 0 else space
        part = data[at:end]
        size = SEGMENT * 2 if len(part) <= SEGMENT * 2 else len(part)
        up, down = _powers(size) if size == SEGMENT * 2 else _powers.__wrapped__(size)
        starts, ends = _edges(part)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(up[: len(part)] * (part.astype(np.uint64) + np.uint64(1)), out=total[1:])
        found = (total[ends] - total[starts]) * down[starts]
        hashes.append(mix(found ^ (ends - starts).astype(np.uint64) << np.uint64(57)))
        starts_at.append(starts + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    starts = np.concatenate(starts_at)
    ends_of_texts = np.cumsum([len(one) + 1 for one in texts])
    counts = np.diff(np.searchsorted(starts, ends_of_texts, "left"), prepend=0)
    return np.concatenate(hashes), counts
