"""Array kernels of the suffix dedup: anchors, multikey sort, common prefixes."""

from __future__ import annotations

import numpy as np

GRAM = 32  # bytes of an anchor's gram
SEGMENT = 1 << 18  # window starts handled at once: the arrays stay in the processor's cache
_POSITION_BITS = 24
_MASK = np.uint64((1 << _POSITION_BITS) - 1)


def _mix(h: np.ndarray, odd: int) -> np.ndarray:
    h = h * np.uint64(odd)
    return h ^ (h >> np.uint64(31))


_BYTE_HASH = _mix(_mix(np.arange(1, 257, dtype=np.uint64), 0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``GRAM``-byte string, by joining halves."""
    h = _BYTE_HASH[data]
    step = 1
    while step < GRAM:
        h = _mix(h[:-step] * np.uint64(0xBF58476D1CE4E5B9) + h[step:], 0x94D049BB133111EB)
        step *= 2
    return h


def anchors(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Anchors of all ``width``-byte windows inside the texts that end at ``ends``.

    A window's anchor is its gram of least hash (leftmost of equals), which
    depends on the window's bytes alone.  Returns the gram's hash, its
    position, and how far left of it the first and the last window start.
    """
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(0, len(data) - width + 1), SEGMENT):
        part = data[at : at + SEGMENT + width - 1]
        h = gram_hashes(part)
        low = (_mix(h, 0xD6E8FEB86659FD93) & ~_MASK) | np.arange(len(h), dtype=np.uint64)
        span, need = 1, width - GRAM + 1
        while span * 2 <= need:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if need > span:
            low = np.minimum(low[: len(low) - (need - span)], low[need - span :])
        where = (low & _MASK).astype(np.int64)
        starts = np.arange(len(where))
        text = np.searchsorted(ends, starts + at, "right")
        ok = starts + at + width <= ends[text]
        starts, where, text = starts[ok], where[ok], text[ok]
        if not len(starts):
            continue
        new = np.flatnonzero((np.diff(where) != 0) | (np.diff(text) != 0)) + 1
        first, last = np.concatenate([[0], new]), np.concatenate([new, [len(where)]]) - 1
        p = where[first]
        found.append((h[p], p + at, p - starts[first], p - starts[last]))
    if not found:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def rows_of(strings: list[bytes], width: int) -> np.ndarray:
    """Byte matrix of strings of at most ``width`` bytes, zero-padded."""
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of byte rows: sort by eight bytes, then only what is still tied by the next eight."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    head = np.ones(n, bool)  # of each group of rows equal so far
    head[1:] = words[order[1:], 0] != words[order[:-1], 0]
    for c in range(1, words.shape[1]):
        tied = ~head
        tied[:-1] |= ~head[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(head)[at]
        order[at] = order[at][np.lexsort((words[order[at], c], group))]
        word = words[order[at], c]
        head[at[1:]] |= (np.diff(at) == 1) & (np.diff(group) == 0) & (word[1:] != word[:-1])
    return order


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows."""
    if not a.shape[1]:
        return np.zeros(len(a), np.int64)
    differs = a != b
    return np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])


class Prefixes:
    """Sorted rows with common prefixes: the class of each row by its first ``depth`` bytes."""

    def __init__(self, rows: np.ndarray):
        self.order = multikey_order(rows) if rows.shape[1] else np.arange(len(rows))
        self.shared = common_prefix(rows[self.order[1:]], rows[self.order[:-1]])

    def classes(self, depth: int) -> np.ndarray:
        out = np.zeros(len(self.order), np.int64)
        out[self.order[1:]] = np.cumsum(self.shared < depth)
        return out
