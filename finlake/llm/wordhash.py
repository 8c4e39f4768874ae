"""Hashes of a text's words, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(1 << 16, 0x100000001B3, np.uint64))   # wraps modulo 2**64
_BYTE = np.arange(1, 257, dtype=np.uint64)
PIECE = 1 << 22           # bytes hashed at a time; a word across the border is carried over
GROUP = 1 << 17           # bytes of short texts hashed together
SMALL = 1 << 22           # cells of an alignment up to which whole columns cost less than the band's vector steps


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_piece(data: np.ndarray, borders: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` and the bytes where they begin; no word goes on across the ``borders``."""
    letter = ~_IS_SPACE[data]
    first = np.empty(len(data), bool)
    first[:1], first[1:] = True, ~letter[:-1]
    if borders is not None:
        first[borders[borders < len(data)]] = True
    starts = np.flatnonzero(letter & first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    word = np.flatnonzero(letter)
    begin = np.searchsorted(word, starts)
    at = np.arange(len(word)) - np.repeat(begin, np.diff(begin, append=len(word)))
    return mix(np.add.reduceat(_BYTE[data[word]] * _POWERS[at & 0xFFFF], begin) + _BASE), starts


def _hash_long(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, places, at = [], [], 0
    while len(data) - at > PIECE:
        spaces = np.flatnonzero(_IS_SPACE[data[at:at + PIECE]])
        if not len(spaces):
            break                      # one word longer than a piece
        words, starts = _hash_piece(data[at:at + int(spaces[-1])])
        out.append(words)
        places.append(starts + at)
        at += int(spaces[-1])
    words, starts = _hash_piece(data[at:])
    return np.concatenate([*out, words]), np.concatenate([*places, starts + at])


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word, in order; words are runs of characters that are no white space."""
    return _hash_long(np.frombuffer(text.encode(), np.uint8))[0]


class Hashed(NamedTuple):
    """The words of texts ``start`` to ``stop``: those of the i-th are ``words[first[i]:first[i + 1]]``."""

    start: int
    stop: int
    words: np.ndarray
    first: np.ndarray
    data: bytes               # the texts one after another
    places: np.ndarray        # byte of ``data`` where each word begins, and where it ends

    def lengths(self) -> np.ndarray:
        return np.diff(self.first)


def hashed(texts: Sequence[str | bytes]) -> Iterator[Hashed]:
    """Word hashes of many texts, as ``word_hashes`` makes them, some ``GROUP`` bytes at a time."""
    encoded = [t.encode() if isinstance(t, str) else t for t in texts]
    ends = np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))
    start, done = 0, 0
    while start < len(encoded):
        stop = max(int(np.searchsorted(ends, done + GROUP, "right")), start + 1)
        data = b"".join(encoded[start:stop])
        borders = np.concatenate(([0], ends[start:stop] - done))
        view = np.frombuffer(data, np.uint8)
        words, places = _hash_long(view) if stop == start + 1 else _hash_piece(view, borders)
        yield Hashed(start, stop, words, np.searchsorted(places, borders), data, np.append(places, len(data)))
        start, done = stop, int(ends[stop - 1])


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """A hash per run of ``k`` words; one for the whole of a shorter text, none for an empty one."""
    k = min(k, len(words))
    if not k:
        return words
    n = len(words) - k + 1
    total = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        total = mix(total + words[i:i + n])
    return total


def _edits_by_diagonals(a: list[int], b: list[int], limit: int) -> int | None:
    """Edit distance if at most ``limit``, else None, by the furthest row that ``d`` edits reach on each diagonal."""
    n, m = len(a), len(b)
    a, b = [*a, -1], [*b, -2]               # ends that equal nothing
    low, mid, target = -2 * limit - 4, limit + 1, limit + 1 + m - n
    rows = [low] * (2 * limit + 3)
    for d in range(limit + 1):
        new = [low] * (2 * limit + 3)
        for k in range(max(mid - d, target - limit + d), min(mid + d, target + limit - d) + 1):
            i = max(rows[k] + 1, rows[k + 1] + 1, rows[k - 1]) if d else 0
            i = min(i, n, m - k + mid)
            j = i + k - mid
            if i < 0 or j < 0:
                continue
            while a[i] == b[j]:
                i += 1
                j += 1
            new[k] = i
        if new[target] >= n:
            return d
        rows = new
    return None


def _edits_by_columns(a: list[int], b: list[int], limit: int) -> int | None:
    """Edit distance if at most ``limit``, else None, by columns of the full table kept as bits of whole numbers (Myers)."""
    at: dict[int, int] = {}
    bit = 1
    for w in a:
        at[w] = at.get(w, 0) | bit
        bit <<= 1
    full, top = bit - 1, bit >> 1
    edits, up, down, ahead = len(a), full, 0, len(b)
    for w in b:
        equal = at.get(w, 0)
        ahead -= 1
        down_or = equal | down
        across = (((equal & up) + up) ^ up) | equal
        more, less = (down | ~(across | up)) & full, up & across
        if more & top:
            edits += 1
        elif less & top:
            edits -= 1
        if edits - ahead > limit:           # each column to come takes one edit away at most
            return None
        more, less = (more << 1) | 1, less << 1
        up, down = (less | ~(down_or | more)) & full, more & down_or
    return edits if edits <= limit else None


def _edits_of_short(a: np.ndarray, b: np.ndarray, limit: int, least: int) -> int | None:
    """As ``edits_within`` for texts of which at least ``least`` edits are known: few edits by diagonals, more by columns."""
    a, b = a.tolist(), b.tolist()
    few = min(limit, int((3 * len(a)) ** 0.5))
    if least <= few:
        edits = _edits_by_diagonals(a, b, few)
        if edits is not None or few == limit:
            return edits
    return _edits_by_columns(a, b, limit)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two texts have in common, each as often as in both."""
    every = np.concatenate((a, b))
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    edge = np.append(np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))), len(ranked))
    of_a = np.concatenate(([0], np.cumsum(order < len(a))))[edge]
    in_a, both = np.diff(of_a), np.diff(edge)
    return int(np.minimum(in_a, both - in_a).sum())


def edits_within(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Edit distance of two word sequences if it is at most ``limit``, else None.

    Short texts are aligned whole.  Longer ones by a band: only diagonals within ``limit`` of the main one are
    followed, each kept by the furthest row that ``d`` edits reach, so time is
    about ``limit`` vector steps and memory a band.
    """
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return None
    same = min(n, m)
    head = a[:same] == b[:same]
    start = int(np.argmin(head)) if not head.all() else same
    a, b = a[start:], b[start:]
    same = min(len(a), len(b))
    if same:
        tail = a[len(a) - same:][::-1] == b[len(b) - same:][::-1]
        end = int(np.argmin(tail)) if not tail.all() else same
        a, b = a[:len(a) - end], b[:len(b) - end]
    n, m = len(a), len(b)
    if not n or not m:
        return n + m if n + m <= limit else None
    # words that the other text lacks cost an edit each
    least = max(n, m) - _common(a, b)
    if least > limit:
        return None
    if n * m <= SMALL:
        return _edits_of_short(a, b, limit, least)

    step = 32
    a_pad = np.concatenate((a, np.zeros(step, np.uint64)))
    b_pad = np.concatenate((b, np.zeros(step, np.uint64)))
    ahead = np.arange(step)
    low = -2 * limit - 4
    rows = np.full(2 * limit + 3, low, np.int64)      # furthest row in a by diagonal (column in b minus row in a)
    mid = limit + 1
    target = mid + (m - n)
    for d in range(limit + 1):
        lo, hi = max(1, mid - d), min(2 * limit + 1, mid + d)
        diagonal = np.arange(lo - mid, hi - mid + 1)
        if d:
            reach = np.maximum(np.maximum(rows[lo:hi + 1] + 1, rows[lo + 1:hi + 2] + 1), rows[lo - 1:hi])
        else:
            reach = np.zeros(1, np.int64)
        reach = np.minimum(reach, np.minimum(n, m - diagonal))
        ok = (reach >= 0) & (reach + diagonal >= 0)
        going = np.flatnonzero(ok)
        while len(going):
            i, j = reach[going], reach[going] + diagonal[going]
            equal = a_pad[np.minimum(i, n)[:, None] + ahead] == b_pad[np.minimum(j, m)[:, None] + ahead]
            equal &= (i[:, None] + ahead < n) & (j[:, None] + ahead < m)
            run = np.where(equal.all(axis=1), step, np.argmin(equal, axis=1))
            reach[going] += run
            going = going[run == step]
        reach[~ok] = low
        rows[lo:hi + 1] = reach
        if lo <= target <= hi and rows[target] >= n:
            return d
    return None
