"""Suffix order and common prefixes of one shard by induced sorting with disk-backed queues."""

from __future__ import annotations

import tempfile
from collections import deque
from collections.abc import Iterator
from typing import IO

import numpy as np

_SYMBOLS = 257
#: Entries of a queue that are dealt at once: small chunks that wait one after another go together.
_BLOCK = 1 << 17


class _Queue:
    """First in, first out: chunks of (position, common prefix with the one before), on disk beyond a budget."""

    def __init__(self, file: IO[bytes], budget: list[int]):
        self._file, self._budget = file, budget
        self._chunks: deque[tuple[np.ndarray, np.ndarray] | tuple[int, int]] = deque()

    def push(self, at: np.ndarray, lcp: np.ndarray) -> None:
        if self._budget[0] >= len(at):
            self._budget[0] -= len(at)
            self._chunks.append((at, lcp))
        else:
            where = self._file.seek(0, 2)
            self._file.write(at.astype("<i8").tobytes() + lcp.astype("<i8").tobytes())
            self._chunks.append((where, len(at)))

    def pop(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All entries in order, in blocks of up to ``_BLOCK`` or one chunk; pushes meanwhile are taken too."""
        while self._chunks:
            size, taken = 0, []
            while self._chunks and (not taken or size + self._size(self._chunks[0]) <= _BLOCK):
                size += self._size(self._chunks[0])
                taken.append(self._load(self._chunks.popleft()))
            yield taken[0] if len(taken) == 1 else tuple(np.concatenate(x) for x in zip(*taken))

    @staticmethod
    def _size(chunk) -> int:
        return len(chunk[0]) if isinstance(chunk[0], np.ndarray) else chunk[1]

    def _load(self, chunk) -> tuple[np.ndarray, np.ndarray]:
        a, b = chunk
        if isinstance(a, np.ndarray):
            self._budget[0] += len(a)
            return a, b
        self._file.seek(a)
        both = np.frombuffer(self._file.read(16 * b), "<i8")
        return both[:b].copy(), both[b:].copy()


def _dense(key: np.ndarray) -> np.ndarray:
    """Dense ranks of numbers, from 1."""
    return np.unique(key, return_inverse=True)[1].astype(np.int64) + 1


def _rank(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Dense ranks, from 1, of pairs of numbers so small that both fit one."""
    return _dense(major * (int(minor.max(initial=0)) + 1) + minor)


def _star_order(t, is_s, star, cap):
    """Order of the suffixes at ``star`` and their common prefixes, from names of the substrings between them.

    Each substring of typed symbols up to the next star is named by its rank, which makes a string
    of names a few times shorter; that is sorted by doubling until names are unique or span ``cap``.
    """
    m, n = len(star), len(t)
    typed = np.append(2 * t.astype(np.int64) + is_s + 2, np.zeros(8, np.int64))
    length = np.minimum(np.append(star[1:] + 1, n) - star, cap)
    tail = np.zeros(m, np.int64)
    for chunk in range(int(-(-length.max() // 6)) - 1, -1, -1):
        rows = np.flatnonzero(length > 6 * chunk)
        key = np.zeros(len(rows), np.int64)
        for k in range(6):
            inside = 6 * chunk + k < length[rows]
            key = (key << 10) | np.where(inside, typed[np.minimum(star[rows] + 6 * chunk + k, n + 7)], 0)
        tail[rows] = _rank(_dense(key), tail[rows])
    levels, step = [tail], 1
    while step < cap and levels[-1].max() < m:
        now = levels[-1]
        later = np.append(now[step:], np.zeros(min(step, m), np.int64))[:m]
        levels.append(_rank(now, later))
        step *= 2
    order = np.argsort(levels[-1], kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    a0, b0 = star[a], star[b]
    for k in range(len(levels) - 1, -1, -1):
        names = np.append(levels[k], 0)
        same = (a < m) & (b < m)
        same[same] = names[a[same]] == names[b[same]]
        jump = np.where(same, 1 << k, 0)
        a, b = np.minimum(a + jump, m), np.minimum(b + jump, m)
    places = np.append(star, n)
    lcp = np.minimum(places[a] - a0, cap)
    t_end = np.append(t, -1).astype(np.int64)
    live = np.flatnonzero(lcp < cap)
    while len(live):
        x, y = a0[live] + lcp[live], b0[live] + lcp[live]
        more = (x < n) & (y < n)
        more[more] = t_end[x[more]] == t_end[y[more]]
        live = live[more]
        lcp[live] += 1
        live = live[lcp[live] < cap]
    return star[order], np.append(0, lcp)


class _Pushes:
    """Deals the predecessors of a bucket's suffixes to their symbols' queues, in order.

    Two suffixes that get the same symbol in front have a common prefix one longer than the least
    on the way between their sources; ``since`` carries that least from chunk to chunk.
    """

    def __init__(self, t, wanted, queues, cap):
        self.t, self.wanted, self.queues, self.cap = t, wanted, queues, cap

    def bucket(self) -> None:
        self.since = np.zeros(_SYMBOLS, np.int64)

    def deal(self, at: np.ndarray, lcp: np.ndarray) -> None:
        before = at - 1
        idx = np.flatnonzero(before >= 0)
        idx = idx[self.wanted[before[idx]]]
        lowest = np.append(np.minimum.accumulate(lcp[::-1])[::-1], self.cap)
        if not len(idx):
            np.minimum(self.since, lowest[0], out=self.since)
            return
        to = self.t[before[idx]]
        order = np.argsort(to, kind="stable")
        idx, to = idx[order], to[order].astype(np.int64)
        head = np.append(True, to[1:] != to[:-1])
        low = np.where(head, 0, np.append(0, idx[:-1] + 1))
        spans = np.stack([low, idx + 1], axis=1).reshape(-1)
        least = np.minimum.reduceat(np.append(lcp, self.cap), spans)[::2]
        heads = np.flatnonzero(head)
        least[heads] = np.minimum(least[heads], self.since[to[heads]])
        got, stops = to[heads], np.append(heads[1:], len(to))
        np.minimum(self.since, lowest[0], out=self.since)
        self.since[got] = lowest[idx[stops - 1] + 1]
        places, values = before[idx], np.minimum(least + 1, self.cap)
        for symbol, a, b in zip(got.tolist(), heads.tolist(), stops.tolist()):
            self.queues[symbol].push(places[a:b], values[a:b])


def suffix_order(t: np.ndarray, cap: int, memory: int = 1 << 26) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``t`` in order of their first ``cap`` symbols, and common prefixes up to ``cap``.

    ``t`` holds symbols 0 to 256. Suffixes smaller than their successor after a larger one (the
    stars) are sorted by name; an ascending scan then induces the suffixes larger than their
    successor, and a descending one the others. What is induced waits in one queue per symbol, as
    position and common prefix; queues beyond ``memory`` entries in all are on disk until their
    symbol is due. Entries arrive in order, so a queue per symbol is all the priority queue needed.
    The second result has 0 in front of every first symbol.
    """
    n = len(t)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    t = t.astype(np.int16)
    turn = np.append(t[:-1] != t[1:], True)
    stop = np.minimum.accumulate(np.where(turn, np.arange(n), n)[::-1])[::-1]
    following = np.append(t, -1)[stop + 1]
    is_s = t < following
    run = np.minimum(stop - np.arange(n) + 1, cap)
    star = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    stars, star_lcp = _star_order(t, is_s, star, cap) if len(star) else (star, np.zeros(0, np.int64))
    symbol_of = t[stars]
    star_cut = np.searchsorted(symbol_of, np.arange(_SYMBOLS + 1))

    def seam(above: int | None, first: int | None) -> int:
        return 0 if above is None or first is None else int(min(run[above], run[first]))

    with tempfile.TemporaryFile() as file:
        budget = [memory]
        queues = [_Queue(file, budget) for _ in range(_SYMBOLS)]
        kept = [_Queue(file, budget) for _ in range(_SYMBOLS)]
        push = _Pushes(t, ~is_s, queues, cap)
        push.bucket()
        queues[t[n - 1]].push(np.array([n - 1]), np.zeros(1, np.int64))
        last: list[int | None] = [None] * _SYMBOLS
        for c in range(_SYMBOLS):
            push.bucket()
            for at, lcp in queues[c].pop():
                if last[c] is None:
                    lcp[0] = 0
                last[c] = int(at[-1])
                kept[c].push(at, lcp)
                push.deal(at, lcp)
            a, b = star_cut[c], star_cut[c + 1]
            if a < b:
                lcp = star_lcp[a:b].copy()
                lcp[0] = seam(last[c], int(stars[a]))
                push.deal(stars[a:b], lcp)
        queues = [_Queue(file, budget) for _ in range(_SYMBOLS)]
        push = _Pushes(t, is_s, queues, cap)
        order: list[list[np.ndarray]] = [[] for _ in range(_SYMBOLS)]
        common: list[list[np.ndarray]] = [[] for _ in range(_SYMBOLS)]
        for c in range(_SYMBOLS - 1, -1, -1):
            push.bucket()
            low, down, gaps = None, [], []
            for at, lcp in queues[c].pop():
                if low is None:
                    lcp[0] = 0
                low = int(at[-1])
                down.append(at)
                gaps.append(lcp)
                push.deal(at, lcp)
            larger = list(kept[c].pop())
            up, ups = (np.concatenate(x) for x in zip(*larger)) if larger else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            between = seam(last[c], low)
            if len(up):
                push.deal(up[::-1], np.append(between, ups[:0:-1]))
            if down:
                at, lcp = np.concatenate(down), np.concatenate(gaps)
                # Descending: the prefix shared with the one before it there is shared with the one after it here.
                order[c] = [up, at[::-1]]
                common[c] = [ups, np.append(between, lcp[:0:-1])]
            else:
                order[c], common[c] = [up], [ups]
    return np.concatenate([x for part in order for x in part]), np.concatenate([x for part in common for x in part])
