"""Suffix arrays by induced sorting, and permuted common prefixes."""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the one that begins a place later; the last one is."""
    n = len(s)
    differs = np.flatnonzero(s[:-1] != s[1:])
    smaller = s[differs] < s[differs + 1]
    # Equal symbols go the way of the next pair that differs; the last symbol is the least and occurs once.
    out = smaller[np.minimum(np.searchsorted(differs, np.arange(n)), len(differs) - 1)] if len(differs) else np.zeros(n, bool)
    out[-1] = True
    return out


def _split(places: np.ndarray, s: np.ndarray) -> list[np.ndarray]:
    """By symbol, in order."""
    symbols = s[places]
    order = np.argsort(symbols, kind="stable")
    places, symbols = places[order], symbols[order]
    cuts = [0, *(np.flatnonzero(symbols[1:] != symbols[:-1]) + 1).tolist(), len(places)]
    return [places[a:b] for a, b in zip(cuts, cuts[1:])] if len(places) else []


def _induce(s: np.ndarray, small: np.ndarray, leftmost: np.ndarray, sigma: int) -> np.ndarray:
    """The order that the given order of the leftmost smaller suffixes induces, for a small alphabet.

    A bucket (all suffixes of one first symbol) is worked off in runs: a run places the suffixes one place to the
    left of its own, behind what the other buckets hold already. What it adds to its own bucket is the next run.
    """
    waiting: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    larger: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    lower: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    given: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    for part in _split(leftmost, s):
        given[s[part[0]]].append(part)

    def place(run: np.ndarray, kind: bool) -> None:
        left = run[run > 0] - 1
        for part in _split(left[small[left] == kind], s):
            waiting[s[part[0]]].append(part)

    def work_off(c: int, kind: bool, into: list[list[np.ndarray]]) -> None:
        while waiting[c]:
            run = waiting[c][0] if len(waiting[c]) == 1 else np.concatenate(waiting[c])
            waiting[c] = []
            into[c].append(run)
            place(run, kind)

    for c in range(sigma):
        work_off(c, False, larger)
        for run in given[c]:
            place(run, False)
    waiting[0].append(np.array([len(s) - 1], dtype=np.int32))
    for c in range(sigma - 1, -1, -1):  # from the right; lower buckets are held in that order
        work_off(c, True, lower)
        for run in reversed(larger[c]):
            place(run[::-1], True)
    return np.concatenate([run for c in range(sigma) for run in (
        *larger[c], *([np.concatenate(lower[c])[::-1]] if lower[c] else []))])


def _induce_large(s: np.ndarray, small: np.ndarray, leftmost: np.ndarray, sigma: int) -> np.ndarray:
    """As ``_induce``, for alphabets of about as many symbols as the text has: symbol by symbol."""
    sizes = np.bincount(s, minlength=sigma)
    ends = np.cumsum(sizes)
    text, kind, out = s.tolist(), small.tolist(), [-1] * len(s)
    tail = ends.tolist()
    for p in reversed(leftmost.tolist()):
        tail[text[p]] -= 1
        out[tail[text[p]]] = p
    head = (ends - sizes).tolist()
    for i in range(len(out)):
        p = out[i] - 1
        if p >= 0 and not kind[p]:
            out[head[text[p]]] = p
            head[text[p]] += 1
    tail = ends.tolist()
    for i in range(len(out) - 1, -1, -1):
        p = out[i] - 1
        if p >= 0 and kind[p]:
            tail[text[p]] -= 1
            out[tail[text[p]]] = p
    out[0] = len(out) - 1
    return np.array(out, dtype=np.int32)


def suffix_array(s: np.ndarray, sigma: int) -> np.ndarray:
    """The places of all suffixes in their order. ``s`` ends in a 0 that occurs once; symbols are below ``sigma``."""
    n = len(s)
    if n == 1:
        return np.zeros(1, dtype=np.int32)
    small = _types(s)
    starts = np.zeros(n, dtype=bool)
    starts[1:] = small[1:] & ~small[:-1]
    leftmost = np.flatnonzero(starts).astype(np.int32)
    induce = _induce if sigma <= 512 else _induce_large
    order = induce(s, small, leftmost, sigma)
    order = order[starts[order]]
    # Names: the substrings from one leftmost smaller place to the next, equal ones alike.
    next_start = np.empty(n, dtype=np.int32)
    next_start[leftmost] = np.append(leftmost[1:], n - 1)
    length = next_start[order] - order + 1
    same = np.zeros(len(order), dtype=bool)
    pairs = np.flatnonzero(length[1:] == length[:-1])
    if len(pairs):
        size = length[pairs]
        first = np.cumsum(size) - size
        within = np.arange(size.sum(), dtype=np.int32) - np.repeat(first.astype(np.int32), size)
        equal = s[np.repeat(order[pairs], size) + within] == s[np.repeat(order[pairs + 1], size) + within]
        same[pairs + 1] = np.logical_and.reduceat(equal, first)
    names = np.cumsum(~same) - 1
    if names[-1] + 1 < len(order):
        named = np.empty(n, dtype=np.int32)
        named[order] = names
        order = leftmost[suffix_array(named[leftmost], int(names[-1]) + 1)]
    return induce(s, small, order, sigma)


def common_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place, the length of the common prefix with the suffix that is before it in the order (0 for the first).

    Only where the symbols before the two differ are they compared; elsewhere the prefix is one shorter than that
    of the place before.
    """
    n = len(s)
    before = np.full(n, -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    places = np.arange(n, dtype=np.int32)
    known = (before > 0) & (places > 0)
    known[known] = s[places[known] - 1] == s[before[known] - 1]
    a = np.flatnonzero(~known & (before >= 0))
    b, length = before[a], np.zeros(len(a), dtype=np.int32)
    padded = np.concatenate([s.astype(np.uint16), np.zeros(4, dtype=np.uint16)])
    four = np.lib.stride_tricks.sliding_window_view(padded, 4).copy().view(np.uint64).reshape(-1)[:n]
    live = np.arange(len(a))
    while len(live):
        x, y = a[live] + length[live], b[live] + length[live]
        inside = (x < n) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        differ = four[x] ^ four[y]
        lowest = differ & (~differ + np.uint64(1))
        length[live] += np.where(differ == 0, 4, np.where(lowest < 1 << 16, 0, np.where(
            lowest < 1 << 32, 1, np.where(lowest < 1 << 48, 2, 3))))
        live = live[differ == 0]
    reach = np.full(n, -1, dtype=np.int32)
    reach[a] = np.minimum(length, n - np.maximum(a, b)) + a
    return np.where(before >= 0, np.maximum(np.maximum.accumulate(reach) - places, 0), 0)
