"""Banded alignment of many pairs of number sequences at once.

Numbers have 31 bits. Edit distance with unit costs, only within a band around the diagonal. A batch
of pairs moves through its rows together, so each step is a few numpy
operations over (pairs x band). The band starts narrow and widens for the
pairs whose distance it cannot prove; a distance of at most the band is exact.
"""

from __future__ import annotations

import numpy as np

CELLS = 1 << 21  # numbers of one batch's padded matrices
FAR = 1 << 28
PAD = 0xFFFFFFFF  # equal to no number of a sequence: those have 31 bits


def trim(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without their common ends, which cost nothing."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    k = int(differ[0]) if len(differ) else n
    a, b, n = a[k:], b[k:], n - k
    if n:
        differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
        k = int(differ[0]) if len(differ) else n
        a, b = a[:len(a) - k], b[:len(b) - k]
    return a, b


def bag_bound(a: np.ndarray, b: np.ndarray) -> int:
    """No alignment costs less: the longer length less the elements in common,
    wherever they are."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return max(len(a), len(b)) - int(np.minimum(nx[i], ny[j]).sum())


def one_shift(a: np.ndarray, b: np.ndarray) -> int:
    """Cost of the best alignment that changes its diagonal once: from the one
    through the first ends to the one through the last ends."""
    if len(a) > len(b):
        a, b = b, a
    n, more = len(a), len(b) - len(a)
    head = np.concatenate([[0], np.cumsum(a != b[:n])])
    tail = np.concatenate([[0], np.cumsum((a != b[more:])[::-1])])[::-1]
    return int((head + tail).min()) + more


def _banded(pairs: list[tuple[np.ndarray, np.ndarray]], band: int) -> np.ndarray:
    """Distances within the band; more than ``band`` where it is not proved.
    First sequences come in descending length."""
    n = np.array([len(a) for a, _ in pairs])
    m = np.array([len(b) for _, b in pairs])
    width, rows = 2 * band + 1, int(n.max(initial=0))
    first = np.zeros((len(pairs), max(rows, 1)), np.uint32)
    second = np.full((len(pairs), rows + width + 1), PAD, np.uint32)
    for i, (a, b) in enumerate(pairs):
        first[i, :len(a)] = a
        keep = b[:rows + band + 1]
        second[i, band:band + len(keep)] = keep
    shift = np.arange(width, dtype=np.int32)
    cost = np.where(shift >= band, shift - band, FAR).astype(np.int32)
    cost = np.repeat(cost[None, :], len(pairs), axis=0)
    out = np.full(len(pairs), FAR, np.int64)
    end = m - n + band
    inside = (end >= 0) & (end < width)
    live = len(pairs)
    for i in range(rows + 1):
        while live and n[live - 1] == i:
            live -= 1
            if inside[live]:
                out[live] = cost[live, end[live]]
        if not live:
            break
        c = cost[:live]
        step = c + (second[:live, i:i + width] != first[:live, i:i + 1])
        np.minimum(step[:, :-1], c[:, 1:] + 1, out=step[:, :-1])
        step -= shift
        np.minimum.accumulate(step, axis=1, out=step)
        step += shift
        cost[:live] = step
    return out


def within(pairs: list[tuple[np.ndarray, np.ndarray]], limit: list[int], start: int = 8) -> np.ndarray:
    """Whether the edit distance of each pair is at most its limit."""
    good = np.zeros(len(pairs), bool)
    todo: list[tuple[int, np.ndarray, np.ndarray]] = []
    for k, (a, b) in enumerate(pairs):
        if abs(len(a) - len(b)) > limit[k]:
            continue
        a, b = trim(a, b)
        if len(a) == 0 or len(b) == 0:
            good[k] = max(len(a), len(b)) <= limit[k]
        elif one_shift(a, b) <= limit[k]:
            good[k] = True
        elif bag_bound(a, b) <= limit[k]:
            todo.append((k, a, b))
    band = start
    while todo:
        todo.sort(key=lambda t: -len(t[1]))
        rest, at = [], 0
        while at < len(todo):
            size = len(todo[at][1]) + 4 * band + 2
            part = todo[at:at + max(1, CELLS // (2 * size))]
            at += len(part)
            for (k, a, b), d in zip(part, _banded([(a, b) for _, a, b in part], band)):
                if d <= band or band >= limit[k]:
                    good[k] = d <= limit[k]
                else:
                    rest.append((k, a, b))
        todo, band = rest, band * 4
    return good
