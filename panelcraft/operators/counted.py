"""A forest's tree from whole counts of each class: for fits of many rows, whose nodes are mostly small.

A row of class c weighs the class's weight times how often it is drawn, so a node's sums are two whole numbers
(and the number of its rows), exact in any order.  Rows are moved so that a node's lie together.  Nodes with many rows sum histograms; small
ones sort their rows by bin, and a random cut needs the least and the greatest bin alone, so a
node costs as much as its rows.  Nodes of one class are never split and are not looked at.

Nodes are numbered as ``trees._grow_levels`` does: of the nodes that are split, in order, the k-th has the children
``2k + 1`` and ``2k + 2``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: rows looked at together (one node may have more), and rows a node above which they are summed by bin
ROWS_AT_ONCE, DENSE_FROM = 1 << 16, 40
#: a sum holds the draws of class 0, and above this those of class 1
_HIGH = 1 << 26


def _gains(w: tuple[float, float], min_rows: int, left: np.ndarray, n_left: np.ndarray, total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Gain of splits with the packed sums ``left`` of ``total``, and ``n_left`` of ``n`` rows (-inf: not allowed)."""
    one, one_all = left // _HIGH, total // _HIGH
    gl, g = w[1] * one, w[1] * one_all
    hl, h = w[0] * (left - one * _HIGH) + gl, w[0] * (total - one_all * _HIGH) + g
    gr, hr, n_right = g - gl, h - hl, n - n_left
    ok = (n_left >= max(min_rows, 1)) & (n_right >= max(min_rows, 1)) & (hl > 0) & (hr > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(ok, gl * gl / hl + gr * gr / hr - g * g / h, -np.inf)


def _random_cut(v, begin, sizes, packed, draw, gains, total):
    lo, hi = np.minimum.reduceat(v, begin).astype(np.int64), np.maximum.reduceat(v, begin).astype(np.int64)
    cut = lo + np.floor(draw * np.maximum(hi - lo, 1)).astype(np.int64)
    goes = v <= np.repeat(cut.astype(np.uint8), sizes)
    left, n_left = np.add.reduceat(np.where(goes, packed, 0), begin), np.add.reduceat(goes, begin, dtype=np.int64)
    return gains(left, n_left, total, sizes), cut, left


def _dense(v, slot, sizes, packed, width, alike, gains, total):
    """``alike``: every row is drawn once, so the sums tell how many rows there are."""
    code, f = slot * width + v, len(sizes)
    left = np.bincount(code, packed, f * width).reshape(f, width)[:, :-1].cumsum(1).astype(np.int64)
    n_left = left % _HIGH + left // _HIGH if alike else np.bincount(code, minlength=f * width).reshape(f, width)[:, :-1].cumsum(1)
    gain = gains(left, n_left, total[:, None], sizes[:, None])
    cut, every = gain.argmax(1), np.arange(f)
    return gain[every, cut], cut, left[every, cut]


def _sorted(v, slot, begin, sizes, packed, gains, total):
    f = len(sizes)
    times, one = packed % _HIGH + packed // _HIGH, packed >= _HIGH
    bits = 6                                                     # class, and how often a row is drawn (12 times at most)
    kind = np.uint32 if f << (8 + bits) < 1 << 32 else np.uint64
    key = np.sort((slot.astype(kind) << kind(8 + bits)) | (v.astype(kind) << kind(bits)) | (one.astype(kind) << kind(5)) | times.astype(kind))
    place = key >> kind(bits)
    at = np.flatnonzero(place[1:] != place[:-1])                 # last row of a bin
    at = at[slot[at] == slot[at + 1]]                            # of which there is another in the node
    best, cut, left = np.full(f, -np.inf), np.zeros(f, np.int64), np.zeros(f, np.int64)
    if not len(at):
        return best, cut, left
    times, one = (key & kind(31)).astype(np.int64), (key & kind(32)) > 0
    run = np.where(one, times * _HIGH, times).cumsum()
    of = slot[at]
    start = begin[of]
    before = np.where(start > 0, run[start - 1], 0)
    sums = run[at] - before
    gain = gains(sums, at + 1 - start, total[of], sizes[of])
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    most = np.maximum.reduceat(gain, first)
    hit = np.flatnonzero(gain == np.repeat(most, np.diff(np.r_[first, len(of)])))
    hit = hit[np.r_[True, of[hit][1:] != of[hit][:-1]]]          # the first cut of equal gains
    best[of[hit]], cut[of[hit]], left[of[hit]] = gain[hit], (place[at[hit]] & kind(255)).astype(np.int64), sums[hit]
    return best, cut, left


def grow(weight: tuple[float, float], min_rows: int, max_depth: int | None, bins: np.ndarray, one: np.ndarray, times: np.ndarray | None,
         width: int, columns_of: Callable[[np.ndarray], np.ndarray],
         draw_of: Callable[[np.ndarray, np.ndarray], np.ndarray | None]) -> dict[str, np.ndarray]:
    """The arrays of one tree.  ``one``: rows of class 1, ``times``: how often each is drawn (``None``: once)."""
    n, d = bins.shape
    bins = np.ascontiguousarray(bins)
    packed = np.where(one, _HIGH, 1) if times is None else np.where(one, times * _HIGH, times.astype(np.int64))
    pos, sizes, begins = np.zeros(1, np.int64), np.array([n]), np.arange(min(n, 2 * ROWS_AT_ONCE)) * d
    gains = lambda *a: _gains(weight, min_rows, *a)
    sums, counts, first, depth, levels = np.array([packed.sum()]), np.array([n]), 0, 0, []

    def split(some: slice, lo: int, hi: int) -> tuple[np.ndarray, ...]:
        """Best split of some nodes, which have the rows from ``lo`` to ``hi``, and which rows go left."""
        size, total, nodes = sizes[some], sums[pos[some]], first + pos[some]
        begin = np.cumsum(size) - size
        columns = columns_of(nodes)
        draws = draw_of(nodes, columns)
        f = len(size)
        m, flat, mine = hi - lo, bins[lo:hi].ravel(), packed[lo:hi]
        slot, base = np.repeat(np.arange(f), size), begins[:m] if m <= len(begins) else np.arange(m) * d
        weights = mine.astype(np.float64) if draws is None and m > DENSE_FROM * f else None
        best, column, cut, left = np.zeros(f), np.full(f, -1), np.zeros(f, np.int64), np.zeros(f, np.int64)
        for j in range(columns.shape[1]):
            v = bins[lo:hi, columns[0, j]] if f == 1 else flat.take(base + np.repeat(columns[:, j], size))
            if draws is not None:
                gain, at, sub = _random_cut(v, begin, size, mine, draws[:, j], gains, total)
            elif weights is not None:
                gain, at, sub = _dense(v, slot, size, weights, width, times is None, gains, total)
            else:
                gain, at, sub = _sorted(v, slot, begin, size, mine, gains, total)
            better = gain > np.maximum(best, 1e-9)
            best, column = np.where(better, gain, best), np.where(better, columns[:, j], column)
            cut, left = np.where(better, at, cut), np.where(better, sub, left)
        goes = flat.take(base + np.repeat(np.maximum(column, 0), size)) <= np.repeat(cut, size)
        return best, column, cut, left, goes, np.add.reduceat(goes, begin, dtype=np.int64)

    while len(sums):
        p, class1 = len(sums), sums // _HIGH
        g = weight[1] * class1
        h = weight[0] * (sums - class1 * _HIGH) + g
        now = {"column": np.full(p, -1, np.int32), "cut": np.zeros(p, np.int32), "left": np.zeros(p, np.int32), "right": np.zeros(p, np.int32),
               "value": np.divide(g, h, out=np.zeros(p), where=h > 0), "gain": np.zeros(p)}
        levels.append(now)
        if not len(pos):
            break
        ends, a, found = np.cumsum(sizes), 0, []
        while a < len(sizes):
            lo = ends[a - 1] if a else 0
            b = max(int(np.searchsorted(ends, lo + ROWS_AT_ONCE, side="right")), a + 1)
            found.append(split(slice(a, b), lo, ends[b - 1]))
            a = b
        best, column, cut, left, goes, n_left = (np.concatenate(x) if len(found) > 1 else x[0] for x in zip(*found))
        at = pos[column >= 0]
        now["column"][at], now["cut"][at], now["gain"][at] = column[column >= 0], cut[column >= 0], best[column >= 0]
        divided = now["column"] >= 0
        rank, after = np.cumsum(divided) - 1, first + p
        now["left"][divided], now["right"][divided] = after + 2 * rank[divided], after + 2 * rank[divided] + 1
        kid = 2 * rank[pos]                                      # place of a node's left child in the next level
        s, c = np.zeros(2 * int(divided.sum()), np.int64), np.zeros(2 * int(divided.sum()), np.int64)
        ok = column >= 0
        s[kid[ok]], s[kid[ok] + 1] = left[ok], sums[pos[ok]] - left[ok]
        c[kid[ok]], c[kid[ok] + 1] = n_left[ok], sizes[ok] - n_left[ok]
        first, depth, sums, counts = after, depth + 1, s, c
        may = (counts >= 2 * min_rows) & (counts > 1) & (sums >= _HIGH) & (sums % _HIGH > 0) & (max_depth is None or depth < max_depth)
        sides = [ok & may[np.where(ok, kid + k, 0)] if len(may) else np.zeros(len(ok), bool) for k in (0, 1)]
        stay = np.concatenate([np.flatnonzero(np.repeat(sides[0], sizes) & goes), np.flatnonzero(np.repeat(sides[1], sizes) & ~goes)])
        bins, packed = bins.take(stay, axis=0), packed.take(stay)
        pos = np.concatenate([kid[sides[0]], kid[sides[1]] + 1])
        sizes = counts[pos]
    return {k: np.concatenate([x[k] for x in levels]) for k in levels[0]}
