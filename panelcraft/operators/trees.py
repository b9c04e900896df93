"""Histogram trees: bagged forests and second-order boosting, all folds of a model in shared passes.

Features are binned once (at most 255 cuts, from approximate quantiles).  A split is chosen from the
sums of gradient, hessian and rows by (tree, node, feature, bin): its gain is
``GL^2/(HL+l2) + GR^2/(HR+l2) - G^2/(H+l2)`` and a leaf's value ``-G/(H+l2)``.  Boosting takes the
gradients of the weighted logistic loss; a forest takes ``-w*y`` and ``w``, for which the gain is the
weighted decrease of Gini impurity (up to a factor) and the value the share of positives.

One fit is a set of training rows: all of them (``FINAL``), or all but one fold.  Row weights, bootstrap
counts, balanced draws and column choices are hashes of (row, fit, tree, seed): they need no state,
no shuffle, and come out alike wherever a row is.

``fit`` has two ways that grow the same trees.  Up to ``WHOLE_BYTES`` of binned rows, a unit of work (a boosted
fit, or some trees of a forest's fit) has them all in one task, as a broadcast table would be, and units are
spread over tasks.  Beyond that, rows stay where they are: in each pass every task sums histograms of its own rows for the frontier
nodes of all trees in progress, the sums are shuffled by node, a node's best split is found where its sums
meet, and only splits return to the driver, which grows the trees.  Best-first growth (``max_leaves``) takes
one pass a level too: a node that the best splits known so far leave out can't be taken later, as
further nodes only add competitors.  In a task, boosting on ``HALVES_FROM`` rows or more rounds gradients so that their
sums are exact in any order, sums joint columns, and takes the larger of two siblings as their parent less the smaller.

A forest's trees grow with the rows, so they never come to the driver: a task hands each on as it is grown, in rows of
``PART_NODES`` nodes, and ``Forest`` is that table.  Boosted trees have few leaves and are a ``TreeModel``.

Defined cases: a missing value (null, NaN) goes right at every split; a fit of one class or without rows
gives a constant; constant features are never split; equal gains go to the first feature and cut.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.operators import counted
from panelcraft.session import work_dir, written

#: binned rows (a byte a feature, and ``ROW_BYTES``) up to which a unit of work has them all in one task
WHOLE_BYTES, ROW_BYTES = 160 << 20, 16
#: rows of a record sent to a unit, nodes of a row of the trees' table: some kilobytes, as thousands of records go in a batch
PACKED_ROWS, PART_NODES = 64, 512
TREES_PER_UNIT = 25
#: partitions of units by hash: with 4 a unit two of six boosted fits met in one task, and the call took twice as long
PARTITIONS_A_UNIT = 8
#: nodes whose histograms are held at once by a task that has all rows
NODES_IN_TASK = 1024
#: rows of a boosted fit from which siblings are subtracted, bins of a joint column in nodes from ``JOINT_FROM`` rows and below
HALVES_FROM, JOINT_FROM, JOINT_BINS = 50_000, 50_000, (1 << 16, 1 << 10)
#: beyond ``WHOLE_BYTES``: trees and frontier nodes of one pass, rounds between writes of the margins
TREES_AT_ONCE, NODES_AT_ONCE, REWRITE = 64, 4096, 16
FINAL = -1
#: fold of rows that only the final fit takes (synthetic ones)
ONLY_FINAL = -2


@dataclass(frozen=True)
class Growth:
    """``boost`` or ``bag``, sizes and limits of its trees, and how rows, columns and classes are drawn."""
    kind: str
    trees: int
    max_depth: int | None = None
    max_leaves: int | None = None
    rate: float = 0.1
    l2: float = 0.0
    min_rows: int = 1
    min_hessian: float = 0.0
    row_share: float = 1.0            # of boosting, per tree, without replacement
    column_share: float = 1.0         # per tree
    split_columns: int | None = None  # per node
    sample: str = "all"               # all, bootstrap, balanced (each class at the smaller one's expected size)
    weights: str = "none"             # none, balanced, positive
    random_cut: bool = False
    cuts: int = 255
    seed: int = 42


# ------------------------------------------------------------------ hashed draws
_C = tuple(np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + _C[0]
        x = (x ^ (x >> np.uint64(30))) * _C[1]
        x = (x ^ (x >> np.uint64(27))) * _C[2]
        return x ^ (x >> np.uint64(31))


def uniform(ids: np.ndarray, *salt: int) -> np.ndarray:
    """Uniforms in [0, 1), a function of id and salt alone."""
    h = np.zeros(1, np.uint64)
    for s in salt:
        h = _mix(h ^ np.uint64(s & 0xFFFFFFFFFFFFFFFF))
    return (_mix(_mix(ids.astype(np.int64).view(np.uint64)) ^ h) >> np.uint64(11)).astype(np.float64) / (1 << 53)


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


@dataclass(frozen=True)
class FitInfo:
    """A fit, its class weights, the share kept of each class in a balanced draw, its first margin."""
    fit: int
    weight: tuple[float, float]
    keep: tuple[float, float]
    start: float


def in_fit(fold: np.ndarray, fit: int) -> np.ndarray:
    return np.ones(len(fold), bool) if fit == FINAL else (fold >= 0) & (fold != fit)


def row_draws(g: Growth, info: FitInfo, tree: int, rid: np.ndarray, y: np.ndarray) -> np.ndarray | None:
    """How often each row is drawn for one tree (``None``: every row once)."""
    if g.sample == "all" and g.row_share >= 1:
        return None
    u = uniform(rid, g.seed, info.fit, tree)
    if g.sample == "bootstrap":
        return np.searchsorted(_POISSON, u, side="right")
    return u < (np.where(y == 1, info.keep[1], info.keep[0]) if g.sample == "balanced" else g.row_share)


def row_weights(g: Growth, info: FitInfo, tree: int, rid: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weight of each row in one tree: class weight times how often it is drawn."""
    w, times = np.where(y == 1, info.weight[1], info.weight[0]), row_draws(g, info, tree, rid, y)
    return w if times is None else w * times


def columns_of(g: Growth, info: FitInfo, tree: int, nodes: Sequence[int], d: int) -> np.ndarray:
    """Columns that may split each node, ascending."""
    m = max(1, round(g.column_share * d))
    base = np.arange(d) if m == d else np.sort(np.argsort(uniform(np.arange(d), g.seed, info.fit, tree, 1), kind="stable")[:m])
    k = g.split_columns
    if not k or k >= m:
        return np.tile(base, (len(nodes), 1))
    ids = (np.asarray(nodes, np.int64)[:, None] * d + base[None, :])
    u = uniform(ids.ravel(), g.seed, info.fit, tree, 2).reshape(ids.shape)
    return np.sort(base[np.argsort(u, axis=1, kind="stable")[:, :k]], axis=1)


# ------------------------------------------------------------------ histograms and splits
def _flat(bins: np.ndarray, rows: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
    """The bins in one array, where each row (default: all) begins in it, and how far its columns are apart."""
    rows = np.arange(len(bins)) if rows is None else rows
    if bins.flags.f_contiguous:
        return bins.T.ravel(), rows, len(bins)
    return bins.ravel(), rows * bins.shape[1], 1


def histogram(bins: np.ndarray, slot: np.ndarray, columns: np.ndarray, stats: Sequence[np.ndarray | None], width: int,
              rows: np.ndarray | None = None) -> np.ndarray:
    """(slots, columns, bins, stats): sums of each statistic (``None``: rows) over rows by slot and bin.

    ``rows``: the rows of ``bins`` that ``slot`` and ``stats`` belong to (default: all)."""
    f, m = columns.shape
    out = np.empty((len(stats), f, m, width))
    base, alike = slot * width, f == 1 or bool((columns == columns[0]).all())
    flat, begin, apart = (None, None, 0) if alike else _flat(bins, rows)
    for j in range(m):
        if alike:
            x = bins[:, columns[0, j]]
            x = x if rows is None else x[rows]
        else:
            x = flat.take(begin + (columns[:, j] * apart).take(slot))
        code = base + x
        for i, s in enumerate(stats):
            out[i, :, j] = np.bincount(code, s, f * width).reshape(f, width)
    return np.moveaxis(out, 0, -1)


@dataclass(frozen=True)
class Split:
    total: tuple[float, float, float]
    gain: float
    column: int = -1
    cut: int = 0
    left: tuple[float, float, float] = (0.0, 0.0, 0.0)


def _best(hist: np.ndarray, columns: np.ndarray, g: Growth, draw: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Of each slot: total (slots, 3), gain of the best split (0: none), its column and cut, and its left side (slots, 3)."""
    left = np.cumsum(np.moveaxis(hist, -1, 0), axis=-1)        # (stats, slots, columns, bins)
    total, last = left[:, :, 0, -1].copy(), left.shape[-1] - 1  # every column has all rows
    if draw is None:
        left, cut, may = left[..., :-1], np.arange(last), True
    else:                                                      # one cut a column
        used = hist[..., 2] > 0
        lo, hi = used.argmax(2), last - used[:, :, ::-1].argmax(2)
        cut = (lo + np.floor(draw * np.maximum(hi - lo, 1)).astype(int))[:, :, None]
        may, cut = cut < last, np.minimum(cut, last - 1)
        left = np.take_along_axis(left, cut[None], -1)
    (gl, hl, nl), (gr, hr, nr) = left, total[:, :, None, None] - left
    ok = may & (nl >= g.min_rows) & (nr >= g.min_rows) & (hl >= g.min_hessian) & (hr >= g.min_hessian) & (nl > 0) & (nr > 0)
    def score(a, b):
        return np.divide(a * a, b + g.l2, out=np.zeros_like(a), where=b + g.l2 > 0)
    base = score(total[0], total[1])[:, None, None]
    gain = np.where(ok, score(gl, hl) + score(gr, hr) - base, -np.inf).reshape(len(hist), -1)
    at, every = gain.argmax(1), np.arange(len(hist))
    best, (c, b) = gain[every, at], np.divmod(at, ok.shape[2])
    found, place = best > 1e-9, b if draw is None else cut[every, c, 0]
    return (total.T, np.where(found, best, 0.0), np.where(found, columns[every, c], -1), np.where(found, place, 0),
            np.where(found[:, None], left[:, every, c, b].T, 0.0))


def best_splits(hist: np.ndarray, columns: np.ndarray, g: Growth, draw: np.ndarray | None = None) -> list[Split]:
    """The best split of each slot.  ``draw`` (slots, columns): a uniform that picks the one cut allowed between
    the least and the greatest bin in use."""
    return [Split(tuple(t), gain, c, b, tuple(left)) for t, gain, c, b, left in zip(*(x.tolist() for x in _best(hist, columns, g, draw)))]


class Tree:
    """A tree in progress: the frontier's nodes wait for their splits."""

    def __init__(self, g: Growth):
        self.g, self.splits, self.children, self.depth, self.stats = g, [None], [None], [0], [None]
        self.frontier = [0]

    def advance(self, found: Sequence[Split]) -> None:
        """Takes the frontier's splits; the children of those to be carried out are the next frontier."""
        for node, s in zip(self.frontier, found, strict=True):
            self.splits[node], self.stats[node] = s, s.total
        new, chosen = [], self._chosen()
        for node in self.frontier:
            if node not in chosen:
                continue
            s, depth = self.splits[node], self.depth[node] + 1
            right = tuple(a - b for a, b in zip(s.total, s.left))
            self.children[node] = (len(self.splits), len(self.splits) + 1)
            for stats in (s.left, right):
                may = (self.g.max_depth is None or depth < self.g.max_depth) and stats[2] >= 2 * self.g.min_rows and stats[2] > 1
                if may:
                    new.append(len(self.splits))
                self.splits.append(None)
                self.children.append(None)
                self.depth.append(depth)
                self.stats.append(stats)
        self.frontier = new

    def _chosen(self) -> set[int]:
        """Nodes that are split, as far as splits are known."""
        can = lambda n: self.splits[n] is not None and self.splits[n].gain > 0 and (
            self.g.max_depth is None or self.depth[n] < self.g.max_depth)
        if self.g.max_leaves is None:
            return {n for n in range(len(self.splits)) if can(n)}
        heap, chosen = [(-self.splits[0].gain, 0)] if can(0) else [], set()
        while heap and len(chosen) < self.g.max_leaves - 1:
            _, n = heapq.heappop(heap)
            chosen.add(n)
            for c in self.children[n] or ():
                if can(c):
                    heapq.heappush(heap, (-self.splits[c].gain, c))
        return chosen

    def arrays(self) -> dict[str, np.ndarray]:
        """Nodes as arrays: column (-1: leaf), cut, left, right, value, gain."""
        chosen = self._chosen() if self.stats[0] else set()
        n = len(self.splits)
        out = {"column": np.full(n, -1, np.int32), "cut": np.zeros(n, np.int32), "left": np.zeros(n, np.int32),
               "right": np.zeros(n, np.int32), "value": np.zeros(n), "gain": np.zeros(n)}
        for i in range(n):
            gsum, h, _ = self.stats[i] or (0.0, 0.0, 0.0)
            out["value"][i] = -gsum / (h + self.g.l2) if h + self.g.l2 > 0 else 0.0
            if i in chosen and self.children[i]:
                s = self.splits[i]
                out["column"][i], out["cut"][i], out["gain"][i] = s.column, s.cut, s.gain
                out["left"][i], out["right"][i] = self.children[i]
        return out


def leaves_of(bins: np.ndarray, t: dict[str, np.ndarray]) -> np.ndarray:
    """The node where each row ends."""
    node, row = np.zeros(len(bins), np.int32), np.arange(len(bins))
    while True:
        col = t["column"][node]
        inner = col >= 0
        if not inner.any():
            return node
        goes = bins[row, np.maximum(col, 0)] <= t["cut"][node]
        node = np.where(inner, np.where(goes, t["left"][node], t["right"][node]), node)


def _draw(g: Growth, info: FitInfo, tree: int, nodes: Sequence[int], columns: np.ndarray) -> np.ndarray | None:
    if not g.random_cut:
        return None
    ids = np.asarray(nodes, np.int64)[:, None] * (1 << 20) + columns
    return uniform(ids.ravel(), g.seed, info.fit, tree, 3).reshape(ids.shape)


def gradients(g: Growth, w: np.ndarray, y: np.ndarray, margin: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if g.kind == "bag":
        return -w * y, w
    p = 1 / (1 + np.exp(-margin))
    return w * (p - y), w * p * (1 - p)


def _grow_whole(g: Growth, info: FitInfo, tree: int, bins: np.ndarray, stats: list[np.ndarray | None], width: int) -> dict[str, np.ndarray]:
    return (_grow_levels if g.max_leaves is None else _grow_best_first)(g, info, tree, bins, stats, width)


def _grow_levels(g: Growth, info: FitInfo, tree: int, bins: np.ndarray, stats: list[np.ndarray | None], width: int) -> dict[str, np.ndarray]:
    """What ``Tree`` grows without ``max_leaves``, as arrays of a level's nodes.  Rows of a node keep their order, so
    sums don't depend on how many nodes are held at once."""
    level = lambda sums: {**_leaves(g, sums), "left": np.zeros(len(sums), np.int32), "right": np.zeros(len(sums), np.int32)}
    levels, rows, slot = [], np.arange(len(bins)), np.zeros(len(bins), np.int64)
    sums, frontier, first, depth = np.zeros((1, 3)), np.zeros(1, np.int64), 0, 0       # of the level: sums, places of its frontier, first node
    while len(sums):
        if not len(frontier):
            levels.append(level(sums))
            break
        parts = range(0, len(frontier), NODES_IN_TASK)
        if len(parts) > 1:
            order = np.argsort(slot, kind="stable")
            rows, slot = rows[order], slot[order]
        ends = np.searchsorted(slot, [a + NODES_IN_TASK for a in parts]) if len(parts) > 1 else [len(slot)]
        found, lo = [], 0
        for a, hi in zip(parts, ends):
            nodes = first + frontier[a:a + NODES_IN_TASK]
            columns, here = columns_of(g, info, tree, nodes, bins.shape[1]), rows[lo:hi]
            hist = histogram(bins, slot[lo:hi] - a, columns, [None if s is None else s[here] for s in stats], width,
                             None if len(here) == len(bins) and len(parts) == 1 else here)
            found.append(_best(hist, columns, g, _draw(g, info, tree, nodes, columns)))
            lo = hi
        total, gain, column, cut, left = (np.concatenate(x) for x in zip(*found))
        sums[frontier] = total
        now = level(sums)
        split = (gain > 0) & (g.max_depth is None or depth < g.max_depth)
        rank, at, after = np.cumsum(split) - 1, frontier[split], first + len(sums)
        now["column"][at], now["cut"][at], now["gain"][at] = column[split], cut[split], gain[split]
        now["left"][at], now["right"][at] = after + 2 * rank[split], after + 2 * rank[split] + 1
        levels.append(now)
        sums = np.stack([left[split], total[split] - left[split]], 1).reshape(-1, 3)
        first, depth = after, depth + 1
        may = (sums[:, 2] >= 2 * g.min_rows) & (sums[:, 2] > 1) & (g.max_depth is None or depth < g.max_depth)
        frontier = np.flatnonzero(may)
        slots = np.where(may, np.cumsum(may) - 1, -1)
        moved = np.flatnonzero(split.take(slot))
        rows, slot = rows.take(moved), slot.take(moved)
        flat, begin, apart = _flat(bins, rows)
        slot = slots.take(2 * rank.take(slot) + (flat.take(begin + (column * apart).take(slot)) > cut.take(slot)))
        there = np.flatnonzero(slot >= 0)
        rows, slot = rows.take(there), slot.take(there)
    return {p: np.concatenate([x[p] for x in levels]) for p in _PARTS}


def _leaves(g: Growth, sums: np.ndarray) -> dict[str, np.ndarray]:
    n, h = len(sums), sums[:, 1] + g.l2
    return {"column": np.full(n, -1, np.int32), "cut": np.zeros(n, np.int32), "gain": np.zeros(n),
            "value": np.divide(-sums[:, 0], h, out=np.zeros(n), where=h > 0)}


def _grow_best_first(g: Growth, info: FitInfo, tree: int, bins: np.ndarray, stats: list[np.ndarray | None], width: int) -> dict[str, np.ndarray]:
    t = Tree(g)
    node = np.zeros(len(bins), np.int64)
    while t.frontier:
        frontier = t.frontier
        slots = np.full(len(t.splits), -1, np.int64)
        slots[frontier] = np.arange(len(frontier))
        here = np.flatnonzero(slots[node] >= 0)
        columns = columns_of(g, info, tree, frontier, bins.shape[1])
        k = slots[node[here]]
        hist = histogram(bins, k, columns, [None if s is None else s[here] for s in stats], width, here if len(here) < len(bins) else None)
        t.advance(best_splits(hist, columns, g, _draw(g, info, tree, frontier, columns)))
        col = np.array([t.splits[n].column if t.children[n] else -1 for n in frontier])
        cut = np.array([t.splits[n].cut for n in frontier])
        kid = np.array([t.children[n] or (0, 0) for n in frontier])
        moved = col[k] >= 0
        rows, k = here[moved], k[moved]
        node[rows] = np.where(bins[rows, col[k]] <= cut[k], kid[k, 0], kid[k, 1])
    return t.arrays()


class Joint:
    """Columns of bins as few columns of joint bins: sums by several columns at once, of which each column's are marginals."""

    def __init__(self, bins: np.ndarray, most: int):
        self.groups: list[tuple[list[int], list[int]]] = []
        sizes = bins.max(0).astype(int) + 1
        for c in np.argsort(-sizes, kind="stable").tolist():
            for columns, shape in self.groups:
                if math.prod(shape) * sizes[c] <= most:
                    columns.append(c)
                    shape.append(int(sizes[c]))
                    break
            else:
                self.groups.append(([c], [int(sizes[c])]))
        self.codes = []
        for columns, shape in self.groups:
            code = np.zeros(len(bins), np.uint16)
            for c, k in zip(columns, shape):
                code = code * np.uint16(k) + bins[:, c]
            self.codes.append(code)

    def sums(self, rows: np.ndarray | None, columns: np.ndarray, stats: Sequence[np.ndarray | None], width: int) -> np.ndarray:
        """``histogram`` of one slot: (columns, bins, stats)."""
        out, place = np.zeros((len(columns), width, len(stats))), {c: i for i, c in enumerate(columns.tolist())}
        for (members, shape), code in zip(self.groups, self.codes):
            wanted = [i for i, c in enumerate(members) if c in place]
            if not wanted:
                continue
            code = (code if rows is None else code[rows]).astype(np.intp)
            for k, s in enumerate(stats):
                cells = np.bincount(code, s, math.prod(shape)).reshape(shape)
                for i in wanted:
                    out[place[members[i]], :shape[i], k] = cells.sum(tuple(j for j in range(len(shape)) if j != i))
        return out


def exact(s: np.ndarray) -> np.ndarray:
    """Rounded to multiples of a power of two (some 2^-30 of the largest) of which any sum is exact, in any order."""
    most = len(s) * float(np.abs(s).max(initial=0.0))
    if not most:
        return s
    scale = 2.0 ** min(52 - math.ceil(math.log2(most)), 1000)
    return np.rint(s * scale) / scale


def _grow_halves(g: Growth, info: FitInfo, tree: int, d: int, joints: Sequence[Joint], bins: np.ndarray, drawn: np.ndarray | None,
                 a: np.ndarray, b: np.ndarray, width: int) -> tuple[dict[str, np.ndarray], list[tuple[int, np.ndarray | None]]]:
    """What ``Tree`` grows where all nodes have the same columns, and leaves with their rows.  Of two siblings the one with
    fewer rows is summed, the other's sums are their parent's less these."""
    t, columns = Tree(g), columns_of(g, info, tree, [0], d)
    rows: dict[int, np.ndarray | None] = {0: drawn}
    parent: dict[int, tuple[int, int]] = {}
    sums: dict[int, np.ndarray] = {}
    size = lambda n: len(a) if rows[n] is None else len(rows[n])

    def summed(n: int) -> np.ndarray:
        r = rows[n]
        joint = joints[0] if size(n) >= JOINT_FROM else joints[1]
        return joint.sums(r, columns[0], [a if r is None else a[r], b if r is None else b[r], None], width)

    while t.frontier:
        frontier = t.frontier
        for n in frontier:
            if n in sums:
                continue
            if n not in parent:
                sums[n] = summed(n)
                continue
            p, other = parent[n]
            less, more = sorted((n, other), key=size)
            sums[less] = summed(less)
            sums[more] = sums[p] - sums[less]
        every = np.tile(columns, (len(frontier), 1))
        t.advance(best_splits(np.stack([sums[n] for n in frontier]), every, g, _draw(g, info, tree, frontier, every)))
        for n in [n for n in rows if t.children[n]]:
            split, r, (left, right) = t.splits[n], rows.pop(n), t.children[n]
            goes = bins[:, split.column] if r is None else bins[r, split.column]
            goes = goes <= split.cut
            rows[left], rows[right] = (np.flatnonzero(goes), np.flatnonzero(~goes)) if r is None else (r[goes], r[~goes])
            parent[left], parent[right] = (n, right), (n, left)
    grown = t.arrays()

    def leaf(n: int) -> int:                                    # nodes may have been split for nothing
        at = n
        while n in parent:
            n = parent[n][0]
            at = n if grown["column"][n] < 0 else at
        return at

    return grown, [(leaf(n), r) for n, r in rows.items()]


def _boost_halves(g: Growth, info: FitInfo, trees: range, rid, y, bins, width) -> Iterator[tuple[int, dict]]:
    """Boosting on many rows."""
    joints = [Joint(bins, most) for most in JOINT_BINS]
    margin = np.full(len(y), info.start)
    for t in trees:
        w = row_weights(g, info, t, rid, y)
        drawn = None if (w > 0).all() else np.flatnonzero(w > 0)
        a, b = gradients(g, w, y, margin)
        if drawn is not None and not len(drawn):
            grown, leaves = Tree(g).arrays(), []
        else:
            grown, leaves = _grow_halves(g, info, t, bins.shape[1], joints, bins, drawn, exact(a), exact(b), width)
        step = np.zeros(len(y))
        for leaf, r in leaves:
            step[slice(None) if r is None else r] = grown["value"][leaf]
        if drawn is not None:
            rest = np.flatnonzero(w <= 0)
            step[rest] = grown["value"][leaves_of(bins[rest], grown)]
        margin = margin + g.rate * step
        yield t, grown


def _grow_counted(g: Growth, info: FitInfo, tree: int, rid, y, bins, width) -> dict[str, np.ndarray]:
    """A forest's tree on many rows."""
    times, one = row_draws(g, info, tree, rid, y), y == 1
    if times is not None:
        drawn = np.flatnonzero(times)
        bins, one, times = bins[drawn], one[drawn], times[drawn] if g.sample == "bootstrap" else None
    if not len(bins):
        return Tree(g).arrays()
    return counted.grow(info.weight, g.min_rows, g.max_depth, bins, one, times, width,
                        lambda nodes: columns_of(g, info, tree, nodes, bins.shape[1]),
                        lambda nodes, columns: _draw(g, info, tree, nodes, columns))


def _whole_unit(g: Growth, info: FitInfo, trees: range, rid, y, fold, bins, width) -> Iterator[tuple[int, dict]]:
    if fold is not None:
        use = in_fit(fold, info.fit)
        rid, y, bins = rid[use], y[use], bins[use]
    if g.kind == "boost" and not g.split_columns and len(y) >= HALVES_FROM:
        yield from _boost_halves(g, info, trees, rid, y, np.asfortranarray(bins), width)
        return
    if g.kind == "bag" and g.max_leaves is None and not g.min_hessian and not g.l2 and len(y) >= HALVES_FROM:
        yield from ((t, _grow_counted(g, info, t, rid, y, bins, width)) for t in trees)
        return
    if g.kind == "boost":
        bins = np.asfortranarray(bins)                      # read column by column
    margin = np.full(len(y), info.start)
    for t in trees:
        w = row_weights(g, info, t, rid, y)
        drawn = np.flatnonzero(w > 0)
        a, b = gradients(g, w, y, margin)
        if len(drawn) == len(bins):
            grown = _grow_whole(g, info, t, bins, [a, b, None], width) if len(drawn) else Tree(g).arrays()
        elif len(drawn):
            x = bins[drawn] if g.kind == "bag" else np.asfortranarray(bins[drawn])
            grown = _grow_whole(g, info, t, x, [a[drawn], b[drawn], None], width)
        else:
            grown = Tree(g).arrays()
        if g.kind == "boost":
            margin = margin + g.rate * grown["value"][leaves_of(bins, grown)]
        yield t, grown


#: nodes of a tree, at most ``PART_NODES`` of them: which are split (bits), these ones' columns, cuts as values, left children (the
#: right one is next) and gains, and the values of the others, one array each
_TREE = "fit int, tree int, part int, nodes long, inner binary, column binary, cut binary, left binary, gain binary, value binary"
_PARTS = ("column", "cut", "left", "right", "value", "gain")
_TYPES = {"column": np.int32, "cut": np.float64, "left": np.int32, "right": np.int32, "value": np.float64, "gain": np.float64}


def _decoded(pdf: pd.DataFrame, d: int) -> tuple[np.ndarray, ...]:
    bins = np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(len(pdf), d)
    return pdf["rid"].to_numpy(np.int64), pdf["y"].to_numpy(np.int64), pdf["fold"].to_numpy(np.int64), bins


def _packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``PACKED_ROWS`` rows of a fold as one, so that a unit's rows are few arrays."""
    for pdf in frames:
        out = []
        for fold, part in pdf.groupby("fold"):
            for a in range(0, len(part), PACKED_ROWS):
                some = part.iloc[a:a + PACKED_ROWS]
                out.append((fold, some["rid"].to_numpy(np.int64).tobytes(), some["y"].to_numpy(np.int32).tobytes(), b"".join(some["bins"])))
        if out:
            yield pd.DataFrame(out, columns=["fold", "rid", "y", "bins"])


def _gathered(batches: Iterator[pd.DataFrame], d: int) -> tuple[np.ndarray, ...]:
    """The rows in order of ``rid``: sums in one order, whatever the shuffle's."""
    rid, y, bins = [], [], []
    for pdf in batches:
        rid.append(np.frombuffer(b"".join(pdf["rid"]), np.int64))
        y.append(np.frombuffer(b"".join(pdf["y"]), np.int32))
        bins.append(np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(-1, d))
    rid, y = np.concatenate(rid), np.concatenate(y)
    order = np.argsort(rid, kind="stable")
    place, x = np.empty(len(rid), np.int64), np.empty((len(rid), d), np.uint8)
    place[order] = np.arange(len(rid))
    bins.reverse()
    at = 0
    while bins:                                                  # each is freed as it is copied
        some = bins.pop()
        x[place[at:at + len(some)]] = some
        at += len(some)
    return rid[order], y[order], None, x


def _encoded(grown: Sequence[tuple[int, int, dict]], cuts: list[np.ndarray], most: int | None = None) -> pd.DataFrame:
    """Trees as rows of ``_TREE``, of ``most`` nodes each."""
    most = most or PART_NODES
    flat = np.concatenate([*cuts, np.zeros(1)])
    start = np.concatenate([[0], np.cumsum([len(c) for c in cuts])]).astype(np.int64)
    out = []
    for fit, t, a in grown:
        for part, lo in enumerate(range(0, len(a["column"]), most)):
            some = {p: v[lo:lo + most] for p, v in a.items()}
            inner = some["column"] >= 0
            split = {p: some[p][inner] for p in ("column", "left", "gain")}
            split["cut"] = flat[start[split["column"]] + some["cut"][inner]]
            out.append((fit, t, part, len(inner), np.packbits(inner).tobytes(),
                        *[split[p].astype(_TYPES[p]).tobytes() for p in ("column", "cut", "left", "gain")],
                        some["value"][~inner].astype(np.float64).tobytes()))
    return pd.DataFrame(out, columns=["fit", "tree", "part", "nodes", "inner", "column", "cut", "left", "gain", "value"])


def _fit_whole(rows: DataFrame, g: Growth, infos: list[FitInfo], cuts: list[np.ndarray], width: int) -> DataFrame:
    per, most = g.trees if g.kind == "boost" else TREES_PER_UNIT, PART_NODES
    units = [(i, range(a, min(a + per, g.trees))) for i in range(len(infos)) for a in range(0, g.trees, per)]

    def run(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        i, trees = units[key[0]]
        for t, a in _whole_unit(g, infos[i], trees, *_gathered(batches, len(cuts)), width):
            yield _encoded([(infos[i].fit, t, a)], cuts, most)   # one tree at a time

    packed = rows.mapInPandas(_packed, "fold int, rid binary, y binary, bins binary")
    # a unit has the rows of its fit alone
    of = [F.lit([u for u, (j, _) in enumerate(units) if j == i]) for i in range(len(infos))]
    uses = lambda f: F.lit(True) if f == FINAL else (F.col("fold") >= 0) & (F.col("fold") != f)
    mine = F.flatten(F.array(*[F.when(uses(info.fit), of[i]).otherwise(F.array().cast("array<int>")) for i, info in enumerate(infos)]))
    none = rows.sparkSession.range(len(units)).select(F.col("id").cast("int").alias("unit"), *[F.lit("").cast("binary").alias(c) for c in ("rid", "y", "bins")])
    spread = (packed.select(F.explode(mine).alias("unit"), "rid", "y", "bins").unionByName(none)         # a fit may have no rows
              .repartition(PARTITIONS_A_UNIT * len(units), "unit"))
    return spread.groupBy("unit").applyInPandas(run, _TREE)


# ------------------------------------------------------------------ rows that stay where they are
_SUMS = "fit int, tree int, node int, sums binary"
_SPLITS = ("fit int, tree int, node int, g double, h double, n double, gain double, column int, cut int, lg double, lh double, ln double")


def _partial(g: Growth, infos: dict[int, FitInfo], work: list[tuple[int, int, dict, list[int]]], recent: dict[int, list[dict]],
             d: int, width: int) -> Callable:
    """Per task: sums of its rows for the frontier of each tree at work."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        picked = [(fit, t, arrays, nodes, columns_of(g, infos[fit], t, nodes, d)) for fit, t, arrays, nodes in work]
        for pdf in frames:
            if not len(pdf):
                continue
            rid, y, fold, bins = _decoded(pdf, d)
            margins = np.stack(pdf["margins"]) if g.kind == "boost" else None
            for fit, t, arrays, nodes, columns in picked:
                use = np.flatnonzero(in_fit(fold, fit))
                w = row_weights(g, infos[fit], t, rid[use], y[use])
                use, w = use[w > 0], w[w > 0]
                m = None if margins is None else _margin(g, margins[use, sorted(infos).index(fit)], bins[use], recent[fit])
                a, b = gradients(g, w, y[use], m)
                slots = np.full(len(arrays["column"]), -1, np.int64)
                slots[nodes] = np.arange(len(nodes))
                slot = slots[leaves_of(bins[use], arrays)]
                here = slot >= 0
                hist = histogram(bins[use][here], slot[here], columns, [a[here], b[here], np.ones(here.sum())], width)
                sums[fit, t] = sums[fit, t] + hist if (fit, t) in sums else hist
        for fit, t, _, nodes, _ in picked:
            if (fit, t) in sums:
                yield pd.DataFrame([(fit, t, n, s.tobytes()) for n, s in zip(nodes, sums[fit, t])], columns=["fit", "tree", "node", "sums"])
    return run


def _margin(g: Growth, margin: np.ndarray, bins: np.ndarray, trees: list[dict]) -> np.ndarray:
    for t in trees:
        margin = margin + g.rate * t["value"][leaves_of(bins, t)]
    return margin


def _reduced(g: Growth, infos: dict[int, FitInfo], d: int, width: int) -> Callable:
    """Per task: sums of a node, which come together sorted, added up; its best split."""
    def close(key, total):
        fit, t, node = key
        columns = columns_of(g, infos[fit], t, [node], d)
        s = best_splits(total.reshape(1, columns.shape[1], width, 3), columns, g, _draw(g, infos[fit], t, [node], columns))[0]
        return (*key, *s.total, s.gain, s.column, s.cut, *s.left)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _SPLITS.split(", ")]
        now, total, out = None, None, []
        for pdf in frames:
            for *key, sums in pdf.itertuples(index=False):
                x = np.frombuffer(sums)
                if key != now:
                    if now is not None:
                        out.append(close(now, total))
                    now, total = key, x
                else:
                    total = total + x
            yield pd.DataFrame(out, columns=names)
            out = []
        if now is not None:
            yield pd.DataFrame([close(now, total)], columns=names)
    return run


def _pass(rows: DataFrame, g: Growth, infos: dict[int, FitInfo], trees: dict[tuple[int, int], Tree], recent, d: int, width: int) -> None:
    """One level of the trees at work, or as many of them as one pass takes."""
    work, nodes = [], 0
    for (fit, t), tree in trees.items():
        if tree.frontier and (not work or nodes + len(tree.frontier) <= NODES_AT_ONCE):
            work.append((fit, t, tree.arrays(), tree.frontier))
            nodes += len(tree.frontier)
    sums = rows.mapInPandas(_partial(g, infos, work, recent, d, width), _SUMS)
    splits = (sums.repartition("fit", "tree", "node").sortWithinPartitions("fit", "tree", "node")
              .mapInPandas(_reduced(g, infos, d, width), _SPLITS).collect())       # one row a node
    found = {(r["fit"], r["tree"], r["node"]): Split((r["g"], r["h"], r["n"]), r["gain"], r["column"], r["cut"], (r["lg"], r["lh"], r["ln"]))
             for r in splits}
    for fit, t, _, frontier in work:
        trees[fit, t].advance([found.get((fit, t, n), Split((0.0, 0.0, 0.0), 0.0)) for n in frontier])


def _rewritten(rows: DataFrame, g: Growth, fits: list[int], recent: dict[int, list[dict]], d: int) -> DataFrame:
    def run(frames):
        for pdf in frames:
            bins = _decoded(pdf, d)[3]
            old = np.stack(pdf["margins"]) if len(pdf) else np.zeros((0, len(fits)))
            new = [_margin(g, old[:, i], bins, recent[f]) for i, f in enumerate(fits)]
            yield pdf.assign(margins=list(np.stack(new, 1)))
    return written(rows.mapInPandas(run, rows.schema), "margins")


def _fit_spread(rows: DataFrame, g: Growth, infos: list[FitInfo], cuts: list[np.ndarray], width: int) -> DataFrame:
    spark, d, path = rows.sparkSession, len(cuts), work_dir(rows.sparkSession, "grown") + "/t"
    by_fit, held = {i.fit: i for i in infos}, []
    def keep():
        spark.createDataFrame(_encoded(held, cuts), _TREE).write.mode("append").parquet(path)
        held.clear()
    fits = sorted(by_fit)
    recent: dict[int, list[dict]] = {f: [] for f in fits}
    if g.kind == "boost":
        rows = written(rows.withColumn("margins", F.array(*[F.lit(by_fit[f].start) for f in fits])), "margins")
        batches = [[(f, t) for f in fits] for t in range(g.trees)]
    else:
        every = [(f, t) for f in fits for t in range(g.trees)]
        batches = [every[i:i + TREES_AT_ONCE] for i in range(0, len(every), TREES_AT_ONCE)]
    for batch in batches:
        trees = {k: Tree(g) for k in batch}
        while any(t.frontier for t in trees.values()):
            _pass(rows, g, by_fit, trees, recent, d, width)
        done = [(f, t, tree.arrays()) for (f, t), tree in trees.items()]
        held += done
        if g.kind == "boost":
            for f, _, arrays in done:
                recent[f].append(arrays)
            if len(recent[fits[0]]) >= REWRITE:
                rows = _rewritten(rows, g, fits, recent, d)
                recent = {f: [] for f in fits}
        if len(held) >= TREES_AT_ONCE:
            keep()
    if held:
        keep()
    return spark.read.schema(_TREE).parquet(path)


# ------------------------------------------------------------------ the model
@dataclass
class TreeModel:
    """Fitted trees over named columns, with their cuts as values; scores rows by itself."""
    features: list[str]
    kind: str
    rate: float
    start: float
    root: np.ndarray                     # first node of each tree
    column: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray = field(repr=False)

    def proba(self, x: np.ndarray) -> np.ndarray:
        """P(class 1) of each row of a matrix of the features."""
        total, row = np.zeros(len(x)), np.arange(len(x))[:, None]
        for a in range(0, len(self.root), 64):
            node = np.tile(self.root[a:a + 64], (len(x), 1))
            while True:
                col = self.column[node]
                inner = col >= 0
                if not inner.any():
                    break
                goes = x[row, np.maximum(col, 0)] <= self.cut[node]
                node = np.where(inner, np.where(goes, self.left[node], self.right[node]), node)
            total += self.value[node].sum(1)
        if self.kind == "bag":
            return total / max(len(self.root), 1)
        return 1 / (1 + np.exp(-(self.start + self.rate * total)))

    def importances(self) -> np.ndarray:
        """Mean over trees of each feature's share of the tree's gain."""
        out = np.zeros(len(self.features))
        for a, b in zip(self.root, [*self.root[1:], len(self.column)]):
            inner = self.column[a:b] >= 0
            per = np.bincount(self.column[a:b][inner], self.gain[a:b][inner], len(self.features))
            out += per / per.sum() if per.sum() > 0 else 0
        return out / out.sum() if out.sum() > 0 else np.full(len(out), 1 / max(len(out), 1))


def _model(g: Growth, start: float, features: Sequence[str], trees: Sequence[dict[str, np.ndarray]]) -> TreeModel:
    sizes = np.array([len(t["column"]) for t in trees])
    root = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    joined = {p: np.concatenate([t[p] for t in trees]) for p in _PARTS}
    shift = np.repeat(root, sizes)
    return TreeModel(list(features), g.kind, g.rate, start, root, joined["column"], joined["cut"], joined["left"] + shift,
                     joined["right"] + shift, joined["value"], joined["gain"])


def arrays_of(parts: Sequence) -> dict[str, np.ndarray]:
    """A tree's arrays from its rows of ``_TREE``, in order (no gains where they are left out)."""
    inner = np.concatenate([np.unpackbits(np.frombuffer(r["inner"], np.uint8), count=int(r["nodes"])).astype(bool) for r in parts])
    out = {p: np.zeros(len(inner), _TYPES[p]) for p in _PARTS}
    out["column"] -= 1
    for p in [p for p in ("column", "cut", "left", "gain") if p in parts[0]]:
        out[p][inner] = np.frombuffer(b"".join(r[p] for r in parts), _TYPES[p])
    out["right"][inner] = out["left"][inner] + 1
    out["value"][~inner] = np.frombuffer(b"".join(r["value"] for r in parts), np.float64)
    return out


def _trees_of(rows: Sequence) -> list[tuple[int, int, dict[str, np.ndarray]]]:
    """(fit, tree, arrays) of the trees whose rows these are, in order."""
    place = lambda r: (r["fit"], r["tree"])
    return [(*k, arrays_of(list(parts))) for k, parts in groupby(sorted(rows, key=lambda r: (*place(r), r["part"])), place)]


class Forest:
    """The trees of a forest's fit as rows of a written table (one or more a tree), which the fits of a call share.

    ``model`` brings them to the driver, for forests known to be small; ``importances`` brings a row of shares a tree."""

    def __init__(self, features: Sequence[str], table: DataFrame, fit: int, trees: int, nodes: int):
        self.features, self.table, self.fit, self.trees, self.nodes = list(features), table, fit, trees, nodes

    def rows(self) -> DataFrame:
        return self.table.where(F.col("fit") == self.fit)

    @cached_property
    def model(self) -> TreeModel:
        trees = [a for _, _, a in _trees_of(self.rows().collect())]
        return _model(Growth("bag", len(trees)), 0.0, self.features, trees)

    def proba(self, x: np.ndarray) -> np.ndarray:
        return self.model.proba(x)

    @property
    def root(self) -> np.ndarray:
        return self.model.root

    @property
    def column(self) -> np.ndarray:
        return self.model.column

    def importances(self) -> np.ndarray:
        """Mean over trees of each feature's share of the tree's gain."""
        d = len(self.features)

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                per = [np.bincount(np.frombuffer(c, np.int32), np.frombuffer(gain, np.float64), d).tolist() for c, gain in zip(pdf["column"], pdf["gain"])]
                yield pd.DataFrame({"tree": pdf["tree"], "part": pdf["part"], "per": per})

        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            per = sum(np.asarray(p) for p in pdf.sort_values("part")["per"])
            return pd.DataFrame({"tree": [pdf["tree"].iloc[0]], "per": [per.tolist()]})

        out, kind = np.zeros(d), "tree int, part int, per array<double>"
        parts = self.rows().select("tree", "part", "column", "gain").mapInPandas(run, kind)
        for r in sorted(parts.groupBy("tree").applyInPandas(whole, "tree int, per array<double>").collect(), key=lambda r: r["tree"]):
            per = np.array(r["per"])
            out += per / per.sum() if per.sum() > 0 else 0
        return out / out.sum() if out.sum() > 0 else np.full(d, 1 / max(d, 1))


#: trees whose values are added up by one task, in one sum as ``TreeModel.proba`` does
BLOCK = 64


def block_sums(trees: Sequence[dict[str, np.ndarray]], x: np.ndarray, at_once: int = 16_384) -> np.ndarray:
    """The sum of a block of trees' values for each row."""
    out = np.zeros(len(x))
    for a in range(0, len(x), at_once):
        part = x[a:a + at_once]
        values = np.empty((len(part), len(trees)))
        for i, t in enumerate(trees):
            node, live = np.zeros(len(part), np.int32), np.arange(len(part))
            while len(live):
                n = node[live]
                col = t["column"][n]
                inner = col >= 0
                if not inner.all():
                    live, n, col = live[inner], n[inner], col[inner]
                node[live] = np.where(part[live, col] <= t["cut"][n], t["left"][n], t["right"][n])
            values[:, i] = t["value"][node]
        out[a:a + at_once] = values.sum(1)
    return out


def quantile_cuts(df: DataFrame, features: Sequence[str], cuts: int = 255) -> list[np.ndarray]:
    """Ascending cut values of each feature, from one aggregate."""
    probs = [(i + 1) / (cuts + 1) for i in range(cuts)]
    seen = lambda c: F.when(~F.isnan(c), F.col(c))
    row = df.agg(*[F.percentile_approx(seen(c), probs, 10 * (cuts + 1)).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.asarray(q or [], np.float64)) for q in row]


def binned(df: DataFrame, features: Sequence[str], cuts: list[np.ndarray], label: str, fold: str, rid: str) -> DataFrame:
    """(rid, y, fold, bins): a byte for each feature, the number of cuts below the value."""
    def run(frames):
        for pdf in frames:
            cols = [np.searchsorted(c, pdf[f"f{i}"].to_numpy(np.float64)).astype(np.uint8) for i, c in enumerate(cuts)]
            x = np.ascontiguousarray(np.stack(cols, 1)) if len(pdf) else np.zeros((0, len(cuts)), np.uint8)
            yield pd.DataFrame({"rid": pdf["rid"], "y": pdf["y"], "fold": pdf["fold"], "bins": [r.tobytes() for r in x]})
    plain = df.select(F.col(rid).cast("long").alias("rid"), F.col(label).cast("int").alias("y"), F.col(fold).cast("int").alias("fold"),
                      *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)])
    return plain.mapInPandas(run, "rid long, y int, fold int, bins binary")


def _infos(rows: DataFrame, g: Growth, fits: Sequence[int]) -> tuple[list[FitInfo], int]:
    n = {(r["fold"], r["y"]): r["n"] for r in rows.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}   # folds x classes
    out = []
    for f in fits:
        c = [sum(v for (fold, y), v in n.items() if y == k and (f == FINAL or (fold >= 0 and fold != f))) for k in (0, 1)]
        w = (1.0, 1.0)
        if min(c) > 0:
            w = {"none": w, "balanced": (sum(c) / (2 * c[0]), sum(c) / (2 * c[1])), "positive": (1.0, c[0] / c[1])}[g.weights]
        pos, neg = w[1] * c[1] + 1e-9, w[0] * c[0] + 1e-9
        out.append(FitInfo(f, w, tuple(min(c) / k if k else 1.0 for k in c) if min(c) else (1.0, 1.0), math.log(pos / neg)))
    return out, sum(n.values())


def fit(train: DataFrame, features: Sequence[str], label: str, g: Growth, fits: Sequence[int] = (FINAL,), fold: str | None = None,
        rid: str = "rid", whole_rows: int | None = None) -> dict[int, TreeModel | Forest]:
    """A model for each fit: ``FINAL`` is fitted on all rows, a fold's number on the rows of all other folds.

    ``rid`` tells rows apart in the draws; rows of fold ``ONLY_FINAL`` are left out of the folds' fits.
    ``whole_rows``: rows that a task may have all of (default: those that ``WHOLE_BYTES`` hold)."""
    df = train if fold else train.withColumn("fold", F.lit(0))
    cuts = quantile_cuts(df, features, g.cuts)
    rows = written(binned(df, features, cuts, label, fold or "fold", rid), "binned")
    infos, n = _infos(rows, g, fits)
    width = max([len(c) for c in cuts], default=0) + 1
    width = max(width, 2)
    if whole_rows is None:
        whole_rows = WHOLE_BYTES // (len(features) + ROW_BYTES)
    if n:
        grown = (_fit_whole if n <= whole_rows else _fit_spread)(rows, g, infos, cuts, width)
    else:
        grown = train.sparkSession.createDataFrame(_encoded([(i.fit, 0, Tree(g).arrays()) for i in infos], cuts), _TREE)
    if g.kind == "bag":
        return _forests(written(grown, "trees", compression="zstd"), features, fits)
    per: dict[int, dict[int, dict]] = {i.fit: {} for i in infos}
    for f, t, a in _trees_of(grown.collect()):              # few leaves a tree: bounded by the model's size
        per[f][t] = a
    return {i.fit: _model(g, i.start, features, [per[i.fit][t] for t in sorted(per[i.fit])]) for i in infos}


def _forests(table: DataFrame, features: Sequence[str], fits: Sequence[int]) -> dict[int, Forest]:
    sizes = {r["fit"]: r for r in table.groupBy("fit").agg(F.count_if(F.col("part") == 0).alias("trees"), F.sum("nodes").alias("nodes")).collect()}
    return {f: Forest(features, table, f, sizes[f]["trees"], sizes[f]["nodes"]) for f in fits}


# ------------------------------------------------------------------ saving
def save(model: TreeModel | Forest, spark: SparkSession, path: str) -> None:
    """One row with the model's arrays; a forest has its table."""
    if isinstance(model, Forest):
        model.rows().withColumn("features", F.array(*[F.lit(f) for f in model.features])).write.mode("overwrite").parquet(path)
        return
    row = {k: (v.tolist() if isinstance(v, np.ndarray) else v) for k, v in vars(model).items()}
    schema = ("features array<string>, kind string, rate double, start double, root array<long>, column array<int>, cut array<double>, "
              "left array<long>, right array<long>, value array<double>, gain array<double>")
    names = [c.split()[0] for c in schema.split(", ")]
    spark.createDataFrame([tuple(row[k] for k in names)], schema).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> TreeModel | Forest:
    table = spark.read.parquet(path)
    if "tree" in table.columns:
        r = table.select("features", "fit").first()
        return _forests(table.drop("features"), r["features"], [r["fit"]])[r["fit"]]
    r = table.first().asDict()
    kinds = {"root": np.int64, "column": np.int32, "left": np.int64, "right": np.int64}
    return TreeModel(**{k: np.asarray(v, kinds.get(k, np.float64)) if isinstance(v, list) and k != "features" else v for k, v in r.items()})
