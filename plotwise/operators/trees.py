"""Regression trees of any depth, and forests of them, over binned features.

Every row becomes a few small integers, one per continuous feature and one per
group of indicator features that exclude each other. Trees grow in two steps. Nodes with
more than ``TASK_ROWS`` rows are split in Spark: each level is one pass that sums histograms per node,
and only the best splits reach the driver. Once a node's rows fit one task they are sent
there, and the subtree below is finished at any depth from sorted positions.

Bootstrap weights are Poisson(1) numbers of (seed, tree, row id), so they need no storage,
and tree t of a forest is the same tree whatever the number of trees or the greatest
depth asked for. A forest of 300 trees therefore contains those of 100 and 200,
and inner nodes keep their means, so cutting trees at a depth equals growing them to it. The
searches in ``operators.models`` score many settings from one growth.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.config import RANDOM_STATE
from plotwise.functions.vectors import entries, length, slot, stored
from plotwise.session import scratch_path

#: Rows of a node that one task finishes, rows of a chunk, trees a task grows from one copy of its rows.
TASK_ROWS, CHUNK_ROWS, BLOCK_TREES = 1_000_000, 65_536, 5
#: Rows x columns whose sums a growing tree holds at once, rows of a node (at least) that keeps sums per bin, rows that smaller nodes are finished together with.
CELLS, FEW_ROWS, ORDERED = 1 << 20, 64, 1 << 13
#: Bins of a continuous feature, and the rank error of their borders.
MAX_BINS, RANK_ERROR = 64, 0.001
#: Bytes of trees that scoring ships to every executor; larger forests are joined to chunks of rows.
BROADCAST_BYTES = 64 << 20
#: Rows that meet a block of such a forest's trees in one task.
SCORED_ROWS = 8 * CHUNK_ROWS
#: Bits that labels keep.
LABEL_BITS = 30
#: Nodes whose histograms one pass sums, bins of them that a task holds before it sends them, and nodes x columns below which tasks' sums meet in two steps.
WAVE, HELD, TWICE = 256, 1 << 21, 1 << 8
#: Boosted trees between two writings of what they leave of the labels.
REWRITE = 25
#: A split must lower the sum of squares by this share of the node's.
LEAST_GAIN = 1e-12


@dataclass(frozen=True)
class Columns:
    """How a feature vector is binned: borders per continuous slot, and [first, last) slots per exclusive group."""
    slots: tuple[int, ...]
    borders: tuple[tuple[float, ...], ...]
    groups: tuple[tuple[int, int], ...]

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Rows x columns: a value's bin is the number of borders below it (so values up to a border go left of it); a
        group's code is the place of its indicator from 1, 0 without any."""
        out = np.empty((len(x), len(self.slots) + len(self.groups)), dtype=self.kind)
        for c, (s, b) in enumerate(zip(self.slots, self.borders)):
            out[:, c] = np.searchsorted(np.asarray(b), x[:, s], side="left")
        for c, (a, z) in enumerate(self.groups, len(self.slots)):
            part = x[:, a:z]
            out[:, c] = np.where(part.max(axis=1) > 0, part.argmax(axis=1) + 1, 0)
        return out

    def bins_of(self, indices: pd.Series, values: pd.Series) -> np.ndarray:
        """``bins`` of vectors as they are stored: only entries are read, so wide groups cost nothing."""
        row, index, value = entries(indices, values)
        out = np.zeros((len(values), len(self.slots) + len(self.groups)), dtype=self.kind)
        for c, (s, b) in enumerate(zip(self.slots, self.borders)):
            at, x = index == s, np.zeros(len(values))
            x[row[at]] = value[at]
            out[:, c] = np.searchsorted(np.asarray(b), x, side="left")
        for c, (a, z) in enumerate(self.groups, len(self.slots)):
            at = np.flatnonzero((index >= a) & (index < z) & (value > 0))
            at = at[np.lexsort((-index[at], value[at]))]        # the greatest is written last, the first of equals
            out[row[at], c] = index[at] - a + 1
        return out

    @property
    def kind(self) -> type:
        """Of the bins: groups of more than 65,535 indicators need more than two bytes."""
        return np.uint16 if max([0, *[z - a for a, z in self.groups]]) < 1 << 16 else np.uint32

    @property
    def grouped(self) -> np.ndarray:
        return np.arange(len(self.slots) + len(self.groups)) >= len(self.slots)

    def slot(self, column: int, code: int) -> int:
        """The feature that a split of this column tests."""
        return self.slots[column] if column < len(self.slots) else self.groups[column - len(self.slots)][0] + code - 1


@dataclass(frozen=True)
class Job:
    """One ensemble to grow: rows of ``fold`` are left out of its growth."""
    name: str
    trees: int
    fold: int = -1
    leaf: int = 1
    depth: int | None = None
    bootstrap: bool = True
    seed: int = RANDOM_STATE
    rate: float | None = None       # trees are boosted with it instead of averaged
    step: int = BLOCK_TREES         # trees a task grows from one copy of its rows

    @property
    def block(self) -> int:
        return self.trees if self.rate else self.step

    @property
    def divisor(self) -> int:
        return 1 if self.rate else self.trees


@dataclass
class Tree:
    """Nodes in order of creation; ``column`` -1 marks a leaf. ``top`` trees have open nodes, finished elsewhere."""
    column: list = field(default_factory=list)
    code: list = field(default_factory=list)
    left: list = field(default_factory=list)        # the right child is the next one
    value: list = field(default_factory=list)
    depth: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    heft: list = field(default_factory=list)

    def add(self, value: float, depth: int, heft: float = 0.0) -> int:
        for xs, x in ((self.column, -1), (self.code, 0), (self.left, -1), (self.value, value), (self.depth, depth), (self.gain, 0.0), (self.heft, heft)):
            xs.append(x)
        return len(self.value) - 1


def weights(job_seed: int, tree: int, ids: np.ndarray) -> np.ndarray:
    """Poisson(1) numbers of (seed, tree, id): how often a bootstrap sample holds each row."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((job_seed * 1_000_003 + tree * 7_919 + 1) % (1 << 63))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    p = np.exp(-1.0)
    steps = np.cumsum([p / f for f in np.cumprod([1, *range(1, 18)])])
    return np.searchsorted(steps, u, side="right").astype(np.float64)


# ------------------------------------------------------- growing in a task --

class _Grown:
    """Nodes of a growing tree over at most ``rows`` rows, as arrays; the right child of a node is the one after its left one."""

    def __init__(self, rows: int, value: float, heft: float, start: int):
        n = max(1, 2 * rows - 1)
        self.column, self.code, self.left = np.full(n, -1, np.int16), np.zeros(n, np.int32), np.full(n, -1, np.int32)
        self.value, self.depth, self.gain, self.heft = np.zeros(n), np.full(n, start, np.int16), np.zeros(n), np.zeros(n)
        self.value[0], self.heft[0], self.n = value, heft, 1

    def split(self, nodes, column, code, gain, wl, yl, wr, yr) -> np.ndarray:
        """The children, left and right of each node in turn."""
        left = self.n + 2 * np.arange(len(nodes))
        self.n += 2 * len(nodes)
        self.column[nodes], self.code[nodes], self.gain[nodes], self.left[nodes] = column, code, gain, left
        self.value[left], self.value[left + 1], self.heft[left], self.heft[left + 1] = yl / wl, yr / wr, wl, wr
        self.depth[left] = self.depth[left + 1] = self.depth[nodes] + 1
        return np.column_stack([left, left + 1]).ravel()

    def arrays(self) -> tuple[np.ndarray, ...]:
        """In the order of the fields of ``Tree``, level by level."""
        levels = [np.zeros(1, np.int64)]
        while len(levels[-1]):
            inner = levels[-1][self.column[levels[-1]] >= 0]
            levels.append(np.column_stack([self.left[inner], self.left[inner] + 1]).ravel().astype(np.int64))
        at = np.concatenate(levels)
        column, left = self.column[at], np.full(len(at), -1, np.int32)
        inner = np.flatnonzero(column >= 0)
        left[inner] = 1 + 2 * np.arange(len(inner))
        return column, self.code[at], left, self.value[at], self.depth[at], self.gain[at], self.heft[at]


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, grouped: np.ndarray, leaf: int = 1, depth: int | None = None, start: int = 0) -> tuple[np.ndarray, ...]:
    """The tree over rows of weight > 0, as arrays in the order of the fields of ``Tree``. ``start`` is the depth of its root.

    Nodes of many rows keep their sums per bin: only a split's smaller side is summed, the larger has what is left, so splitting
    a few rows off a large node costs little however often it happens. Nodes of few rows are finished from sorted positions.
    Sums of labels as ``chunked`` makes them are exact, so both ways choose the same splits. Ties go to the first
    column, then to the smallest bin."""
    rows = np.flatnonzero(w > 0)
    bins, w, wy = np.ascontiguousarray(bins[rows].T), w[rows], (w * y)[rows]
    m = len(rows)
    out = _Grown(m, wy.sum() / w.sum() if m else 0.0, w.sum(), start)
    if m > 1:
        held: list = []
        for nodes, sizes, members in _by_sums(out, bins, w, wy, grouped, leaf, depth):
            ends = np.cumsum(sizes)
            # whole nodes, about ``ORDERED`` rows at a time
            cuts = np.flatnonzero(np.diff(ends // ORDERED, prepend=0))
            for a, z in zip([0, *cuts + 1], [*cuts + 1, len(nodes)]):
                if a < z:
                    held.append((nodes[a:z], sizes[a:z], members[(ends[a] - sizes[a]):ends[z - 1]]))
                if sum(len(h[2]) for h in held) >= ORDERED:
                    _by_order(out, bins, w, wy, grouped, leaf, depth, *map(np.concatenate, zip(*held)))
                    held = []
        if held:
            _by_order(out, bins, w, wy, grouped, leaf, depth, *map(np.concatenate, zip(*held)))
    return out.arrays()


def _members(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the run, place) of all places of runs of n places from ``first`` on."""
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) + np.repeat(first - np.cumsum(n) + n, n)


def _gains(wl, yl, tw, ty, leaf: int, may=True):
    """What a split leaves of the squares' sum, -1 where a side has too little weight."""
    wr, yr = tw - wl, ty - yl
    with np.errstate(divide="ignore", invalid="ignore"):
        yr *= yr
        yr /= wr
        yr += yl * yl / wl
    yr[~((wl >= leaf) & (wr >= leaf) & may)] = -1.0
    return yr


def _by_sums(out: _Grown, bins: np.ndarray, w: np.ndarray, wy: np.ndarray, grouped: np.ndarray, leaf: int, depth: int | None):
    """Splits the root and all nodes below it that have many rows, level by level; yields (nodes, rows of each, these rows) of
    those with fewer that may still be split.

    Columns of few bins are arrays (node, column, bin); a wide group is a list of (node, code) that rows hold."""
    c, m = bins.shape
    widths = bins.max(axis=1).astype(np.int64) + 1
    near = np.flatnonzero(~grouped | (widths <= MAX_BINS))
    near = near[np.argsort(grouped[near], kind="stable")]
    ordered, bin_n = int((~grouped[near]).sum()), int(widths[near].max(initial=1))
    wide = np.setdiff1d(np.arange(c), near)
    cells = max(1, len(near) * bin_n)
    few, step = max(FEW_ROWS, cells // 32), max(1, CELLS // 8 // cells)
    order, sizes, ids = np.arange(m), np.array([m]), np.zeros(1, np.int64)
    if m <= few:
        yield ids, sizes, order
        return
    wyy = wy * wy / w
    tw, ty = np.array([w.sum()]), np.array([wy.sum()])
    squares = np.array([wyy.sum()]) - ty ** 2 / tw

    def sums(which: np.ndarray, n: int, rows: np.ndarray) -> np.ndarray:
        """(2, n, column, bin): weights and labels of n sets of rows."""
        own = np.empty((2, n, len(near), bin_n))
        weight, label, base = w[rows], wy[rows], which * bin_n
        for j, col in enumerate(near):
            key = base + bins[col, rows]
            own[0, :, j] = np.bincount(key, weight, n * bin_n).reshape(n, bin_n)
            own[1, :, j] = np.bincount(key, label, n * bin_n).reshape(n, bin_n)
        return own

    def listed(col: int, which: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """(set, code, weight, label, rows), ascending."""
        key, back, n = np.unique(which * widths[col] + bins[col, rows], return_inverse=True, return_counts=True)
        return key // widths[col], key % widths[col], np.bincount(back, w[rows], len(key)), np.bincount(back, wy[rows], len(key)), n

    h = sums(np.zeros(m, np.int64), 1, order)
    lists = {col: listed(col, np.zeros(m, np.int64), order) for col in wide}
    level = int(out.depth[0])
    while len(ids) and (depth is None or level < depth):
        k = len(ids)
        highest, code, wl, yl = np.full((k, c), -1.0), np.zeros((k, c), np.int64), np.zeros((k, c)), np.zeros((k, c))
        for a in range(0, k if len(near) else 0, step):
            z = min(k, a + step)
            part = h[:, a:z].copy()
            np.cumsum(part[:, :, :ordered], axis=3, out=part[:, :, :ordered])
            may = np.ones((1, len(near), bin_n), dtype=bool)
            may[0, ordered:, 0] = False         # one code against all others
            gain = _gains(part[0], part[1], tw[a:z, None, None], ty[a:z, None, None], leaf, may)
            at = gain.argmax(axis=2)
            for into, x in ((highest, gain), (wl, part[0]), (yl, part[1])):
                into[a:z, near] = np.take_along_axis(x, at[:, :, None], axis=2)[:, :, 0]
            code[a:z, near] = at
        for col, (node, codes, ow, oy, _) in lists.items():
            gain = _gains(ow, oy, tw[node], ty[node], leaf, codes > 0)
            highest[:, col] = np.maximum.reduceat(gain, np.searchsorted(node, np.arange(k)))
            at = np.flatnonzero(gain == highest[node, col])
            at = at[np.diff(node[at], prepend=-1) > 0]
            code[:, col], wl[:, col], yl[:, col] = codes[at], ow[at], oy[at]
        column = highest.argmax(axis=1)
        most, code, wl, yl = (x[np.arange(k), column] for x in (highest, code, wl, yl))
        gain = most - ty ** 2 / tw
        p = np.flatnonzero((most >= 0) & (gain > LEAST_GAIN * np.maximum(squares, 1e-300)))
        if not len(p):
            break
        wr, yr = tw[p] - wl[p], ty[p] - yl[p]
        children = out.split(ids[p], column[p], code[p], gain[p], wl[p], yl[p], wr, yr)
        level += 1
        # rows of a node that go left stand before the others
        seg, at = _members((np.cumsum(sizes) - sizes)[p], sizes[p])
        order, n = order[at], sizes[p]
        tested = bins[column[p][seg], order]
        goes_left = np.where(grouped[column[p]][seg], tested == code[p][seg], tested <= code[p][seg])
        first = np.cumsum(n) - n
        upto = np.cumsum(goes_left)
        lefts = np.diff(upto[first + n - 1], prepend=0)
        rank = upto - (np.cumsum(lefts) - lefts)[seg]
        moved = np.empty_like(order)
        moved[np.where(goes_left, first[seg] + rank - 1, lefts[seg] + np.arange(len(order)) - rank)] = order
        order = moved
        sizes, tw, ty = (np.column_stack(x).ravel() for x in ((lefts, n - lefts), (wl[p], wr), (yl[p], yr)))
        first = np.cumsum(sizes) - sizes
        squares = np.add.reduceat(wyy[order], first) - ty ** 2 / tw
        can = (sizes > 1) & (tw >= 2 * leaf) & (squares > 0)
        big = can & (sizes > few)
        little = np.flatnonzero(can & ~big)
        if len(little):
            yield children[little], sizes[little], order[_members(first[little], sizes[little])[1]]
        # of the parents of large nodes the smaller child is summed
        q = np.flatnonzero(big.reshape(-1, 2).any(axis=1))
        minor = 2 * q + (sizes[2 * q + 1] < sizes[2 * q])
        major = minor ^ 1
        keep, new = big[major], big[minor]
        to_major, to_minor = np.cumsum(keep) - 1, keep.sum() + np.cumsum(new) - 1
        after = np.empty((2, int(keep.sum() + new.sum()), len(near), bin_n))
        for a in range(0, len(q), step):
            own = slice(a, a + step)
            which, at = _members(first[minor[own]], sizes[minor[own]])
            less = sums(which, len(q[own]), order[at])
            after[:, to_minor[own][new[own]]] = less[:, new[own]]
            after[:, to_major[own][keep[own]]] = h[:, p[q[own][keep[own]]]] - less[:, keep[own]]
        h = after
        which, at = _members(first[minor], sizes[minor])
        goes_to = np.full(k, -1)
        goes_to[p[q[keep]]] = to_major[keep]
        for col in wide:
            node, codes, ow, oy, on = lists[col]
            s, sc, sw, sy, sn = listed(col, which, order[at])
            there = np.searchsorted(node * widths[col] + codes, p[q[s]] * widths[col] + sc)
            ow[there] -= sw
            oy[there] -= sy
            on[there] -= sn
            stay, fresh = (goes_to[node] >= 0) & (on > 0), new[s]
            lists[col] = tuple(np.concatenate(x) for x in (
                (goes_to[node[stay]], to_minor[s[fresh]]), (codes[stay], sc[fresh]), (ow[stay], sw[fresh]), (oy[stay], sy[fresh]), (on[stay], sn[fresh])))
        chosen = np.concatenate([major[keep], minor[new]])
        order = order[_members(first[chosen], sizes[chosen])[1]]
        ids, sizes, tw, ty, squares = (x[chosen] for x in (children, sizes, tw, ty, squares))


def _by_order(out: _Grown, bins: np.ndarray, w: np.ndarray, wy: np.ndarray, grouped: np.ndarray, leaf: int, depth: int | None,
              ids: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> None:
    """Finishes the trees below these nodes, whose ``rows`` stand one node after the other, level by level.

    Rows stand in one order per column, by node and bin; sums up to each position are all
    that a split needs."""
    some = out.depth[ids] < (np.inf if depth is None else depth)
    rows, ids, sizes = rows[np.repeat(some, sizes)], ids[some], sizes[some]
    if not len(ids):
        return
    bins, w, wy = bins[:, rows], w[rows], wy[rows]
    c, m = bins.shape
    all_bins, offset = bins.ravel(), (np.arange(c) * m)[:, None]
    seg = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(bins, axis=1, kind="stable")
    kind = np.uint16 if len(ids) < 1 << 16 else np.int64
    order = np.take_along_axis(order, np.argsort(seg.astype(kind)[order], axis=1, kind="stable"), axis=1)
    first = np.cumsum(sizes) - sizes
    squares = np.add.reduceat(wy * wy / w, first) - np.add.reduceat(wy, first) ** 2 / np.add.reduceat(w, first)
    while len(ids):
        first = np.cumsum(sizes) - sizes
        seg = np.repeat(np.arange(len(ids)), sizes)
        ends = first + sizes - 1
        # what stands before a node, and its totals, are the same in every column
        upto_w, upto_y = np.cumsum(w[order[0]])[ends], np.cumsum(wy[order[0]])[ends]
        w0, y0 = (np.concatenate([[0.0], x[:-1]]) for x in (upto_w, upto_y))
        total_w, total_y = upto_w - w0, upto_y - y0
        # columns are searched a few at a time; of equals the first stays
        blocks = [slice(a, a + max(1, CELLS // m)) for a in range(0, c, max(1, CELLS // m))]
        highest, column, code = np.full(len(ids), -1.0), np.zeros(len(ids), np.int64), np.zeros(len(ids), bins.dtype)
        wl, yl = np.zeros(len(ids)), np.zeros(len(ids))
        for block in blocks:
            these = order[block]
            b = all_bins[these + offset[block]]
            left_w, left_y = np.cumsum(w[these], axis=1), np.cumsum(wy[these], axis=1)
            left_w -= w0[seg]
            left_y -= y0[seg]
            edge = np.ones(b.shape, dtype=bool)        # the last place of a bin in its node
            np.not_equal(b[:, 1:], b[:, :-1], out=edge[:, :-1])
            edge[:, ends] = True
            for g in np.flatnonzero(grouped[block]):          # one code against all others
                at = np.flatnonzero(edge[g])
                own_w, own_y = left_w[g, at].copy(), left_y[g, at].copy()
                follows = seg[at[1:]] == seg[at[:-1]]
                own_w[1:] -= np.where(follows, left_w[g, at[:-1]], 0.0)
                own_y[1:] -= np.where(follows, left_y[g, at[:-1]], 0.0)
                left_w[g, at], left_y[g, at] = own_w, own_y
                edge[g, at] = b[g, at] > 0
            # squares of the children; what the node itself has is taken off its best
            gain = _gains(left_w, left_y, total_w[seg], total_y[seg], leaf, edge)
            best = np.maximum.reduceat(gain, first, axis=1)
            top = best.argmax(axis=0)
            most = best[top, np.arange(len(ids))]
            better = most > highest
            place = np.flatnonzero(better[seg] & (gain[top[seg], np.arange(len(seg))] == most[seg]))
            _, where = np.unique(seg[place], return_index=True)
            at, top = place[where], top[better]
            highest[better], column[better], code[better] = most[better], block.start + top, b[top, at]
            wl[better], yl[better] = left_w[top, at], left_y[top, at]
        most = highest - total_y ** 2 / total_w
        split = (highest >= 0) & (most > LEAST_GAIN * np.maximum(squares, 1e-300))
        if not split.any():
            return
        children = out.split(ids[split], column[split], code[split], most[split], wl[split], yl[split], (total_w - wl)[split], (total_y - yl)[split])
        if not split.all():
            order, seg = order[:, split[seg]], (np.cumsum(split) - 1)[seg[split[seg]]]
            column, code, sizes = column[split], code[split], sizes[split]
            first = np.cumsum(sizes) - sizes
            ends = first + sizes - 1
        here = order[0]
        tested = bins[column[seg], here]
        goes_left = np.empty(m, dtype=bool)
        goes_left[here] = np.where(grouped[column[seg]], tested == code[seg], tested <= code[seg])
        lefts = np.diff(np.cumsum(goes_left[here])[ends], prepend=0)        # rows that go left, per node
        # in every column the rows of left children stand first, then those of right ones, each as they were
        sizes = np.column_stack([lefts, sizes - lefts]).ravel()
        starts = np.cumsum(sizes) - sizes
        yw, ww = wy[here], w[here]
        fresh = np.empty_like(order)
        to_left, to_right = starts[::2][seg], starts[1::2][seg]
        before, count_ = (np.cumsum(lefts) - lefts)[seg], np.arange(len(seg)) - first[seg]
        for block in blocks:
            side = goes_left[order[block]]
            rank = np.cumsum(side, axis=1)
            rank -= before
            np.put_along_axis(fresh[block], np.where(side, to_left - 1 + rank, to_right + count_ - rank), order[block], axis=1)
        order = fresh
        yw, ww = wy[order[0]], w[order[0]]
        squares = np.add.reduceat(yw * yw / ww, starts) - np.add.reduceat(yw, starts) ** 2 / np.add.reduceat(ww, starts)
        # nodes that cannot be split any more leave
        can = (sizes > 1) & (np.add.reduceat(ww, starts) >= 2 * leaf) & (squares > 0)
        if depth is not None:
            can &= out.depth[children] < depth
        if not can.all():
            order = order[:, np.repeat(can, sizes)]
        ids, sizes, squares = children[can], sizes[can], squares[can]


def walk(tree: tuple, bins: np.ndarray, grouped: np.ndarray, cuts: tuple = ((None, 0),)) -> np.ndarray:
    """Cuts x rows: means of the nodes that rows reach, no further than each cut (depth, weight): a node at
    that depth or of less weight isn't passed, as if its tree had been grown with these limits."""
    column, code, left, value, depth, _, heft = tree
    at, moving = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
    out, open_ = np.empty((len(cuts), len(bins))), np.ones((len(cuts), len(bins)), dtype=bool)
    while len(moving):
        n = at[moving]
        ends = column[n] < 0
        for i, (most, least) in enumerate(cuts):
            stop = ends | (heft[n] < least)
            if most is not None:
                stop |= depth[n] >= most
            now = moving[stop & open_[i, moving]]
            out[i, now], open_[i, now] = value[at[now]], False
        moving = moving[~ends]
        n = at[moving]
        tested = bins[moving, column[n]]
        at[moving] = left[n] + 1 - np.where(grouped[column[n]], tested == code[n], tested <= code[n])
    return out


def boost(bins: np.ndarray, y: np.ndarray, w: np.ndarray, grouped: np.ndarray, job: "Job") -> list[tuple]:
    """Trees that add up: the mean, then ``job.trees`` trees on what is left, each shrunk by the rate."""
    base = float((w * y).sum() / w.sum()) if (w > 0).any() else 0.0
    out, left = [grow(bins[:0], y[:0], w[:0], grouped)], y - base
    out[0][3][0] = base
    grain = grain_of(float(np.abs(left).max(initial=0.0)))
    for _ in range(job.trees):
        tree = grow(bins, np.round(left / grain) * grain, w, grouped, job.leaf, job.depth)
        tree = (*tree[:3], tree[3] * job.rate, *tree[4:])
        left = left - walk(tree, bins, grouped)[0]
        out.append(tree)
    return out


# ------------------------------------------------------------------ binning --

def columns_of(preprocessor: PipelineModel, feats: DataFrame, features: str = "features") -> Columns:
    """Slots and groups from the last assembler: what a drop-first encoder sliced is one group."""
    stages = preprocessor.stages
    sliced = {s.getOutputCol(): len(s.getIndices()) for s in stages if isinstance(s, VectorSlicer)}
    last = stages[-1]
    slots, groups, at = [], [], 0
    if isinstance(last, VectorAssembler) and all(c in sliced or feats.schema[c].dataType.typeName() != "vector" for c in last.getInputCols() if c in feats.columns):
        for c in last.getInputCols():
            if c in sliced:
                groups.append((at, at + sliced[c]))
            else:
                slots.append(at)
            at += sliced.get(c, 1)
    else:
        row = feats.select(length(features).alias("n")).first()
        slots = list(range(row["n"] if row else 0))
    arr = feats.select(*[slot(features, s).alias(f"s{s}") for s in slots])
    probs = [i / MAX_BINS for i in range(1, MAX_BINS)]
    borders = arr.approxQuantile(arr.columns, probs, RANK_ERROR) if slots else []
    return Columns(tuple(slots), tuple(tuple(sorted(set(b))) for b in borders), tuple(groups))


def grain_of(largest: float) -> float:
    return 2.0 ** (np.ceil(np.log2(largest)) - LABEL_BITS) if largest > 0 else 1.0


def chunked(feats: DataFrame, columns: Columns, id_col: str, label: str | None, fold: str | None = None, features: str = "features") -> DataFrame:
    """(chunk, n, rows): packed row ids, labels, folds and bins, ``CHUNK_ROWS`` a row. Labels are rounded to
    ``LABEL_BITS`` bits of the largest: sums over millions of rows stay exact, so ties are ties in any order of addition."""
    y = F.col(label).cast("double") if label else F.lit(0.0)
    if label:
        grain = grain_of(feats.agg(F.max(F.abs(y))).first()[0] or 0.0)
        y = F.round(y / F.lit(grain)) * F.lit(grain)
    at, values = stored(features)
    picked = feats.select(F.col(id_col).cast("long").alias("i"), y.alias("y"),
                          (F.col(fold) if fold else F.lit(-2)).cast("int").alias("f"), at.alias("at"), values.alias("x"))

    def pack(batches):
        held, n, chunk = [], 0, 0
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()

        def packed():
            ids, y, f, b = (np.concatenate(c) for c in zip(*held))
            return pd.DataFrame({"chunk": [part * (1 << 32) + chunk], "n": [len(ids)], "rows": [pickle.dumps((ids, y, f, b))]})
        for batch in batches:
            if len(batch):
                held.append((batch["i"].to_numpy(np.int64), batch["y"].to_numpy(np.float64), batch["f"].to_numpy(np.int32), columns.bins_of(batch["at"], batch["x"])))
                n += len(batch)
            if n >= CHUNK_ROWS:
                yield packed()
                held, n, chunk = [], 0, chunk + 1
        if n:
            yield packed()
    return picked.mapInPandas(pack, "chunk long, n long, rows binary")


def written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _together(parts) -> tuple[np.ndarray, ...]:
    """Rows of several packed chunks, in order of their ids."""
    ids, y, f, b = (np.concatenate(c) for c in zip(*[pickle.loads(p) for p in parts]))
    order = np.argsort(ids, kind="stable")
    return ids[order], y[order], f[order], b[order]


# ---------------------------------------------------------- growing in Spark --

def _route(tree: Tree, bins: np.ndarray, grouped: np.ndarray) -> np.ndarray:
    """Open or leaf node of a top that each row reaches."""
    column, code, left = (np.array(x) for x in (tree.column, tree.code, tree.left))
    at = np.zeros(len(bins), dtype=np.int64)
    while (go := np.flatnonzero(column[at] >= 0)).size:
        n = at[go]
        tested = bins[go, column[n]]
        at[go] = left[n] + 1 - np.where(grouped[column[n]], tested == code[n], tested <= code[n])
    return at


def _sums_by_bin(bins: np.ndarray, place: np.ndarray, n: int, w: np.ndarray, y: np.ndarray):
    """(place, column, bins, weights, sums, rows): what the rows of each place 0 .. n - 1 have in the bins that they hold."""
    for c in range(bins.shape[1]):
        width = int(bins[:, c].max(initial=0)) + 1
        key = place * width + bins[:, c]
        if n * width <= 4 * len(key):
            rows = np.bincount(key, minlength=n * width)
            at = np.flatnonzero(rows)
            rows, sw, sy = rows[at], np.bincount(key, w, n * width)[at], np.bincount(key, w * y, n * width)[at]
        else:
            at, back, rows = np.unique(key, return_inverse=True, return_counts=True)
            sw, sy = np.bincount(back, w, len(at)), np.bincount(back, w * y, len(at))
        ends = np.searchsorted(at, np.arange(n + 1) * width)
        for p in range(n):
            own = slice(ends[p], ends[p + 1])
            yield p, c, (at[own] - p * width, sw[own], sy[own], rows[own])


def _merged(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    """(bins, weights, sums, rows) of one column, bins ascending and each once."""
    if len(parts) == 1:
        return parts[0]
    code, w, y, rows = (np.concatenate(x) for x in zip(*parts))
    at, back = np.unique(code, return_inverse=True)
    return at, np.bincount(back, w, len(at)), np.bincount(back, y, len(at)), np.bincount(back, rows, len(at))


def _best_split(sums: list[tuple], grouped: np.ndarray, leaf: int) -> tuple:
    """(column, code, gain, left and right weight, sum, rows) of the best split; per column (bins, weights, sums, rows)."""
    best, highest = (-1, 0, 0.0, *[0.0] * 6), -1.0
    for c, (code, *own) in enumerate(sums):
        h = np.column_stack(own).astype(np.float64)
        total = h.sum(axis=0)
        lefts = h if grouped[c] else np.cumsum(h, axis=0)
        rights = total - lefts
        may = (lefts[:, 0] >= leaf) & (rights[:, 0] >= leaf) & (rights[:, 2] > 0)
        if grouped[c]:
            may &= code > 0
        at = np.flatnonzero(may)
        if not len(at):
            continue
        squares = lefts[at, 1] * lefts[at, 1] / lefts[at, 0] + rights[at, 1] * rights[at, 1] / rights[at, 0]
        i = at[squares.argmax()]
        if squares.max() > highest:
            highest = float(squares.max())
            best = (c, int(code[i]), highest - float(total[1]) ** 2 / float(total[0]), *map(float, lefts[i]), *map(float, rights[i]))
    return best


def _splits(chunks: DataFrame, jobs: list[Job], wanted: dict, held: dict, grouped: np.ndarray, left: list[tuple] = (), grain: float | None = None) -> list:
    """One row per node of ``wanted``, {(job, tree): its nodes}: its best split, mean, weight and sum of squares.

    One pass sums weights, labels and rows per (tree, node, column, bin) that rows hold; sums meet in two steps, and
    a split per node comes to the driver. With a grain, labels are what the trees of ``left`` leave of them, in steps of it."""
    c = len(grouped)

    def sums(batches):
        from pyspark import TaskContext
        part, parts, squares, n_held = TaskContext.get().partitionId() % 32, defaultdict(list), defaultdict(float), 0

        def told():
            for (j, t, n) in list(squares):
                own = [_merged(parts[j, t, n, col]) for col in range(c)]
                yield pd.DataFrame({"j": [j], "t": [t], "n": [n], "part": [part], "h": [pickle.dumps((own, squares[j, t, n]))]})
            parts.clear()
            squares.clear()
        for batch in batches:
            for blob in batch["rows"]:
                ids, y, f, b = pickle.loads(blob)
                if grain is not None:
                    for tree in left:
                        y = y - walk(tree, b, grouped)[0]
                    y = np.round(y / grain) * grain
                for (j, t), nodes in wanted.items():
                    w = (weights(jobs[j].seed, t, ids) if jobs[j].bootstrap else np.ones(len(ids))) * (f != jobs[j].fold)
                    at = _route(held[j, t], b, grouped)
                    number = np.full(len(held[j, t].column), -1)
                    number[nodes] = np.arange(len(nodes))
                    r = np.flatnonzero((number[at] >= 0) & (w > 0))
                    place = number[at[r]]
                    for p, s in enumerate(np.bincount(place, w[r] * y[r] * y[r], len(nodes))):
                        squares[j, t, nodes[p]] += float(s)
                    for p, col, own in _sums_by_bin(b[r], place, len(nodes), w[r], y[r]):
                        parts[j, t, nodes[p], col].append(own)
                        n_held += len(own[0])
                    if n_held > HELD:
                        yield from told()
                        n_held = 0
        yield from told()

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        blobs = [pickle.loads(x) for x in rows["h"]]
        own = [_merged([s[col] for s, _ in blobs]) for col in range(c)]
        return rows.iloc[:1].assign(h=[pickle.dumps((own, sum(x for _, x in blobs)))])

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        j, t, n = (int(rows[k].iloc[0]) for k in "jtn")
        blobs = [pickle.loads(x) for x in rows["h"]]
        total = [_merged([s[col] for s, _ in blobs]) for col in range(c)]
        w, y, m = (float(x.sum()) for x in total[0][1:])
        squares = sum(x for _, x in blobs) - y * y / w if w else 0.0
        return pd.DataFrame([(j, t, n, *_best_split(total, grouped, jobs[j].leaf), y / w if w else 0.0, w, squares)], columns=["j", "t", "n", "col", "code", "gain", "lw", "ly", "lr", "rw", "ry", "rr", "mean", "heft", "squares"])

    summed = chunks.select("rows").mapInPandas(sums, "j int, t int, n int, part int, h binary")
    if sum(map(len, wanted.values())) * c < TWICE:
        # few nodes: what each task has of them is little
        summed = summed.groupBy("j", "t", "n", "part").applyInPandas(add, "j int, t int, n int, part int, h binary")
    found = summed.groupBy("j", "t", "n").applyInPandas(choose, "j int, t int, n int, col int, code int, gain double, lw double, ly double, lr double, rw double, ry double, rr double, mean double, heft double, squares double")
    return sorted(found.collect(), key=lambda r: (r["j"], r["t"], r["n"]))       # one row a node


def grow_tops(chunks: DataFrame, jobs: list[Job], grouped: np.ndarray) -> dict[tuple[int, int], Tree]:
    """{(job, tree): its nodes of more than ``TASK_ROWS`` rows, split, and the open nodes below them}; up to ``WAVE`` nodes a pass."""
    folds = _rows_by_fold(chunks)
    rows_of = [sum(n for f, n in folds.items() if f != job.fold) for job in jobs]
    tops = {}
    for j, job in enumerate(jobs):
        if job.rate and rows_of[j] > TASK_ROWS:
            raise ValueError(f"boosting in a task takes at most {TASK_ROWS} rows")
        for t in range(job.trees):
            tops[j, t] = Tree()
            tops[j, t].add(0.0, 0)
    frontier = [(j, t, 0) for (j, t) in tops if rows_of[j] > TASK_ROWS]
    while frontier:
        wave, frontier = frontier[:WAVE], frontier[WAVE:]
        wanted = defaultdict(list)
        for j, t, n in wave:
            wanted[j, t].append(n)
        for r in _splits(chunks, jobs, wanted, {k: tops[k] for k in wanted}, grouped):
            job, tree, n = jobs[r["j"]], tops[r["j"], r["t"]], r["n"]
            tree.value[n], tree.heft[n] = r["mean"], r["heft"]
            if r["col"] < 0 or r["gain"] <= 0 or (job.depth is not None and tree.depth[n] >= job.depth):
                continue
            _split(tree, n, r)
            for side, rows in ((0, r["lr"]), (1, r["rr"])):
                if rows > TASK_ROWS:
                    frontier.append((r["j"], r["t"], tree.left[n] + side))
    return tops


def _split(tree: Tree, n: int, r) -> None:
    tree.column[n], tree.code[n], tree.gain[n] = r["col"], r["code"], r["gain"]
    tree.left[n] = tree.add(r["ly"] / r["lw"], tree.depth[n] + 1, r["lw"])
    tree.add(r["ry"] / r["rw"], tree.depth[n] + 1, r["rw"])


def boost_in_passes(chunks: DataFrame, job: Job, grouped: np.ndarray) -> list[tuple]:
    """``boost`` over rows that no task holds: a level of a tree is a pass over the chunks, which sum what the trees before
    leave of their labels. What is left is written every ``REWRITE`` trees. The driver holds the trees and one split per node."""
    def ends(batches):
        for batch in batches:
            for blob in batch["rows"]:
                ids, y, f, b = pickle.loads(blob)
                w = f != job.fold
                yield pd.DataFrame({"w": [float(w.sum())], "y": [float(y[w].sum())], "least": [float(y.min())], "most": [float(y.max())]})
    whole = chunks.select("rows").mapInPandas(ends, "w double, y double, least double, most double") \
                  .agg(F.sum("w").alias("w"), F.sum("y").alias("y"), F.min("least").alias("least"), F.max("most").alias("most")).first()
    none, free = np.empty(0), np.empty((0, len(grouped)), dtype=np.uint16)
    out = [grow(free, none, none, grouped)]
    out[0][3][0] = base = whole["y"] / whole["w"] if whole["w"] else 0.0
    grain = grain_of(max(abs(whole["least"] - base), abs(whole["most"] - base)))
    rows, left = chunks.select("rows"), out[:1]
    flat = replace(job, bootstrap=False)
    for number in range(job.trees):
        tree, level = Tree(), [0]
        tree.add(0.0, 0)
        while level:
            below = []
            for a in range(0, len(level), WAVE):
                for r in _splits(rows, [flat], {(0, 0): level[a:a + WAVE]}, {(0, 0): tree}, grouped, left, grain):
                    n = r["n"]
                    if n == 0:
                        tree.value[0], tree.heft[0] = r["mean"], r["heft"]
                    elif r["squares"] <= 0:
                        continue
                    if r["col"] >= 0 and r["gain"] > LEAST_GAIN * max(r["squares"], 1e-300):
                        _split(tree, n, r)
                        below += [tree.left[n] + side for side, w, m in ((0, r["lw"], r["lr"]), (1, r["rw"], r["rr"])) if m > 1 and w >= 2 * job.leaf]
            level = below if job.depth is None or (below and tree.depth[below[0]] < job.depth) else []
        out.append((np.array(tree.column, np.int16), np.array(tree.code, np.int32), np.array(tree.left, np.int32), np.array(tree.value) * job.rate,
                    np.array(tree.depth, np.int16), np.array(tree.gain), np.array(tree.heft)))
        left = [*left, out[-1]]
        if len(left) >= REWRITE and number + 1 < job.trees:
            rows, left = written(_left_of(rows, left, grouped), "boosted-rows"), []
    return out


def _left_of(rows: DataFrame, trees: list[tuple], grouped: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            for blob in batch["rows"]:
                ids, y, f, b = pickle.loads(blob)
                for tree in trees:
                    y = y - walk(tree, b, grouped)[0]
                yield pd.DataFrame({"rows": [pickle.dumps((ids, y, f, b))]})
    return rows.mapInPandas(run, "rows binary")


def _rows_by_fold(chunks: DataFrame) -> dict[int, int]:
    return {r["f"]: r["n"] for r in chunks.select("rows", "n").mapInPandas(_fold_sizes, "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()}


def _fold_sizes(batches):
    for batch in batches:
        out = defaultdict(int)
        for blob in batch["rows"]:
            for f, n in zip(*np.unique(pickle.loads(blob)[2], return_counts=True)):
                out[int(f)] += int(n)
        yield pd.DataFrame({"f": list(out), "n": list(out.values())})


def _payload(chunks: DataFrame, jobs: list[Job], tops: dict, grouped: np.ndarray, all_rows: bool = False) -> DataFrame:
    """(job, tree, last, node, chunk, rows): each chunk's rows for every block of whole trees, or for every open
    node of a tree that has a top."""
    whole = [(j, a, min(a + job.block, job.trees)) for j, job in enumerate(jobs) for a in range(0, job.trees, job.block)
             if all(tops[j, t].column[0] < 0 for t in range(a, min(a + job.block, job.trees)))]
    covered = {(j, t) for j, a, z in whole for t in range(a, z)}
    cut = {k: tree for k, tree in tops.items() if k not in covered}
    spark = chunks.sparkSession
    schema = "job int, tree int, last int, node int, chunk long, rows binary"
    out = None
    if whole:
        blocks = spark.createDataFrame(whole, "job int, tree int, last int")
        # a chunk is copied once a block; explode on a literal list keeps the join out
        listed = F.array(*[F.struct(*[F.lit(v).cast("int").alias(k) for k, v in zip(("job", "tree", "last"), b)]) for b in whole]) if len(whole) <= 64 else None
        if listed is not None:
            out = chunks.select("chunk", "rows", F.explode(listed).alias("b")).select("b.*", F.lit(0).alias("node"), "chunk", "rows")
        else:
            out = chunks.withColumn("one", F.lit(1)).join(F.broadcast(blocks.withColumn("one", F.lit(1))), "one").select("job", "tree", "last", F.lit(0).alias("node"), "chunk", "rows")
    if cut:
        def route(batches):
            for batch in batches:
                for chunk, blob in zip(batch["chunk"], batch["rows"]):
                    ids, y, f, b = pickle.loads(blob)
                    for (j, t), tree in cut.items():
                        at = _route(tree, b, grouped)
                        for n in np.unique(at):
                            r = at == n
                            yield pd.DataFrame({"job": [j], "tree": [t], "last": [t + 1], "node": [int(n)], "chunk": [chunk], "rows": [pickle.dumps((ids[r], y[r], f[r], b[r]))]})
        routed = chunks.select("chunk", "rows").mapInPandas(route, schema)
        out = routed if out is None else out.unionByName(routed)
    return out


def _finish(part: pd.DataFrame, jobs: list[Job], tops: dict, grouped: np.ndarray):
    """(tree number, finished subtree, means and weights above it) of one group's trees, one at a time, and its rows."""
    j, first, last, node = (int(part[k].iloc[0]) for k in ("job", "tree", "last", "node"))
    ids, y, f, b = _together(part["rows"])
    job = jobs[j]

    def grown():
        if job.rate:
            yield from ((t, tree, []) for t, tree in enumerate(boost(b, y, (f != job.fold).astype(np.float64), grouped, job)))
            return
        for t in range(first, last):
            w = (weights(job.seed, t, ids) if job.bootstrap else np.ones(len(ids))) * (f != job.fold)
            top, above, start = tops.get((j, t)), [], 0
            if top is not None and node:
                start = top.depth[node]
                above = _above(top, node)
            tree = grow(b, y, w, grouped, job.leaf, job.depth, start)
            if not (w > 0).any() and top is not None:
                tree[3][0] = top.value[node]
            yield t, tree, above
    return j, node, (ids, y, f, b), grown()


def _above(top: Tree, node: int) -> list[tuple[float, float]]:
    """(mean, weight) of a node's ancestors, from the root."""
    parent = {c: n for n, left in enumerate(top.left) if left >= 0 for c in (left, left + 1)}
    out = []
    while node in parent:
        node = parent[node]
        out.append((top.value[node], top.heft[node]))
    return out[::-1]


def held_out(chunks: DataFrame, jobs: list[Job], columns: Columns, cuts: tuple, id_name: str = "id") -> DataFrame:
    """(job, tree, id, y, p0, p1, ..): for every row of a job's own fold the sum of its trees' values, in blocks from ``tree`` on, per cut."""
    grouped = columns.grouped
    if jobs[0].rate and sum(_rows_by_fold(chunks).values()) > TASK_ROWS:
        out = None
        for j, job in enumerate(jobs):
            part = _boosted_values(chunks, j, job.fold, boost_in_passes(chunks, job, grouped), grouped, cuts, id_name)
            out = part if out is None else out.unionByName(part)
        return out
    tops = grow_tops(chunks, jobs, grouped)
    # only tops that were split travel with the tasks
    split = {k: v for k, v in tops.items() if v.column[0] >= 0}

    def task(part: pd.DataFrame) -> pd.DataFrame:
        j, node, (ids, y, f, b), grown = _finish(part, jobs, split, grouped)
        mine = f == jobs[j].fold
        total = np.zeros((len(cuts), int(mine.sum())))
        for _, tree, above in grown:
            p = walk(tree, b[mine], grouped, cuts)
            for i, (most, least) in enumerate(cuts):
                stops = [mean for d, (mean, heft) in enumerate(above) if heft < least or (most is not None and d >= most)]
                if stops:
                    p[i] = stops[0]
            total += p
        out = {"job": j, "tree": int(part["tree"].iloc[0]), id_name: ids[mine], "y": y[mine]}
        return pd.DataFrame(out | {f"p{i}": total[i] for i in range(len(cuts))})
    schema = f"job int, tree int, {id_name} long, y double, " + ", ".join(f"p{i} double" for i in range(len(cuts)))
    return _payload(chunks, jobs, tops, grouped).groupBy("job", "tree", "last", "node").applyInPandas(task, schema)


def _boosted_values(chunks: DataFrame, j: int, fold: int, trees: list[tuple], grouped: np.ndarray, cuts: tuple, id_name: str) -> DataFrame:
    """(job, tree, id, y, p0, p1, ..) of the rows of a fold, by trees that grew without it."""
    def run(batches):
        for batch in batches:
            for blob in batch["rows"]:
                ids, y, f, b = pickle.loads(blob)
                mine = f == fold
                total = np.zeros((len(cuts), int(mine.sum())))
                for tree in trees:
                    total += walk(tree, b[mine], grouped, cuts)
                yield pd.DataFrame({"job": j, "tree": 0, id_name: ids[mine], "y": y[mine]} | {f"p{i}": total[i] for i in range(len(cuts))})
    return chunks.select("rows").mapInPandas(run, f"job int, tree int, {id_name} long, y double, " + ", ".join(f"p{i} double" for i in range(len(cuts))))


_SUBTREES = "tree int, number int, last int, node int, blob binary, slots array<int>, gains array<double>"


class ForestModel:
    """Mean of regression trees (one tree: its value) over preprocessed rows, with ``featureImportances``.

    Subtrees are a written table; the tops above them, a node per ``TASK_ROWS`` rows, travel with the tasks."""

    def __init__(self, preprocessor: PipelineModel, columns: Columns, job: Job, tops: dict, subtrees: DataFrame, features: str = "features", id_col: str = "records_id"):
        self.preprocessor, self.columns, self.job, self.tops, self.subtrees, self.features, self.id_col = preprocessor, columns, job, tops, subtrees, features, id_col
        self.stages = [*preprocessor.stages, self]

    @classmethod
    def fit(cls, preprocessor: PipelineModel, feats: DataFrame, label: str, job: Job, features: str = "features", id_col: str = "records_id") -> "ForestModel":
        columns = columns_of(preprocessor, feats, features)
        chunks = written(chunked(feats, columns, id_col, label, features=features), "tree-chunks")
        grouped = columns.grouped

        def packed(grown, last: int, node: int) -> list[tuple]:
            out, gains = [], defaultdict(float)
            for t, tree in grown:
                for col, code, g in zip(*(tree[i] for i in (0, 1, 5))):
                    if col >= 0:
                        gains[columns.slot(int(col), int(code))] += float(g)
                out.append((t, last, node, pickle.dumps(tree[:4]), [], []))
            out[-1] = (*out[-1][:4], list(gains), list(gains.values()))     # a block's gains stand once
            return out
        if job.rate and sum(_rows_by_fold(chunks).values()) > TASK_ROWS:
            own = [(0, *row) for row in packed(enumerate(boost_in_passes(chunks, job, grouped)), job.trees, 0)]
            sub = feats.sparkSession.createDataFrame(own, _SUBTREES)
            return cls(preprocessor, columns, job, {}, written(sub, "trees"), features, id_col)
        tops = grow_tops(chunks, [job], grouped)
        split = {k: v for k, v in tops.items() if v.column[0] >= 0}

        def task(part: pd.DataFrame) -> pd.DataFrame:
            first, last = (int(part[k].iloc[0]) for k in ("tree", "last"))
            _, node, _, grown = _finish(part, [job], split, grouped)
            out = [(first, *row) for row in packed(((t, tree) for t, tree, _ in grown), last, node)]
            return pd.DataFrame(out, columns=["tree", "number", "last", "node", "blob", "slots", "gains"])
        sub = _payload(chunks, [job], tops, grouped).groupBy("job", "tree", "last", "node").applyInPandas(task, _SUBTREES)
        return cls(preprocessor, columns, job, split, written(sub, "trees"), features, id_col)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction_log``; rows are told apart by the id column, and rows that share an id by nothing."""
        feats = self.preprocessor.transform(df)
        size = self.subtrees.agg(F.sum(F.length("blob"))).first()[0] or 0
        if size <= BROADCAST_BYTES and not self.tops:
            return self._in_place(feats).select(*df.columns, "prediction_log")
        chunks = chunked(feats, self.columns, self.id_col, None, features=self.features)
        preds = self._joined(chunks)
        return df.join(preds.withColumnRenamed("id", "_pid"), F.col(self.id_col) == F.col("_pid"), "left").drop("_pid")

    def _in_place(self, feats: DataFrame) -> DataFrame:
        """Every executor has all trees, ``BROADCAST_BYTES`` at most, and rows stay where they are."""
        from pyspark.sql.functions import pandas_udf
        blobs = [r["blob"] for r in self.subtrees.select("number", "blob").orderBy("number").collect()]
        trees, columns, grouped, n = feats.sparkSession.sparkContext.broadcast(blobs), self.columns, self.columns.grouped, self.job.divisor
        cache: list = []

        def values(indices: pd.Series, vectors: pd.Series) -> pd.Series:
            if not cache:
                cache.extend(map(_kept, trees.value))
            if not len(vectors):
                return pd.Series([], dtype="float64")
            b, total = columns.bins_of(indices, vectors), np.zeros(len(vectors))
            for tree in cache:
                total += walk(tree, b, grouped)[0]
            return pd.Series(total / n)
        return feats.withColumn("prediction_log", pandas_udf(values, "double")(*stored(self.features)))

    def _joined(self, chunks: DataFrame) -> DataFrame:
        """Chunks of rows meet blocks of trees, or their part of a cut tree, ``SCORED_ROWS`` rows a group; values are summed per id."""
        grouped, job, tops = self.columns.grouped, self.job, self.tops
        every = {(0, t): tops.get((0, t)) or _leaf() for t in range(job.trees)}
        chunks = written(chunks, "score-chunks")
        groups = max(1, -(-(chunks.agg(F.sum("n")).first()[0] or 0) // SCORED_ROWS))
        rows = _payload(chunks, [job], every, grouped).withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(groups)).cast("int"))
        own = self.subtrees.select("tree", "node", "number", "blob", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))

        def task(part: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            if not len(part):
                return pd.DataFrame({"id": np.empty(0, np.int64), "p": np.empty(0)})
            ids, b = (np.concatenate(x) for x in zip(*[pickle.loads(p)[::3] for p in part["rows"]]))
            if not len(own):       # nothing was learned below this node
                t, node = int(part["tree"].iloc[0]), int(part["node"].iloc[0])
                return pd.DataFrame({"id": ids, "p": every[0, t].value[node]})
            return pd.DataFrame({"id": ids, "p": sum(walk(_kept(blob), b, grouped)[0] for blob in own.sort_values("number")["blob"])})
        by = ("tree", "node", "part")
        told = rows.groupBy(*by).cogroup(own.groupBy(*by)).applyInPandas(task, "id long, p double")
        return told.groupBy("id").agg((F.sum("p") / job.divisor).alias("prediction_log"))

    @property
    def featureImportances(self):  # noqa: N802 - the name that Spark's models use
        """Share of all lowered squares per feature."""
        from pyspark.ml.linalg import DenseVector
        n = max([0, *[s + 1 for s in self.columns.slots], *[z for _, z in self.columns.groups]])
        out = np.zeros(n)
        for r in self.subtrees.select(F.explode(F.arrays_zip("slots", "gains")).alias("g")).groupBy("g.slots").agg(F.sum("g.gains").alias("s")).collect():
            out[r["slots"]] += r["s"]
        for top in self.tops.values():
            for col, code, g in zip(top.column, top.code, top.gain):
                if col >= 0:
                    out[self.columns.slot(col, code)] += g
        return DenseVector(out / out.sum() if out.sum() > 0 else out)

    def save(self, path: str) -> None:
        self.preprocessor.write().overwrite().save(f"{path}/preprocessor")
        self.subtrees.write.mode("overwrite").parquet(f"{path}/trees")
        state = pickle.dumps((self.columns, self.job, self.tops, self.features, self.id_col))
        self.subtrees.sparkSession.createDataFrame([(state,)], "state binary").write.mode("overwrite").parquet(f"{path}/state")

    @classmethod
    def load(cls, path: str, spark) -> "ForestModel":
        columns, job, tops, features, id_col = pickle.loads(bytes(spark.read.parquet(f"{path}/state").first()["state"]))
        return cls(PipelineModel.load(f"{path}/preprocessor"), columns, job, tops, spark.read.parquet(f"{path}/trees"), features, id_col)


def _kept(blob: bytes) -> tuple:
    """A tree as models keep it: depths, gains and weights matter while it grows and is cut, not for scores."""
    tree = pickle.loads(blob)
    none = np.broadcast_to(0.0, len(tree[0]))
    return *tree, none, none, none


def _leaf() -> Tree:
    tree = Tree()
    tree.add(0.0, 0)
    return tree
