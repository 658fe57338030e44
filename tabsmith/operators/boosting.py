"""Boosted trees for many classification problems in one run (M5, M6; used by T5, A2 and A9 as well).

Softmax boosting on histograms: a round grows one tree per class from first and second derivatives of the log loss.
Growing a level is one Spark job over the binned rows. Tasks make per-node histograms, whose size depends on features,
bins and nodes and not on rows; they are summed by a shuffle, and only the best split of each node reaches the driver.
Several problems (folds, parameter draws, noisy copies) are grown in the same jobs, a row carrying the number of its
problem, so their count does not multiply the jobs. If no problem has over ``WHOLE`` times ``ROWS_PER_TASK`` rows, each
has them in a task of its own, which takes the same steps for all rounds in one job; the trees are the same either way.
A single problem of many rows is grown by a task per class: each has all rows, and they tell each other their trees after
every round (a barrier stage; without the cores for it, or with dynamic allocation, one task grows all classes).

* ``leaves=0`` grows level by level to ``depth``; ``leaves=n`` grows best-first to n leaves: all nodes that best-first
  order picks from the gains known so far are opened in one job, until every child of a picked node is known.
* Derivatives are rounded to 2^-24 and summed exactly, and draws of rows and features are keyed, so that the trees
  depend neither on the partitioning nor on the problems that happen to run along.
* A partition keeps its binned rows as numpy blocks, with the margins of the last state; the few trees since are added
  on the way. Every ``REFRESH`` rounds the state is brought up to date and checkpointed, which keeps the lineage short.
  The blocks are an RDD, since each of some thousand short jobs would otherwise be planned and its rows be turned into
  Arrow batches anew; everything before and after the iterations is DataFrame work.
"""

from __future__ import annotations

import heapq
import pickle
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions.presets import SEED
from tabsmith.session import cut_lineage, ensure_checkpoint_dir, slots

MAX_BINS = 63
REFRESH = 10
SCALE = float(1 << 24)
TRAIN, VAL, OTHER = 0, 1, 2  # roles of rows
ROWS_PER_TASK = 50_000
SHARE_ROWS = 20_000  # rows of a single problem from which its classes are grown side by side
WHOLE = 12  # times as many rows of a problem may be grown by one task: at 64 features and 5 classes some 400 bytes a row
PAIR_ROWS = 3_000  # rows of a node from which two features are counted at a time
FEW_CELLS = 100_000
MANY_ROWS = 5_000
CHUNK = 16_000  # rows whose hessians, at most SCALE / 2 each, sum to less than ONE_ROW; a row's own is added to each
ONE_ROW = float(1 << 37)


@dataclass(frozen=True)
class Boost:
    """Parameters of one problem; the defaults are those of the level-wise model."""

    rounds: int = 300
    depth: int = 6  # 0: no limit
    leaves: int = 0  # 0: level by level
    rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    gamma: float = 0.0
    alpha: float = 0.0
    lam: float = 1.0
    min_rows: int = 1
    min_hessian: float = 1.0
    patience: int = 0  # rounds without a better validation loss before stopping; 0: never
    seed: int = SEED

    @staticmethod
    def leafwise(**changes) -> Boost:
        """Defaults of the best-first model; its library draws no rows unless asked to, so neither does this."""
        return Boost(**{**dict(depth=0, leaves=63, rate=0.05, subsample=1.0, alpha=0.1, lam=0.1, min_rows=20,
                               min_hessian=1e-3, patience=50), **changes})


@dataclass
class Tree:
    """Nodes as parallel lists; node 0 is the root, feature -1 marks a leaf."""

    feature: list = field(default_factory=lambda: [-1])
    bin: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])

    def add(self) -> int:
        for name, v in (("feature", -1), ("bin", 0), ("left", 0), ("right", 0), ("value", 0.0), ("gain", 0.0)):
            getattr(self, name).append(v)
        return len(self.feature) - 1

    def packed(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x) for x in (self.feature, self.bin, self.left, self.right, self.value, self.gain))

    @staticmethod
    def unpacked(lists: tuple[np.ndarray, ...]) -> Tree:
        return Tree(*(x.tolist() for x in lists))

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature, np.int32), np.array(self.bin, np.int32), np.array(self.left, np.int32),
                np.array(self.right, np.int32), np.array(self.value, np.float64))


def route(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """The leaf of each binned row."""
    feature, cut, left, right, _ = tree
    node = np.zeros(len(bins), np.int32)
    if len(bins) > MANY_ROWS:  # node by node: each step reads one column
        todo = [(0, np.arange(len(bins)))]
        while todo:
            n, rows = todo.pop()
            if feature[n] < 0:
                node[rows] = n
            elif len(rows):
                low = bins[rows, feature[n]] <= cut[n]
                todo += [(left[n], rows[low]), (right[n], rows[~low])]
        return node
    rows = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
    while len(rows):
        at = node[rows]
        node[rows] = np.where(bins[rows, feature[at]] <= cut[at], left[at], right[at])
        rows = rows[feature[node[rows]] >= 0]
    return node


def _soft(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_split(hist: np.ndarray, p: Boost, allowed: np.ndarray, running: bool = False, room: np.ndarray | None = None):
    """hist (3: gradient, hessian, rows; features; bins) → (gain, feature, bin, left sums, sums) of the best cut, or gain 0.

    Rows at or below the bin go left. The last bin holds missing values, so they go right. Ties: first feature, first bin.
    With ``running`` each bin holds the sums of all bins up to it; ``room`` (3 numbers a bin) may be written over.
    """
    left = hist if running else hist.cumsum(axis=2)
    n_bins, sums = left.shape[2], left[:, 0, -1].copy()
    g, h, n = left.reshape(3, -1)
    gain, other, below = np.empty((3, len(g))) if room is None else room

    def score(top, below):  # in steps of 2^-24, as the sums are; a power of two more or less changes no digit
        if p.alpha:
            np.abs(top, out=top)
            top -= p.alpha * SCALE
            np.maximum(top, 0.0, out=top)
        top *= top
        below += 1e-12 * SCALE
        top /= below

    whole = np.abs(sums[0] / SCALE)
    if p.alpha:
        whole = np.maximum(whole - p.alpha, 0.0)
    whole = whole ** 2 / (sums[1] / SCALE + p.lam + 1e-12)
    gain[:] = g
    score(gain, np.add(h, p.lam * SCALE, out=below))
    np.subtract(sums[1], h, out=below)
    below += p.lam * SCALE
    score(np.subtract(sums[0], g, out=other), below)
    gain += other
    gain *= 1 / SCALE
    gain -= whole
    gain *= 0.5
    if p.gamma:
        gain -= p.gamma
    table = gain.reshape(-1, n_bins)
    table[:, -1] = -np.inf
    table[~allowed] = -np.inf
    if p.min_rows > 1:
        few = n < p.min_rows
        few |= n > sums[2] - p.min_rows
        np.copyto(gain, -np.inf, where=few)

    def enough(at):
        return (np.minimum(n[at], sums[2] - n[at]) >= p.min_rows) & (np.minimum(h[at], sums[1] - h[at]) / SCALE >= p.min_hessian)

    best = int(gain.argmax())
    if gain[best] > 1e-9 and not enough(best):
        np.copyto(gain, -np.inf, where=~enough(slice(None)))
        best = int(gain.argmax())
    if not gain[best] > 1e-9:
        return 0.0, -1, 0, sums, sums
    f, b = divmod(best, n_bins)
    return float(gain[best]), f, b, left[:, f, b].copy(), sums


NOTHING = (0.0, -1, 0, np.zeros(3), np.zeros(3))  # of a node without rows


class _Growing:
    """One tree while it grows: which nodes wait for a histogram and which splits are known."""

    def __init__(self, p: Boost, allowed: np.ndarray):
        self.p, self.allowed, self.tree = p, allowed, Tree()
        self.sums: dict[int, np.ndarray] = {}
        self.depth = {0: 0}
        self.known: set[int] = set()  # histogram seen
        self.pending = [0]
        self.values: dict[int, float] = {}  # of the leaves, when the tree is done

    def _may_split(self, node: int) -> bool:
        """False if no cut of the node can be taken: at full depth, or too few rows or too small a hessian for two sides."""
        if self.p.depth and self.depth[node] >= self.p.depth:
            return False
        _, h, n = self.sums[node]
        return n >= 2 * self.p.min_rows and h / SCALE >= 2 * self.p.min_hessian

    def learn(self, node: int, found) -> None:
        gain, f, b, left, sums = found
        self.sums.setdefault(node, sums)
        self.known.add(node)
        if f < 0:
            return
        t = self.tree
        lo, hi = t.add(), t.add()
        t.feature[node], t.bin[node], t.left[node], t.right[node], t.gain[node] = f, b, lo, hi, gain
        self.sums[lo], self.sums[hi] = left, sums - left
        self.depth[lo] = self.depth[hi] = self.depth[node] + 1

    def _picked(self) -> list[int]:
        """Splits that best-first order takes (all of them without a limit of leaves)."""
        t, out, heap = self.tree, [], []

        def offer(n):
            if t.feature[n] >= 0:
                heapq.heappush(heap, (-t.gain[n], n))

        offer(0)
        while heap and (not self.p.leaves or len(out) + 1 < self.p.leaves):
            n = heapq.heappop(heap)[1]
            out.append(n)
            offer(t.left[n])
            offer(t.right[n])
        return out

    def plan(self) -> bool:
        """Set the nodes that need a histogram next; False if the tree is done."""
        picked = self._picked()
        full = self.p.leaves and len(picked) + 1 >= self.p.leaves and self._settled(picked)
        self.pending = [] if full else [c for n in picked for c in (self.tree.left[n], self.tree.right[n])
                                        if c not in self.known and self._may_split(c)]
        return bool(self.pending)

    def _settled(self, picked: list[int]) -> bool:
        return all(c in self.known or not self._may_split(c) for n in picked for c in (self.tree.left[n], self.tree.right[n]))

    def finish(self) -> Tree:
        """The picked splits alone, renumbered, with leaf values."""
        old, keep, out = self.tree, set(self._picked()), Tree()
        todo = [(0, 0)]
        while todo:
            n, m = todo.pop()
            if n in keep:
                lo, hi = out.add(), out.add()
                out.feature[m], out.bin[m], out.left[m], out.right[m], out.gain[m] = old.feature[n], old.bin[n], lo, hi, old.gain[n]
                todo += [(old.left[n], lo), (old.right[n], hi)]
            else:
                g, h = self.sums[n][:2] / SCALE
                out.value[m] = self.values[n] = float(-_soft(g, self.p.alpha) / (h + self.p.lam + 1e-12) * self.p.rate)
        return out


# ---------------------------------------------------------------- work inside tasks
def _uniform(keys: np.ndarray, seed: int, round_no: int) -> np.ndarray:
    """Keyed draws in [0, 1) per row and round."""
    h = keys.view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + round_no * 0xD6E8FEB86659FD93) % 2 ** 64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) / 2.0 ** 64


class Block(NamedTuple):
    """Some rows of a partition."""

    problem: np.ndarray
    role: np.ndarray
    label: np.ndarray
    key: np.ndarray
    bins: np.ndarray  # rows x features
    margins: np.ndarray  # rows x classes


def _softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _add_trees(margins: np.ndarray, bins: np.ndarray, rounds: list) -> np.ndarray:
    out = margins.copy()
    for trees in rounds:
        for c, tree in enumerate(trees):
            out[:, c] += tree[4][route(tree, bins)]
    return out


def _found(hist: np.ndarray, work: dict, p: int, c: int) -> np.ndarray:
    gain, f, b, left, sums = best_split(hist, work[p][2], work[p][3][c][2])
    return np.array([gain, f, b, *left, *sums])


def _histograms(tree: tuple[np.ndarray, ...], pending: np.ndarray, bins: np.ndarray, proba: np.ndarray, own: np.ndarray,
                n_bins: int) -> np.ndarray:
    """(3: gradient, hessian, rows; pending nodes; features; bins) of one class over the rows in the pending nodes."""
    d = bins.shape[1]
    slot = np.full(len(tree[0]), -1, np.int64)
    slot[pending] = np.arange(len(pending))
    s = slot[route(tree, bins)]
    there = np.flatnonzero(s >= 0)
    g, h = _derivatives(proba[there], own[there])
    return _sums(bins[there], s[there], g, h, len(pending), n_bins)


def _derivatives(proba: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of each row in steps of 2^-24."""
    return np.rint((proba - own) * SCALE), np.rint(np.maximum(2.0 * proba * (1.0 - proba), 1e-16) * SCALE)


def _sums(bins: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, slots: int, n_bins: int) -> np.ndarray:
    """(3: gradient, hessian, rows; slots; features; bins). A hessian and its row are counted in one number, both exactly;
    many rows go feature by feature, which needs no copies of the derivatives."""
    d, size = bins.shape[1], slots * n_bins
    out = np.zeros((3, slots, d, n_bins))
    for at in range(0, len(bins), CHUNK):
        some = slice(at, at + CHUNK)
        columns, first, gs, both = np.ascontiguousarray(bins[some].T), slot[some] * n_bins, g[some], h[some] + ONE_ROW
        if columns.size <= FEW_CELLS:
            cells = (columns + ((np.arange(d) * size)[:, None] + first)).ravel()
            sums, pairs = (np.bincount(cells, np.tile(w, d), d * size).reshape(d, size) for w in (gs, both))
        else:
            sums, pairs = np.empty((d, size)), np.empty((d, size))
            for f, column in enumerate(columns):
                cells = first + column if slots > 1 else column
                sums[f], pairs[f] = np.bincount(cells, gs, size), np.bincount(cells, both, size)
        count = np.floor(pairs / ONE_ROW)
        for part, total in zip((sums, pairs - count * ONE_ROW, count), out):
            total += part.reshape(d, slots, n_bins).transpose(1, 0, 2)
    return out


def _losses(proba: np.ndarray, role: np.ndarray, y: np.ndarray) -> dict:
    """Role → (loss in steps of 2^-24, rows, rows predicted right)."""
    own = proba[np.arange(len(y)), np.where(role != OTHER, y, 0)]
    loss = np.rint(-np.log(np.clip(own, 1e-15, 1.0)) * SCALE)
    right = proba.argmax(axis=1) == y
    found = {r: role == r for r in (TRAIN, VAL)}
    return {r: np.array([loss[at].sum(), at.sum(), right[at].sum()]) for r, at in found.items() if at.any()}


def _level(work: dict, d: int, n_bins: int):
    """Task of a job that grows one level. ``work``: problem → (trees since the state, round, parameters, class → (tree,
    pending nodes, allowed features), loss?)."""
    def run(blocks: Iterator[Block]) -> Iterator[tuple]:
        hists: dict = {}
        losses: dict = {}
        for problem, role, label, key, bins, margins in blocks:
            for p in np.unique(problem):
                if int(p) not in work:
                    continue
                since, round_no, par, growing, want_loss = work[int(p)]
                rows = np.flatnonzero(problem == p)
                m = _add_trees(margins[rows], bins[rows], since)
                proba = _softmax(m)
                y = label[rows].astype(np.int64)
                if want_loss:
                    for r, v in _losses(proba, role[rows], y).items():
                        losses[int(p), r] = losses.get((int(p), r), 0) + v
                use = np.flatnonzero((role[rows] == TRAIN) & (_uniform(key[rows], par.seed, round_no) < par.subsample))
                if not len(use) or not growing:
                    continue
                b = bins[rows[use]]
                for c, (tree, pending, _) in growing.items():
                    part = _histograms(tree, pending, b, proba[use, c], y[use] == c, n_bins)
                    hists[int(p), c] = hists.get((int(p), c), 0) + part
        for (p, r), v in losses.items():
            yield (1, p, r, 0), v
        for (p, c), part in hists.items():
            for i, node in enumerate(work[p][3][c][1].tolist()):
                hist = np.ascontiguousarray(part[:, i])
                if hist[2].any():
                    yield (0, p, c, node), hist
    return run


class _Columns:
    """Binned rows that are all here: the cells that a row is counted in, the bins of each feature, and those of two features
    as one number."""

    def __init__(self, bins: np.ndarray, n_bins: int):
        self.n_bins, (n, self.d) = n_bins, bins.shape
        self.cells = bins + (np.arange(self.d) * n_bins).astype(np.uint16 if self.d * n_bins <= 65536 else np.int64)
        self.bins = np.ascontiguousarray(bins.T)
        self.pairs = self.bins[::2].astype(np.uint16) * np.uint16(n_bins)
        self.pairs[:self.d // 2] += self.bins[1::2]
        self.up_to = np.triu(np.ones((n_bins, n_bins)))

    def sums(self, used: np.ndarray, at: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """(3: gradient, hessian, rows; used features; bins) of the rows ``at``, each bin with those before it. As in ``_sums``
        a hessian and its row are one number, both are exact."""
        if len(at) < PAIR_ROWS:
            return self._row_by_row(used, at, g, h)
        out = 0.0
        for start in range(0, len(at), CHUNK):
            out = out + self._by_pairs(used, at[start:start + CHUNK], g, h)
        return out

    def _row_by_row(self, used, at, g, h):
        cells = self.cells.take(at, axis=0).astype(np.intp).ravel()
        weights = np.empty((len(at), self.d))
        found = []
        for w in (g.take(at), h.take(at) + ONE_ROW):
            weights[:] = w[:, None]
            found.append(np.bincount(cells, weights.ravel(), self.d * self.n_bins).reshape(self.d, self.n_bins).take(used, axis=0))
        return self._up_to(found)

    def _by_pairs(self, used, at, g, h):
        """A row meets a cell for two features: a row of cells sums to the bin of the first, a column to that of the second."""
        which, n_bins, ones = np.unique(used // 2), self.n_bins, np.ones(self.n_bins)
        weights, found = (g.take(at), h.take(at) + ONE_ROW), np.empty((2, len(which), 2, n_bins))
        for i, pair in enumerate(which):
            cells = self.pairs[pair].take(at).astype(np.intp)
            for w, part in zip(weights, found):
                table = np.bincount(cells, w, n_bins * n_bins).reshape(n_bins, n_bins)
                np.matmul(table, ones, out=part[i, 0])
                np.matmul(ones, table, out=part[i, 1])
        return self._up_to(found.reshape(2, -1, n_bins).take(np.searchsorted(which, used // 2) * 2 + used % 2, axis=1))

    def _up_to(self, found):
        """Running sums over the bins by small matrix products (whole numbers below 2^53), hessians and rows apart."""
        d = len(found[0])
        out, both = np.empty((3, d, self.n_bins)), np.empty((d, self.n_bins))
        for f in range(0, d, 64):
            np.matmul(found[0][f:f + 64], self.up_to, out=out[0, f:f + 64])
            np.matmul(found[1][f:f + 64], self.up_to, out=both[f:f + 64])
        np.multiply(both, 1 / ONE_ROW, out=out[2])
        np.floor(out[2], out=out[2])
        np.multiply(out[2], ONE_ROW, out=out[1])
        np.subtract(both, out[1], out=out[1])
        return out

    def split(self, at: np.ndarray, feature: int, cut: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows that go left, and the others."""
        low = self.bins[feature].take(at) <= cut
        return at[low], at[~low]

    def add(self, tree: tuple[np.ndarray, ...], at: np.ndarray, out: np.ndarray) -> None:
        """Add the tree's values of the rows ``at`` to theirs in ``out``."""
        feature, cut, left, right, value = tree[:5]
        todo = [(0, at)]
        while todo:
            n, at = todo.pop()
            if not len(at):
                continue
            if feature[n] < 0:
                out[at] += value[n]
            else:
                low, high = self.split(at, feature[n], cut[n])
                todo += [(left[n], low), (right[n], high)]


def _whole_rounds(problems: dict, shares: int, k: int, n_bins: int, folder: str = ""):
    """Task of the job that grows whole problems; all rows of a problem are in each of its tasks. Gives each round's trees and
    losses. With ``shares`` over 1 there is one problem, and as many tasks of a barrier stage grow its classes side by side."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for batch in batches:
            for p, share, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found.setdefault((p, share), []).append(blob)
        for p, share in sorted(found):
            _, role, label, key, bins = (np.concatenate(x) for x in zip(*map(pickle.loads, found.pop((p, share)))))
            columns, told = _Columns(bins, n_bins), _Notes(folder, share, shares) if shares > 1 else None
            del bins
            for round_no, trees, losses in _rounds(p, problems[p], role, label.astype(np.int64), key, columns, k, share, shares, told):
                if share == 0:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p], pa.int32()), pa.array([round_no], pa.int32()), pa.array([pickle.dumps((trees, losses), 5)], pa.binary())],
                        names=["problem", "round", "found"])
    return run


class _Notes:
    """What the tasks of a barrier stage tell each other: a file per task and round in a folder that all of them see (a barrier's
    own exchange takes a second). A task that runs anew finds the same notes, as trees depend on nothing but the rows."""

    def __init__(self, folder: str, share: int, shares: int):
        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.share, self.shares, self.round = share, shares, 0

    def __call__(self, mine) -> list:
        name = lambda share: f"{self.folder}/{self.round}-{share}"
        unfinished = f"{name(self.share)}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(unfinished) as out:
            out.write(pickle.dumps(mine, 5))
        self.fs.move(unfinished, name(self.share))
        found = []
        for share in range(self.shares):
            wait = 0.002
            while share != self.share and self.fs.get_file_info(name(share)).type != fs.FileType.File:
                time.sleep(wait)
                wait = min(2 * wait, 0.05)
            with self.fs.open_input_stream(name(share)) as source:
                found.append(mine if share == self.share else pickle.loads(source.read()))
        self.round += 1
        return found


def _rounds(p: int, par: Boost, role: np.ndarray, y: np.ndarray, key: np.ndarray, columns: _Columns, k: int, share: int = 0,
            shares: int = 1, told=None) -> Iterator[tuple]:
    """(round, its packed trees, losses after it) until the rounds or the patience are over. A share grows the trees of every
    ``shares``-th class and hears of the others from ``told``; the first one says when to stop."""
    margins, everyone = np.zeros((len(y), k)), np.arange(len(y))
    proba, best, low, over = _softmax(margins), {p: 0}, {p: np.inf}, False
    for round_no in range(par.rounds):
        drawn = (role == TRAIN) & (_uniform(key, par.seed, round_no) < par.subsample)
        use, rest = np.flatnonzero(drawn), np.flatnonzero(~drawn)
        trees = {}
        for c in range(share, k, shares):
            tree, leaves = _grown(par, _features(par, columns.d, round_no, c), columns, use, *_derivatives(proba[:, c], y == c))
            trees[c] = tree.packed()
            for at, value in leaves:
                margins[at, c] += value
            columns.add(trees[c], rest, margins[:, c])
        if told is not None:
            got = told((trees, over))
            if got[0][1]:
                return
            for c in set(range(k)) - set(trees):
                trees[c] = got[c % shares][0][c]
                columns.add(trees[c], everyone, margins[:, c])
        proba = _softmax(margins)
        losses = {(p, r): v for r, v in _losses(proba, role, y).items()} if share == 0 else {}
        yield round_no, [trees[c] for c in range(k)], losses
        over = _record(p, round_no + 1, losses, par, [], best, low)
        if over and told is None:
            return


def _whole_tree(par: Boost, allowed: np.ndarray, bins: np.ndarray, proba: np.ndarray, own: np.ndarray, n_bins: int) -> Tree:
    """One tree over rows that are all here."""
    return _grown(par, allowed, _Columns(bins, n_bins), np.arange(len(bins)), *_derivatives(proba, own))[0]


def _grown(par: Boost, allowed: np.ndarray, columns: _Columns, use: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[Tree, list]:
    """(tree, [(rows, value) of each leaf]) over the rows ``use``: the steps of a job per level, without the jobs.

    Of two siblings only the one with fewer rows is summed; sums are exact, so the other is what is left of their parent."""
    growing = _Growing(par, allowed)
    tree = growing.tree
    used = np.flatnonzero(allowed | (np.arange(columns.d) == 0))  # the first feature gives a node's sums
    may, room = allowed[used], np.empty((3, len(used) * columns.n_bins))
    rows = {0: use}
    parts: dict = {0: columns.sums(used, use, g, h)}  # node → summed histogram, until its children have theirs
    parent: dict = {}

    def open_rows(node: int) -> tuple[int, int]:
        lo, hi = tree.left[node], tree.right[node]
        if lo not in rows:
            rows[lo], rows[hi] = columns.split(rows[node], tree.feature[node], tree.bin[node])
        return lo, hi

    while True:
        for node in growing.pending:
            if node not in parts:
                lo, hi = open_rows(parent[node])
                less, more = (lo, hi) if len(rows[lo]) <= len(rows[hi]) else (hi, lo)
                parts[less], whole = columns.sums(used, rows[less], g, h), parts.pop(parent[node])
                parts[more] = np.subtract(whole, parts[less], out=whole)
            gain, f, *found = best_split(parts[node], par, may, True, room) if len(rows[node]) else NOTHING
            growing.learn(node, (gain, int(used[f]) if f >= 0 else f, *found))
            if tree.feature[node] >= 0:
                parent[tree.left[node]] = parent[tree.right[node]] = node
            else:
                del parts[node]
        if not growing.plan():
            break
    done, leaves, todo = growing.finish(), [], [0]
    while todo:
        node = todo.pop()
        if node in growing.values:
            leaves.append((rows[node], growing.values[node]))
        else:
            todo += open_rows(node)
    return done, leaves


def _refresh(since: dict):
    def run(block: Block) -> Block:
        margins = block.margins.copy()
        for p in np.unique(block.problem):
            if since.get(int(p)):
                rows = np.flatnonzero(block.problem == p)
                margins[rows] = _add_trees(margins[rows], block.bins[rows], since[int(p)])
        return block._replace(margins=margins)
    return run


def _renewed(state, since: dict):
    """The state with the margins of the trees since, written to the checkpoint folder."""
    fresh = state.map(_refresh(since)).persist(StorageLevel.MEMORY_AND_DISK)
    fresh.checkpoint()
    fresh.count()
    state.unpersist()
    return fresh


# ---------------------------------------------------------------- binning
def problem_rows(df: DataFrame, cols: list[str], label: str, key: str, role: Column, problem: Column | None = None) -> DataFrame:
    """Rows for ``fit``: (problem, role, label, key, x). ``role`` is TRAIN, VAL or OTHER (labels of OTHER are not read)."""
    return df.select((F.lit(0) if problem is None else problem).cast("int").alias("problem"), role.cast("int").alias("role"),
                     F.coalesce(F.col(label).cast("int"), F.lit(-1)).alias("label"), F.xxhash64(key).alias("key"),
                     F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))


def cut_points(rows: DataFrame, d: int, max_bins: int = MAX_BINS) -> dict[int, list[np.ndarray]]:
    """Problem → per feature the values that separate its bins: up to ``max_bins`` - 1 quantiles of the training rows."""
    share = [i / max_bins for i in range(1, max_bins)]
    value = lambda i: F.when(~F.isnan(F.col("x")[i]), F.col("x")[i])
    found = rows.filter(F.col("role") == TRAIN).groupBy("problem").agg(
        *[F.percentile_approx(value(i), share, 10000).alias(f"q{i}") for i in range(d)]).collect()  # problems x features x bins
    return {r.problem: [np.unique(np.array(r[f"q{i}"] or [], dtype=np.float64)) for i in range(d)] for r in found}


def _blocks(cuts: dict, d: int, n_bins: int):
    """Rows → pickled fields of one block without its margins per problem and batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda n: batch.column(batch.schema.names.index(n))
            fields = [get(n).to_numpy(zero_copy_only=False) for n in ("problem", "role", "label", "key")]
            fields.append(bins_of(get("x"), fields[0], cuts, d, n_bins))
            for p in np.unique(fields[0]):
                at = np.flatnonzero(fields[0] == p)
                yield pa.RecordBatch.from_arrays([pa.array([int(p)], pa.int32()), pa.array([pickle.dumps(tuple(x[at] for x in fields), 5)], pa.binary())],
                                                 names=["problem", "block"])
    return run


def bins_of(x: pa.Array, problem: np.ndarray, cuts: dict, d: int, n_bins: int) -> np.ndarray:
    m = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), d)
    out = np.full(m.shape, n_bins - 1, np.uint8)
    for p in np.unique(problem):
        rows = np.flatnonzero(problem == p)
        for i in range(d):
            v = m[rows, i]
            out[rows, i] = np.where(np.isnan(v), n_bins - 1, np.searchsorted(cuts[int(p)][i], v, side="left"))
    return out


# ---------------------------------------------------------------- the fitted model
@dataclass
class Booster:
    """Trees (problem → rounds → classes), cut points, loss curve and the round each problem is used up to."""

    n_classes: int
    n_features: int
    n_bins: int
    cuts: dict
    trees: dict
    curve: list  # (problem, round, split, log loss, accuracy)
    best: dict  # problem → rounds used

    def predict(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """``rows`` (problem, x and the columns ``keep``) → ``keep``, predicted (first largest), proba."""
        d, k, n_bins, cuts = self.n_features, self.n_classes, self.n_bins, self.cuts
        used = {p: [[t.arrays() for t in classes] for classes in self.trees[p][:self.best[p]]] for p in self.trees}
        source = rows.select("problem", "x", *keep)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                get = lambda n: batch.column(batch.schema.names.index(n))
                problem = get("problem").to_numpy(zero_copy_only=False)
                bins = bins_of(get("x"), problem, cuts, d, n_bins)
                proba = np.zeros((len(bins), k))
                for p in np.unique(problem):
                    at = np.flatnonzero(problem == p)
                    proba[at] = _softmax(_add_trees(np.zeros((len(at), k)), bins[at], used[int(p)]))
                yield pa.RecordBatch.from_arrays(
                    [get(c) for c in keep] + [pa.array(proba.argmax(axis=1).astype(np.int32)), pa.array(list(proba), pa.list_(pa.float64()))],
                    names=keep + ["predicted", "proba"])

        from pyspark.sql import types as T

        schema = T.StructType([source.schema[c] for c in keep] + [T.StructField("predicted", T.IntegerType()),
                                                                  T.StructField("proba", T.ArrayType(T.DoubleType()))])
        return source.mapInArrow(run, schema)

    def importances(self, problem: int = 0, kind: str = "gain") -> np.ndarray:
        """Per feature the mean gain of its splits, or how many there are; shares that sum to one."""
        gain, times = np.zeros(self.n_features), np.zeros(self.n_features)
        for classes in self.trees[problem][:self.best[problem]]:
            for t in classes:
                for f, g in zip(t.feature, t.gain):
                    if f >= 0:
                        gain[f] += g
                        times[f] += 1
        out = times if kind == "split" else np.divide(gain, times, out=np.zeros_like(gain), where=times > 0)
        return out / out.sum() if out.sum() else out

    def curve_table(self, spark: SparkSession) -> DataFrame:
        """(problem, round, split, loss, accuracy), one row per round and split."""
        return spark.createDataFrame(self.curve, "problem int, round int, split string, loss double, accuracy double")

    def save(self, spark: SparkSession, path: str) -> None:
        """The trees and cut points as Parquet tables below ``path``."""
        nodes = [(p, r, c, n, t.feature[n], t.bin[n], t.left[n], t.right[n], t.value[n], t.gain[n])
                 for p, rounds in self.trees.items() for r, classes in enumerate(rounds) for c, t in enumerate(classes)
                 for n in range(len(t.feature))]
        spark.createDataFrame(nodes, "problem int, round int, cls int, node int, feature int, bin int, left int, right int, "
                                     "value double, gain double").write.mode("overwrite").parquet(f"{path}/nodes")
        cuts = [(p, i, [float(x) for x in c]) for p, cs in self.cuts.items() for i, c in enumerate(cs)]
        spark.createDataFrame(cuts, "problem int, feature int, cuts array<double>").write.mode("overwrite").parquet(f"{path}/cuts")
        self.curve_table(spark).write.mode("overwrite").parquet(f"{path}/curve")
        spark.createDataFrame([(p, b, self.n_classes, self.n_features, self.n_bins) for p, b in self.best.items()],
                              "problem int, best int, n_classes int, n_features int, n_bins int").write.mode("overwrite").parquet(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Booster:
        facts = spark.read.parquet(f"{path}/facts").collect()
        trees: dict = {r.problem: [] for r in facts}
        order = ["problem", "round", "cls", "node"]
        for r in spark.read.parquet(f"{path}/nodes").orderBy(*order).toLocalIterator():
            rounds = trees[r.problem]
            if len(rounds) <= r.round:
                rounds.append([])
            if len(rounds[r.round]) <= r.cls:
                rounds[r.round].append(Tree())
            t = rounds[r.round][r.cls]
            n = t.add() if r.node else 0
            t.feature[n], t.bin[n], t.left[n], t.right[n], t.value[n], t.gain[n] = r.feature, r.bin, r.left, r.right, r.value, r.gain
        cuts: dict = {}
        for r in spark.read.parquet(f"{path}/cuts").orderBy("problem", "feature").collect():
            cuts.setdefault(r.problem, []).append(np.array(r.cuts, np.float64))
        curve = [tuple(r) for r in spark.read.parquet(f"{path}/curve").orderBy("problem", "round", "split").collect()]
        f = facts[0]
        return Booster(f.n_classes, f.n_features, f.n_bins, cuts, trees, curve, {r.problem: r.best for r in facts})


# ---------------------------------------------------------------- fitting
def fit(rows: DataFrame, problems: dict[int, Boost], n_classes: int, max_bins: int = MAX_BINS) -> Booster:
    """Boost every problem of ``rows`` (``problem_rows``) with its parameters, all in the same jobs.

    A problem stops after its rounds, or ``patience`` rounds after its best validation loss (it then uses the best
    round's trees). A problem without training rows gets no trees and predicts equal shares. Null and NaN features are
    a bin of their own at the upper end. Labels must be 0 to n_classes - 1 in training and validation rows.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    rows = cut_lineage(rows)
    sizes = rows.groupBy("problem").agg(F.max(F.size("x")), F.count("*")).collect()  # problems
    d, n, largest = (f([r[i] for r in sizes] or [0]) for f, i in ((max, 1), (sum, 2), (max, 2)))
    cuts = cut_points(rows, d, max_bins)
    cuts |= {p: [np.zeros(0)] * d for p in problems if p not in cuts}
    n_bins, k = max_bins + 1, n_classes
    trees: dict = {p: [] for p in problems}
    best: dict = {p: 0 for p in problems}
    low: dict = {p: np.inf for p in problems}
    curve: list = []
    blocks = _blocks(cuts, d, n_bins), "problem int, block binary"
    if largest <= WHOLE * ROWS_PER_TASK:
        there = sorted({r.problem for r in sizes} & set(problems))
        shares = min(k, slots(spark)) if len(there) == 1 and largest >= SHARE_ROWS else 1
        tasks = [(p, c, i * shares + c) for i, p in enumerate(there) for c in range(shares)]
        dealt = rows.mapInArrow(*blocks).join(F.broadcast(spark.createDataFrame(tasks, "problem int, share int, slot int")), "problem").repartitionById(
            max(1, len(tasks)), F.col("slot"))
        notes = _folder(spark) if shares > 1 else ""
        got = dealt.select("problem", "share", "block").mapInArrow(_whole_rounds(problems, shares, k, n_bins, notes), "problem int, round int, found binary",
                                                                   barrier=shares > 1)
        for r in sorted(got.collect(), key=lambda r: (r.problem, r.round)):  # trees
            done, losses = pickle.loads(r.found)
            trees[r.problem].append([Tree.unpacked(t) for t in done])
            _record(r.problem, r.round + 1, losses, problems[r.problem], curve, best, low)
        if notes:
            system, path = fs.FileSystem.from_uri(notes)
            system.delete_dir(path)
        for p in set(problems) - set(there):
            trees[p] = [[Tree() for _ in range(k)] for _ in range(problems[p].rounds)]
    else:
        _by_levels(rows, problems, d, k, n_bins, blocks, n, largest, trees, curve, best, low)
    for p in problems:
        best[p] = best[p] if problems[p].patience and best[p] else len(trees[p])
    return Booster(k, d, n_bins, cuts, trees, sorted(curve), best)


def _folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder, as a URI."""
    base = ensure_checkpoint_dir(spark).replace("s3a://", "s3://", 1)
    uri = f"{'file://' + base[len('file:'):] if re.match(r'file:/(?!/)', base) else base}/notes-{uuid.uuid4().hex}"
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path)
    return uri


def _by_levels(rows: DataFrame, problems: dict[int, Boost], d: int, k: int, n_bins: int, blocks: tuple, n: int, largest: int,
               trees: dict, curve: list, best: dict, low: dict) -> None:
    """Grow the trees with a job per level over ``n`` rows that are spread over the tasks."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-n // ROWS_PER_TASK), min(len(problems), cores))
    dealt = rows.repartition(parts, "problem", F.pmod(F.col("key"), F.lit(-(-largest // ROWS_PER_TASK))))

    def block(r) -> Block:
        fields = pickle.loads(r.block)
        return Block(*fields, np.zeros((len(fields[0]), k)))

    state = dealt.mapInArrow(*blocks).rdd.map(block).persist(StorageLevel.MEMORY_AND_DISK)
    since: dict = {p: [] for p in problems}  # arrays of the trees that the state's margins lack
    active, round_no = sorted(problems), 0
    while active:
        growing: dict = {}
        for p in active:
            if round_no < problems[p].rounds:
                growing[p] = {c: _Growing(problems[p], _features(problems[p], d, round_no, c)) for c in range(k)}
        first = True
        while first or any(growing.values()):
            want = first and round_no > 0
            work = {p: (since[p], round_no, problems[p], {c: (g.tree.arrays(), np.array(g.pending), g.allowed) for c, g in growing.get(p, {}).items() if g.pending},
                        want) for p in active if want or any(g.pending for g in growing.get(p, {}).values())}
            splits, losses = _run(state, work, d, n_bins, parts)
            if want:
                stop = set()
                for p in active:
                    stop |= {p} if _record(p, round_no, losses, problems[p], curve, best, low) else set()
                    if round_no >= problems[p].rounds:
                        stop.add(p)
                active = [p for p in active if p not in stop]
                for p in stop:
                    growing.pop(p, None)
            first = False
            for p in list(growing):
                for c, g in growing[p].items():
                    for node in g.pending:
                        g.learn(node, splits.get((p, c, node), NOTHING))
                if not any([g.plan() for g in growing[p].values()]):
                    done = [g.finish() for _, g in sorted(growing.pop(p).items())]
                    trees[p].append(done)
                    since[p] = since[p] + [[t.arrays() for t in done]]
        round_no += 1
        if active and round_no % REFRESH == 0:
            state, since = _renewed(state, since), {p: [] for p in problems}
    state.unpersist()


def _features(p: Boost, d: int, round_no: int, cls: int) -> np.ndarray:
    """The features that one tree may use: max(1, int(colsample * d)) of them, drawn by seed, round and class."""
    take = max(1, int(p.colsample * d + 1e-9))
    allowed = np.zeros(d, dtype=bool)
    allowed[np.random.default_rng([p.seed, round_no, cls]).permutation(d)[:take]] = True
    return allowed


def _record(p: int, rounds: int, losses: dict, par: Boost, curve: list, best: dict, low: dict) -> bool:
    """Note the losses after ``rounds`` rounds; True if the problem's patience has run out."""
    for role, name in ((TRAIN, "train"), (VAL, "val")):
        if (p, role) in losses:
            total, n, right = losses[p, role]
            curve.append((p, rounds, name, float(total / SCALE / n), float(right / n)))
            if role == VAL and curve[-1][3] < low[p]:
                low[p], best[p] = curve[-1][3], rounds
    return bool(par.patience and best[p] and rounds - best[p] >= par.patience)


def _run(state, work: dict, d: int, n_bins: int, parts: int) -> tuple[dict, dict]:
    """One job: (problem, class, node) → best split, and (problem, role) → (loss, rows, right)."""
    sent = state.mapPartitions(_level(work, d, n_bins)).reduceByKey(np.add, parts).map(
        lambda kv: kv if kv[0][0] else (kv[0], _found(kv[1], work, kv[0][1], kv[0][2])))
    splits: dict = {}
    losses: dict = {}
    for (kind, p, c, node), v in sent.collect():  # a few numbers per node
        if kind:
            losses[p, c] = v
        else:
            splits[p, c, node] = float(v[0]), int(v[1]), int(v[2]), v[3:6], v[6:9]
    return splits, losses
