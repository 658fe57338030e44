"""Random forests for many classification problems in one run.

A tree takes Poisson(1) copies of each row and the square root of the features at each node, both keyed, and splits by the
Gini index of balanced class weights on histograms of at most ``MAX_BINS`` bins, as MLlib's forest does. Several forests
(folds, parameter draws, noisy copies) are grown in the same jobs.

* The trees are independent, so they are dealt to tasks in chunks, and a chunk gets the binned rows of its problem: a byte
  a value. Trees are written as rows of a table below the checkpoint folder as they are done. The driver sees cut points,
  file names and the sums of importances, never a tree.
* A task thus holds all binned rows of one problem (64 features: 64 MB for a million rows; not split further). Counts are
  integers and draws are keyed, so the trees depend neither on the partitions nor on the chunks.
* A task that predicts reads the trees of one forest one by one and adds up their votes for up to ``BATCH`` rows. Votes are rounded to
  2^-40 and summed exactly.
"""

from __future__ import annotations

import json
import math
import pickle
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.functions.presets import SEED
from tabsmith.operators import boosting as BO
from tabsmith.session import cut_lineage, ensure_checkpoint_dir

MAX_BINS = 32
CHUNK = 50  # trees of a task
NODES = 256  # nodes whose histograms are held at a time
FEW = 64  # copies of rows in a node whose values are sorted instead
MANY = 12_000  # rows from which the features of a node are searched in turn
BATCH = 200_000  # rows that wait in a predicting task
VOTE = float(1 << 40)
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(15)])
TREES = "forest int, chunk int, tree int, importance array<double>, nodes binary"


@dataclass(frozen=True)
class Forest:
    """Parameters of one forest."""

    trees: int = 200
    depth: int = 20
    min_rows: int = 1
    seed: int = SEED


@dataclass
class Tree:
    """Nodes level by level; node 0 is the root, feature -1 marks a leaf, a right child follows its left one."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    counts: np.ndarray  # nodes x classes, weighted
    depth: np.ndarray

    def merged(self) -> Tree:
        """Two leaves that predict the same become their parent, from below."""
        feature, best = self.feature.copy(), self.counts.argmax(axis=1)
        for level in range(int(self.depth.max()), -1, -1):
            at = np.flatnonzero((self.depth == level) & (feature >= 0))
            lo = self.left[at]
            feature[at[(feature[lo] < 0) & (feature[lo + 1] < 0) & (best[lo] == best[lo + 1])]] = -1
        keep = np.zeros(len(feature), bool)
        keep[0] = True
        inner = feature >= 0
        keep[self.left[inner]] = keep[self.left[inner] + 1] = True
        place = np.cumsum(keep) - 1
        left = np.where(inner, place[np.minimum(self.left, len(place) - 1)], 0)
        return Tree(feature[keep], self.cut[keep], left[keep], self.counts[keep], self.depth[keep])

    def importance(self, d: int) -> np.ndarray:
        """Per feature the decrease of the weighted Gini index over its splits; shares of the tree."""
        at = np.flatnonzero(self.feature >= 0)
        total = self.counts.sum(axis=1)
        impurity = total - (self.counts ** 2).sum(axis=1) / total
        lo = self.left[at]
        out = np.bincount(self.feature[at], impurity[at] - impurity[lo] - impurity[lo + 1], minlength=d)
        return out / out.sum() if out.sum() else out

    def packed(self) -> bytes:
        votes = np.rint(self.counts / self.counts.sum(axis=1, keepdims=True) * VOTE)
        return pickle.dumps((self.feature.astype(np.int32), self.cut.astype(np.int16), self.left.astype(np.int32), votes), 5)


def _route(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The leaf of each binned row."""
    node = np.zeros(len(bins), np.int64)
    flat, first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    rows = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
    while len(rows):
        at = node[rows]
        at = left[at] + (flat[first[rows] + feature[at]] > cut[at])
        node[rows] = at
        rows = rows[feature[at] >= 0]
    return node


# ---------------------------------------------------------------- growing
def _bag(key: np.ndarray, par: Forest, tree: int) -> np.ndarray:
    """How often the tree takes each row."""
    return np.searchsorted(_POISSON, BO._uniform(key, par.seed, tree), side="right")


def _drawn(heap: np.ndarray, d: int, par: Forest, tree: int) -> np.ndarray:
    """The features, ascending, that each node may split by; ``heap`` is 1 at the root, 2h and 2h + 1 at h's children."""
    take = math.ceil(math.sqrt(d))
    u = BO._uniform(heap[:, None] * 65_537 + np.arange(d), par.seed + 1, tree)
    return np.sort(np.argsort(u, axis=1, kind="stable")[:, :take], axis=1)


def _histogram(values: np.ndarray, slot: np.ndarray, y: np.ndarray, count: np.ndarray, slots: int, n_bins: int, k: int) -> np.ndarray:
    """(classes, slots, bins) of one feature per slot: copies of rows."""
    return np.bincount((y * slots + slot) * n_bins + values, count, k * slots * n_bins).reshape(k, slots, n_bins)


def _score(left: np.ndarray, total: np.ndarray, weight: np.ndarray, par: Forest) -> np.ndarray:
    """What cuts leave of the weighted squares (more is better); ``left`` and ``total`` are copies, classes first."""
    n, rest = left.sum(axis=0), (total - left).sum(axis=0)
    lo = hi = lo_squares = hi_squares = 0.0
    for c, w in enumerate(weight):
        a, b = left[c] * w, (total[c] - left[c]) * w
        lo, hi, lo_squares, hi_squares = lo + a, hi + b, lo_squares + a * a, hi_squares + b * b
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((n >= par.min_rows) & (rest >= par.min_rows), lo_squares / lo + hi_squares / hi, -np.inf)


def _best(hist: np.ndarray, weight: np.ndarray, par: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one feature's histograms: (score of the best cut, its bin, the copies at or below it)."""
    left = hist.cumsum(axis=2)
    score = _score(left[:, :, :-1], left[:, :, -1:], weight, par)
    at = score.argmax(axis=1)
    rows = np.arange(len(at))
    return score[rows, at], at, left[:, rows, at].T


def _best_of_few(values: np.ndarray, slot: np.ndarray, y: np.ndarray, count: np.ndarray, total: np.ndarray, weight: np.ndarray,
                 par: Forest, n_bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_best`` of nodes with fewer rows than bins: cuts are tried at the values that occur."""
    key = slot * n_bins + values
    order = np.argsort(key)
    key, y, count = key[order], y[order], count[order]
    last = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    node, value = np.divmod(key[last], n_bins)
    before = total.cumsum(axis=0) - total
    left = np.stack([np.where(y == c, count, 0).cumsum()[last] - before[node, c] for c in range(total.shape[1])])
    score = _score(left, total[node].T, weight, par)
    top = np.maximum.reduceat(score, np.flatnonzero(np.append(True, node[1:] != node[:-1])))
    hits = np.flatnonzero(score == top[node])
    first = hits[np.searchsorted(node[hits], np.arange(len(top)))]
    return top, value[first], left[:, first].T


def _choose(values, slot: np.ndarray, y: np.ndarray, count: np.ndarray, drawn: np.ndarray, total: np.ndarray,
            weight: np.ndarray, par: Forest, n_bins: int, few: bool):
    """(feature or -1, bin, copies that go left) of each node from the best cuts of its drawn features (ties: the first).

    The features of a node are searched side by side, or in turn if the rows are many."""
    m, take = drawn.shape
    best, feature, cut, left = np.full(m, -np.inf), np.full(m, -1, np.int64), np.zeros(m, np.int64), np.zeros_like(total)
    g = take if len(slot) <= MANY else 1
    yy, cc = np.repeat(y, g), np.repeat(count, g)
    at_slot = (slot[:, None] * g + np.arange(g)).ravel()
    totals = np.repeat(total, g, axis=0)
    for j in range(0, take, g):
        v = values(drawn[slot, j:j + g]).ravel()
        score, at, low = (_best_of_few(v, at_slot, yy, cc, totals, weight, par, n_bins) if few else
                          _best(_histogram(v, at_slot, yy, cc, m * g, n_bins, len(weight)), weight, par))
        first = score.reshape(m, g).argmax(axis=1) + np.arange(m) * g
        new = score[first] > best
        first = first[new]
        best[new], feature[new], cut[new], left[new] = score[first], drawn[new, j + first % g], at[first], low[first]
    w = total * weight
    before = (w * w).sum(axis=1) / w.sum(axis=1)
    feature[~(best > before * (1 + 1e-12))] = -1
    return feature, cut, left


def _open(total: np.ndarray, depth: int, par: Forest) -> np.ndarray:
    """Nodes that may be split: neither pure nor too small nor too deep."""
    return ((total > 0).sum(axis=1) > 1) & (total.sum(axis=1) >= 2 * par.min_rows) & (depth < par.depth)


def _grow(bins: np.ndarray, y: np.ndarray, count: np.ndarray, weight: np.ndarray, par: Forest, tree: int, n_bins: int) -> Tree:
    """One tree, level by level."""
    k, d = len(weight), bins.shape[1]
    flat = bins.ravel()
    rows = np.flatnonzero(count)
    depth = 0
    total = np.bincount(y[rows], count[rows], k)[None, :]
    heap, parts, n_nodes = np.array([1], np.int64), [], 1
    slot = np.zeros(len(rows), np.int64)
    while True:
        m = len(heap)
        feature, cut, left = np.full(m, -1, np.int64), np.zeros(m, np.int64), np.zeros((m, k))
        alive = _open(total, depth, par)
        keep = alive[slot]  # rows lie in the order of their nodes
        rows, slot = rows[keep], slot[keep]
        few = total.sum(axis=1) <= FEW
        for nodes, little, step in ((np.flatnonzero(alive & ~few), False, NODES), (np.flatnonzero(alive & few), True, NODES * 16)):
            at = np.flatnonzero(few[slot] == little)
            ends = np.searchsorted(slot[at], nodes, side="right")
            for a in range(0, len(nodes), step):
                some = nodes[a:a + step]
                part = at[(ends[a - 1] if a else 0):ends[min(a + step, len(nodes)) - 1]]
                r = rows[part]
                first = (r * d)[:, None]
                feature[some], cut[some], left[some] = _choose(
                    lambda f: flat[first + f], np.searchsorted(some, slot[part]), y[r], count[r],  # noqa: B023
                    _drawn(heap[some], d, par, tree), total[some], weight, par, n_bins, little)
        split = np.flatnonzero(feature >= 0)
        first_child = np.zeros(m, np.int64)
        first_child[split] = n_nodes + 2 * np.arange(len(split))
        parts.append((feature, cut, first_child, total * weight, np.full(m, depth)))
        if not len(split):
            return Tree(*(np.concatenate(x) for x in zip(*parts)))
        n_nodes += 2 * len(split)
        keep = feature[slot] >= 0
        rows, slot = rows[keep], slot[keep]
        child = np.zeros(m, np.int64)
        child[split] = 2 * np.arange(len(split))
        slot = child[slot] + (flat[rows * d + feature[slot]] > cut[slot])
        order = np.argsort(slot, kind="stable")
        rows, slot = rows[order], slot[order]
        total = np.stack([left[split], total[split] - left[split]], axis=1).reshape(-1, k)
        heap = np.stack([2 * heap[split], 2 * heap[split] + 1], axis=1).ravel()
        depth += 1


def _rows_of(blobs: list) -> tuple[np.ndarray, ...]:
    """(label, key, bins) of pickled blocks."""
    return tuple(np.concatenate(x) for x in zip(*map(pickle.loads, blobs)))


def _grower(forests: dict, weights: dict, n_bins: int):
    """Task that grows the chunk of trees its rows are marked with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for batch in batches:
            for forest, chunk, first, count, blob in zip(*(batch.column(i).to_pylist() for i in range(5))):
                found.setdefault((forest, chunk, first, count), []).append(blob)
        for (forest, chunk, first, count), blobs in sorted(found.items(), key=lambda x: x[0]):
            problem, par = forests[forest]
            y, key, bins = _rows_of(blobs)
            for tree in range(first, first + count):
                yield _tree_row(forest, chunk, tree, _grow(bins, y, _bag(key, par, tree), weights[problem], par, tree, n_bins), bins.shape[1])
    return run


def _tree_row(forest: int, chunk: int, tree: int, grown: Tree, d: int) -> pa.RecordBatch:
    grown = grown.merged()
    return pa.RecordBatch.from_arrays([pa.array([forest], pa.int32()), pa.array([chunk], pa.int32()), pa.array([tree], pa.int32()),
                                       pa.array([grown.importance(d)], pa.list_(pa.float64())), pa.array([grown.packed()], pa.binary())],
                                      names=["forest", "chunk", "tree", "importance", "nodes"])


# ---------------------------------------------------------------- binning
def problem_rows(df: DataFrame, cols: list[str], label: str, key: str, problem: Column | None = None) -> DataFrame:
    """Training rows for ``fit``: (problem, role, label, key, x); labels must be 0 to n_classes - 1."""
    x = F.array(*[F.col(c).cast("double") for c in cols])
    y = F.col(label).cast("int")
    return df.select((F.lit(0) if problem is None else problem).cast("int").alias("problem"), F.lit(BO.TRAIN).alias("role"),
                     F.when(y.isNull(), F.raise_error(F.lit("labels must not be null"))).otherwise(y).alias("label"),
                     F.when(F.col(key).isNull(), F.xxhash64(x)).otherwise(F.xxhash64(key)).alias("key"), x.alias("x"))


def _blocks(cuts: dict, d: int, n_bins: int):
    """Rows → one pickled block per problem and batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            num = lambda n: batch.column(batch.schema.names.index(n)).to_numpy(zero_copy_only=False)
            problem, y, key = num("problem"), num("label").astype(np.int64), num("key")
            bins = BO.bins_of(batch.column(batch.schema.names.index("x")), problem, cuts, d, n_bins)
            for p in np.unique(problem):
                at = np.flatnonzero(problem == p)
                yield pa.RecordBatch.from_arrays([pa.array([int(p)], pa.int32()), pa.array([pickle.dumps((y[at], key[at], bins[at]), 5)], pa.binary())],
                                                 names=["problem", "block"])
    return run


# ---------------------------------------------------------------- the fitted model
def _read_trees(files: list[str]) -> Iterator[tuple]:
    """(tree, feature, cut, left, votes) of the files in turn, a few trees in memory at a time."""
    import pyarrow.parquet as pq

    from pyarrow import fs

    for uri in files:
        system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
        with system.open_input_file(path) as source:
            for batch in pq.ParquetFile(source, buffer_size=1 << 20).iter_batches(8, columns=["tree", "nodes"]):
                for tree, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield tree, *pickle.loads(blob.as_py())


@dataclass
class Forests:
    """Grown forests: the table of trees at ``path`` (a file per chunk of trees), cut points, and each forest's problem."""

    n_classes: int
    n_features: int
    n_bins: int
    cuts: dict
    problems: dict  # forest → problem
    path: str
    files: dict  # forest → URIs of its trees in order

    @staticmethod
    def at(spark: SparkSession, n_classes: int, n_features: int, n_bins: int, cuts: dict, problems: dict, path: str) -> Forests:
        found: dict = {f: [] for f in problems}
        for uri in spark.read.schema(TREES).parquet(path).inputFiles():
            f, c = re.search(r"/forest=(\d+)/chunk=(\d+)/", uri).groups()
            found[int(f)].append((int(c), "file://" + uri[len("file:"):] if re.match(r"file:/(?!//)", uri) else uri))
        return Forests(n_classes, n_features, n_bins, cuts, problems, path, {f: [uri for _, uri in sorted(x)] for f, x in found.items()})

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(TREES).parquet(self.path)

    def _votes(self, sizes: list[int] | None = None):
        """(forest, x as an Arrow array) → votes after all trees, or an iterator of (size, votes) for numbers of trees."""
        d, k, n_bins, cuts, problems, files = self.n_features, self.n_classes, self.n_bins, self.cuts, self.problems, self.files

        def steps(forest: int, bins: np.ndarray):
            votes, n = np.zeros((len(bins), k)), 0
            for _, feature, cut, left, share in _read_trees(files[forest]):
                votes += share[_route(feature, cut, left, bins)]
                n += 1
                if sizes is None or n in sizes:
                    yield n, votes
            if not n:
                yield 0, votes + 1.0  # a problem without rows: equal shares

        def binned(x: pa.Array, forest: int) -> np.ndarray:
            return BO.bins_of(x, np.full(len(x), problems[forest]), cuts, d, n_bins)

        return steps, binned

    def predict(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """``rows`` (forest, x and the columns ``keep``) → ``keep``, predicted (first largest), proba."""
        k = self.n_classes
        steps, binned = self._votes()
        source = rows.select("forest", "x", *keep)

        def scored(waiting: list) -> Iterator[pa.RecordBatch]:
            """All waiting rows of a forest meet each of its trees once."""
            forest = np.concatenate([f for f, _, _ in waiting])
            bins = np.concatenate([b for _, b, _ in waiting])
            proba = np.zeros((len(bins), k))
            for f in np.unique(forest):
                at = np.flatnonzero(forest == f)
                for _, votes in steps(int(f), bins[at]):
                    pass
                proba[at] = votes / votes.sum(axis=1, keepdims=True)
            start = 0
            for f, _, kept in waiting:
                p = proba[start:start + len(f)]
                start += len(f)
                yield pa.RecordBatch.from_arrays(kept + [pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(list(p), pa.list_(pa.float64()))],
                                                 names=keep + ["predicted", "proba"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting, n = [], 0
            for batch in batches:
                get = lambda c: batch.column(batch.schema.names.index(c))
                forest, x = get("forest").to_numpy(zero_copy_only=False), get("x")
                bins = np.zeros((len(forest), self_d), np.uint8)
                for f in np.unique(forest):
                    at = np.flatnonzero(forest == f)
                    bins[at] = binned(x.take(pa.array(at)), int(f))
                waiting.append((forest, bins, [get(c) for c in keep]))
                n += len(forest)
                if n >= BATCH:
                    yield from scored(waiting)
                    waiting, n = [], 0
            if waiting:
                yield from scored(waiting)

        self_d = self.n_features
        schema = T.StructType([source.schema[c] for c in keep] + [T.StructField("predicted", T.IntegerType()),
                                                                  T.StructField("proba", T.ArrayType(T.DoubleType()))])
        cores, m = rows.sparkSession.sparkContext.defaultParallelism, len(self.files)
        if m == 1:
            return source.coalesce(cores).mapInArrow(run, schema)  # each task reads the trees, so there are no more than cores
        each = -(-2 * cores // m)  # of several forests a task reads one
        place = F.pmod(F.col("forest"), F.lit(m)) * each + F.pmod(F.xxhash64("x"), F.lit(each)).cast("int")
        return source.repartitionById(m * each, place).mapInArrow(run, schema)

    def prefix_hits(self, rows: DataFrame, sizes: list[int], forest: int = 0) -> DataFrame:
        """``rows`` (y, x) → (n_trees, right, n) of the first n trees for each n in ``sizes``, a row per task and size."""
        steps, binned = self._votes(sizes)

        def scored(parts: list, y: np.ndarray) -> Iterator[pa.RecordBatch]:
            for n, votes in steps(forest, np.concatenate(parts)):
                if n in sizes:
                    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([int((votes.argmax(axis=1) == y).sum())]),
                                                      pa.array([len(y)])], names=["n_trees", "right", "n"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, ys = [], []
            for batch in batches:
                if batch.num_rows:
                    parts.append(binned(batch.column(1), forest))
                    ys.append(batch.column(0).to_numpy(zero_copy_only=False))
                if sum(map(len, ys)) >= BATCH:
                    yield from scored(parts, np.concatenate(ys))
                    parts, ys = [], []
            if parts:
                yield from scored(parts, np.concatenate(ys))

        cores = rows.sparkSession.sparkContext.defaultParallelism
        return rows.select("y", "x").coalesce(cores).mapInArrow(run, "n_trees int, right long, n long")

    def importances(self, spark: SparkSession, forest: int = 0) -> np.ndarray:
        """The mean of the trees' shares per feature; shares that sum to one."""
        rows = self.table(spark).where(F.col("forest") == forest).select(F.posexplode("importance")).groupBy("pos").agg(
            F.sum("col").alias("s")).collect()  # features
        out = np.zeros(self.n_features)
        for r in rows:
            out[r.pos] = r.s
        return out / out.sum() if out.sum() else out

    def nodes(self, spark: SparkSession, forest: int = 0) -> DataFrame:
        """(tree, node, feature, threshold, left, right, votes); feature -1 marks a leaf, votes sum to one."""
        cuts = self.cuts[self.problems[forest]]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                    feature, cut, left, votes = pickle.loads(blob.as_py())
                    inner = feature >= 0
                    at = [cuts[f][c] if f >= 0 and c < len(cuts[f]) else math.inf if f >= 0 else 0.0 for f, c in zip(feature, cut)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(feature), tree, np.int32)), pa.array(np.arange(len(feature), dtype=np.int32)), pa.array(feature),
                         pa.array(at, pa.float64()), pa.array(np.where(inner, left, -1).astype(np.int32)),
                         pa.array(np.where(inner, left + 1, -1).astype(np.int32)),
                         pa.array(list(votes / votes.sum(axis=1, keepdims=True)), pa.list_(pa.float64()))],
                        names=["tree", "node", "feature", "threshold", "left", "right", "votes"])

        return self.table(spark).where(F.col("forest") == forest).select("tree", "nodes").mapInArrow(
            run, "tree int, node int, feature int, threshold double, left int, right int, votes array<double>")

    def save(self, spark: SparkSession, path: str) -> None:
        """The trees and cut points as Parquet tables below ``path``."""
        _write(self.table(spark).repartition("forest", "chunk").sortWithinPartitions("forest", "chunk", "tree"), f"{path}/trees")
        cuts = [(p, i, [float(v) for v in c]) for p, cs in self.cuts.items() for i, c in enumerate(cs)]
        spark.createDataFrame(cuts, "problem int, feature int, cuts array<double>").write.mode("overwrite").parquet(f"{path}/cuts")
        facts = json.dumps([self.n_classes, self.n_features, self.n_bins, sorted(self.problems.items())])
        spark.createDataFrame([(facts,)], "facts string").write.mode("overwrite").parquet(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forests:
        k, d, n_bins, problems = json.loads(spark.read.parquet(f"{path}/facts").first().facts)
        cuts: dict = {}
        for r in spark.read.parquet(f"{path}/cuts").orderBy("problem", "feature").collect():
            cuts.setdefault(r.problem, []).append(np.array(r.cuts, np.float64))
        return Forests.at(spark, k, d, n_bins, cuts, {f: p for f, p in problems}, f"{path}/trees")


def _write(trees: DataFrame, path: str) -> None:
    trees.write.mode("overwrite").partitionBy("forest", "chunk").parquet(path)


# ---------------------------------------------------------------- fitting
def fit(rows: DataFrame, forests: dict[int, tuple[int, Forest]], n_classes: int, max_bins: int = MAX_BINS) -> Forests:
    """Grow every forest (number → (problem, parameters)) on the rows of its problem (``problem_rows``), all in the same jobs.

    A problem without rows gets no trees and predicts equal shares. Null and NaN features lie above all others.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    rows = cut_lineage(rows)
    n_bins, cores = max_bins + 1, spark.sparkContext.defaultParallelism
    d = rows.agg(F.max(F.size("x"))).first()[0] or 0
    weights, sizes = {}, {}
    for r in rows.groupBy("problem", "label").agg(F.count("*").alias("n")).collect():  # problems x classes
        weights.setdefault(r.problem, np.zeros(n_classes))[r.label] = 1.0 / r.n
        sizes[r.problem] = sizes.get(r.problem, 0) + r.n
    weights = {p: w * sizes[p] / (w > 0).sum() for p, w in weights.items()}
    cuts = BO.cut_points(rows, d, max_bins)
    blocks = rows.mapInArrow(_blocks(cuts, d, n_bins), "problem int, block binary")
    cuts |= {p: [np.zeros(0)] * d for p, _ in forests.values() if p not in cuts}
    grown = {f: v for f, v in forests.items() if sizes.get(v[0])}
    each = min(CHUNK, max(1, -(-sum(par.trees for _, par in grown.values()) // (3 * cores))))
    deal = [(problem, f, c, first, min(each, par.trees - first)) for f, (problem, par) in sorted(grown.items())
            for c, first in enumerate(range(0, par.trees, each))]
    slots = spark.createDataFrame([(*x, i) for i, x in enumerate(deal)], "problem int, forest int, chunk int, first int, count int, slot int")
    dealt = blocks.join(F.broadcast(slots), "problem").repartitionById(max(1, len(deal)), F.col("slot"))  # a row per chunk of trees
    trees = dealt.select("forest", "chunk", "first", "count", "block").mapInArrow(_grower(grown, weights, n_bins), TREES)
    path = f"{ensure_checkpoint_dir(spark)}/forests-{uuid.uuid4().hex}"
    _write(trees, path)
    return Forests.at(spark, n_classes, d, n_bins, cuts, {f: problem for f, (problem, _) in forests.items()}, path)
