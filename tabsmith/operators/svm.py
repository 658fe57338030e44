"""One-vs-rest linear SVMs on the columns themselves, on their monomials (poly) or on random Fourier features (rbf).

The objective and its steps are those of MLlib's ``LinearSVC``: weighted hinge loss on columns scaled to unit variance,
an L2 penalty, OWL-QN. What differs is the work of a step. All classes take theirs together, so the rows are read once a
step and not once a class; rows stay as wide as the given columns, since a task maps a block when it reads it; and the
cubic map is never written out: w.phi(x) is the sum over k of x_k (Q W)_k with Q the monomials of one degree less, two
products of matrices in place of 5,455 columns at 30 inputs.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions.presets import SEED

BLOCK = 1000  # rows that a task maps at once
MEMORY = 10  # steps that the inverse Hessian is built from
FEW = 32  # answers that the driver adds up itself


class Columns:
    """The columns as they are."""

    def __init__(self, n_features: int) -> None:
        self.width = n_features

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Mapped rows."""
        return x

    def opened(self, x: np.ndarray):
        """What ``margins`` and ``sums`` of a block share."""
        return self.rows(x)

    def margins(self, opened, w: np.ndarray) -> np.ndarray:
        """Mapped rows times each row of ``w``."""
        return opened @ w.T

    def sums(self, opened, r: np.ndarray) -> np.ndarray:
        """Per column of ``r``, the mapped rows added up with these factors."""
        return r.T @ opened


class Fourier(Columns):
    """Random Fourier features for the RBF kernel (Rahimi & Recht 2007):
    z(x) = sqrt(2/D) · cos(W x + b), W ~ N(0, 2·gamma), b ~ U(0, 2π). W is a small (D x d) matrix fixed by the seed."""

    def __init__(self, n_features: int, gamma: float, n_components: int = 256, seed: int = SEED) -> None:
        super().__init__(n_components)
        rng = np.random.default_rng(seed)
        self.w = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_components, n_features))
        self.b = rng.uniform(0.0, 2 * math.pi, size=n_components)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return math.sqrt(2.0 / self.width) * np.cos(x @ self.w.T + self.b)


class Monomials(Columns):
    """All products of 1 to ``degree`` columns, each as a product of one factor less (``parent``; 0 is the empty one)
    and its last column (``last``)."""

    def __init__(self, n_features: int, degree: int = 3) -> None:
        self.n, self.parent, self.last, self.grown = n_features, [], [], []
        place, level = {(): 0}, [()]
        for d in range(1, degree + 1):
            level = list(combinations_with_replacement(range(n_features), d))
            at = len(self.parent)
            self.parent += [place[m[:-1]] for m in level]
            self.last += [m[-1] for m in level]
            if d < degree:
                self.grown.append((at, at + len(level)))
                place |= {m: len(place) + i for i, m in enumerate(level)}
        self.parent, self.last = np.array(self.parent), np.array(self.last)
        super().__init__(len(self.parent))

    def _lower(self, x: np.ndarray) -> np.ndarray:
        q = np.ones((len(x), 1 + (self.grown[-1][1] if self.grown else 0)))
        for a, b in self.grown:
            q[:, 1 + a:1 + b] = q[:, self.parent[a:b]] * x[:, self.last[a:b]]
        return q

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self._lower(x)[:, self.parent] * x[:, self.last]

    def opened(self, x: np.ndarray):
        return self._lower(x), x

    def margins(self, opened, w: np.ndarray) -> np.ndarray:
        q, x = opened
        full = np.zeros((q.shape[1], len(w), self.n))
        full[self.parent, :, self.last] = w.T
        return np.einsum("rkn,rn->rk", (q @ full.reshape(q.shape[1], -1)).reshape(len(q), len(w), self.n), x)

    def sums(self, opened, r: np.ndarray) -> np.ndarray:
        q, x = opened
        full = q.T @ (r[:, :, None] * x[:, None, :]).reshape(len(q), -1)
        return full.reshape(q.shape[1], r.shape[1], self.n)[self.parent, :, self.last].T


def feature_map(n_features: int, params: dict | None = None) -> Columns:
    """The map of a kernel; ``params`` has the original's parameter names."""
    p = params or {}
    kernel, gamma = p.get("kernel", "rbf"), p.get("gamma", "scale")
    if kernel not in ("rbf", "poly", "linear"):
        raise ValueError(f"unknown kernel {kernel!r}; use 'rbf', 'poly' or 'linear'")
    if kernel == "rbf":
        # 'scale' and 'auto' agree on standardised columns
        return Fourier(n_features, 1.0 / n_features if gamma in ("scale", "auto") else float(gamma), p.get("n_components", 256))
    return Monomials(n_features, p.get("degree", 3)) if kernel == "poly" else Columns(n_features)


def blocks(rows: DataFrame) -> RDD:
    """Rows (x array, y, w) as blocks of matrices (x, y, w), kept in the partitions that they come in."""
    def run(part: Iterator) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        x, y, w = [], [], []

        def block():
            return np.array(x, float), np.array(y, np.int64), np.array(w, float)  # a null label raises

        for r in part:
            x.append(r.x)
            y.append(r.y)
            w.append(r.w)
            if len(x) == BLOCK:
                yield block()
                x, y, w = [], [], []
        if x:
            yield block()

    return rows.select("x", "y", "w").rdd.mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK)


def _merged(a, b):
    """Weight, its squares, means and squared distances from them, of two sets of rows together."""
    total, gap = a[0] + b[0], b[2] - a[2]
    return total, a[1] + b[1], a[2] + gap * (b[0] / total), a[3] + b[3] + gap * gap * (a[0] * b[0] / total)


def _moments(kept: RDD, mapped: Columns):
    def run(part):
        out = None
        for x, _, w in part:
            for at in range(0, len(x), 250):  # the map is written out here
                z, v = mapped.rows(x[at:at + 250]), w[at:at + 250]
                mean = v @ z / v.sum()
                one = v.sum(), v @ v, mean, v @ (z - mean) ** 2
                out = one if out is None else _merged(out, one)
        return [] if out is None else [out]

    return _together(kept.mapPartitions(run), _merged)


def _together(answers: RDD, add):
    if answers.getNumPartitions() > FEW:
        return answers.treeReduce(add)
    got = answers.collect()
    out = got[0]
    for x in got[1:]:
        out = add(out, x)
    return out


def descend(width: int, steps: int, tol: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """OWL-QN from zero, without a penalty of its own: yields points, is sent their (value, gradient), returns the last.

    A step keeps the signs of the point that it leaves (a coordinate that would pass zero stops there)."""
    x = np.zeros(width)
    value, grad = yield x
    first, recent, past, failed, at = abs(value), [math.inf], [], False, 0
    while at < steps and not (len(recent) > 1 and abs(value - max(recent)) <= tol * first):
        size = np.linalg.norm(grad)
        if size <= max(tol * value, 1e-8):
            break
        d, ahead = _direction(past, grad), None
        if d is not None:
            d = np.where(d * grad < 0, d, 0.0)
            slope, signs = float(grad @ d), np.where(x != 0, np.sign(x), np.sign(-grad))
            shrink, alpha = (0.1, 0.5 / size) if at < 1 else (0.5, 1.0)
            for _ in range(20):
                there = x + alpha * d
                there = there * (np.sign(there) == signs)
                ahead = there, *(yield there)
                rise = float(ahead[2] @ d)
                if ahead[1] > value + alpha * slope * 1e-4:
                    alpha *= shrink
                elif rise < 0.9 * slope:
                    alpha *= 2.1
                elif rise > -0.9 * slope:
                    alpha *= shrink
                else:
                    break
                if not 1e-10 <= alpha <= 1e10:
                    ahead = None
                    break
        if ahead is None:  # no such step: once more without the past, then enough
            if failed:
                break
            failed, past = True, []
            continue
        past = [(ahead[0] - x, ahead[2] - grad), *past][:MEMORY]
        x, value, grad = ahead
        recent, failed, at = [*recent, value][-20:], False, at + 1
    return x


def _direction(past: list, grad: np.ndarray) -> np.ndarray | None:
    """Minus the approximate inverse Hessian times the gradient; None where the past steps allow none."""
    d, factors, scale = grad.copy(), [], 1.0
    if past:
        s, y = past[0]
        scale = s @ y / (y @ y) if y @ y else math.nan
        if not s @ y >= 0 or math.isnan(scale):
            return None
    for s, y in past:
        rho = s @ y
        factors.append((s @ d / rho if rho else math.nan, rho))
        if math.isnan(factors[-1][0]):
            return None
        d -= factors[-1][0] * y
    d *= scale
    for (s, y), (a, rho) in zip(reversed(past), reversed(factors)):
        d += (a - y @ d / rho) * s
    return -d


@dataclass
class Machine:
    """Fitted margins: a row of coefficients over the mapped columns and an intercept for each class."""

    mapped: Columns
    coefs: np.ndarray
    intercepts: np.ndarray

    def predict(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """(*keep, predicted, proba) of rows with ``x``: the first largest margin, and the softmax of all (uncalibrated)."""
        fields = [rows.schema[c] for c in keep]
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["predicted int", "proba array<double>"])

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                out = pdf[keep].copy()
                x = np.array(pdf["x"].tolist(), float).reshape(len(pdf), -1)
                m = [self.mapped.margins(self.mapped.opened(x[at:at + BLOCK]), self.coefs) + self.intercepts for at in range(0, len(x), BLOCK)]
                m = np.concatenate(m) if m else np.zeros((0, len(self.intercepts)))
                e = np.exp(m - m.max(axis=1, keepdims=True)) if len(m) else m
                out["predicted"] = m.argmax(axis=1).astype(np.int32) if len(m) else np.zeros(0, np.int32)
                out["proba"] = list(e / e.sum(axis=1, keepdims=True)) if len(m) else []
                yield out

        return rows.select(*keep, "x").mapInPandas(run, schema)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, float(b), [float(v) for v in c]) for i, (c, b) in enumerate(zip(self.coefs, self.intercepts))]
        spark.createDataFrame(rows, "class int, intercept double, coefs array<double>").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, mapped: Columns) -> Machine:
        rows = spark.read.parquet(path).orderBy("class").collect()  # a row a class
        return Machine(mapped, np.array([r.coefs for r in rows]), np.array([r.intercept for r in rows]))


def fit(kept: RDD, mapped: Columns, n_classes: int, reg: float, steps: int = 50, tol: float = 1e-3) -> Machine:
    """Each class against the others, over ``blocks``; a step of all classes is one job."""
    total, squares, mean, spread = _moments(kept, mapped)
    std = np.sqrt(np.maximum(spread / (total - squares / total), 0.0)) if total > squares / total else np.zeros(mapped.width)
    unit = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
    center = unit * mean
    runs = {c: descend(mapped.width + 1, steps, tol) for c in range(n_classes)}
    asked, found = {c: next(r) for c, r in runs.items()}, {}
    while asked:
        classes = list(asked)
        points = np.array([asked[c] for c in classes])
        w = points[:, :-1] * unit
        offset = points[:, -1] - points[:, :-1] @ center
        loss, factors, sums = _step(kept, mapped, classes, w, offset)
        for i, c in enumerate(classes):
            own = points[i, :-1]
            grad = np.append((unit * sums[i] - center * factors[i]) / total + reg * own, factors[i] / total)
            try:
                asked[c] = runs[c].send((loss[i] / total + 0.5 * reg * float(own @ own), grad))
            except StopIteration as end:
                found[c] = end.value
                del asked[c]
    last = np.array([found[c] for c in range(n_classes)])
    return Machine(mapped, last[:, :-1] * unit, last[:, -1] - last[:, :-1] @ center)


def _step(kept: RDD, mapped: Columns, classes: list[int], w: np.ndarray, offset: np.ndarray):
    """Of each class: its loss, the sum of the rows' factors in the gradient, and the mapped rows added up with them."""
    sc = kept.context
    sent = sc.broadcast((w, offset))

    def run(part):
        w, offset = sent.value
        out = None
        for x, y, weight in part:
            opened = mapped.opened(x)
            side = np.where(y[:, None] == np.array(classes), 1.0, -1.0)
            short = 1.0 - side * (mapped.margins(opened, w) + offset)
            r = np.where(short > 0, -side * weight[:, None], 0.0)
            one = weight @ np.maximum(short, 0.0), r.sum(axis=0), mapped.sums(opened, r)
            out = one if out is None else _added(out, one)
        return [] if out is None else [out]

    try:
        return _together(kept.mapPartitions(run), _added)
    finally:
        sent.destroy()


def _added(a, b):
    return tuple(p + q for p, q in zip(a, b))


def columns(cols: list[str]):
    """The columns as one array; a missing value is NaN."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(math.nan)) for c in cols])


def rows_of(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """(x, y, w) of a training table with balanced weights ``w``."""
    return df.select(columns(cols).alias("x"), F.col(label).cast("int").alias("y"), "w")
