"""Exact k-nearest-neighbour search as a Spark job (used by I1, M2, M2b, T2, T3, A9).

Plan (no driver collection, bounded memory per task, whatever the sizes):

* queries get a block id and donors a bucket id (hash of the key); queries
  are replicated over the D donor buckets and donors over the Q query blocks,
  so every (query, donor) pair meets in exactly one (block, bucket) group;
  Q and D are chosen from the row counts of the largest ``by`` group, so that
  a task holds at most ``query_rows`` queries and ``donor_rows`` donors and the
  number of problems in a run does not multiply the copies of each;
* ``cogroup(...).applyInPandas`` searches tile by tile and keeps per query its
  k nearest donors of the group, ties to the smaller id as in the final order.
  A tile that lies too far away along the widest column is skipped; in the
  others a matrix product bounds all distances, with its rounding error, and
  only pairs that may be among the k nearest get their exact distance;
* a window ``row_number() OVER (PARTITION BY query ORDER BY dist, donor)``
  keeps k: ``WindowGroupLimit`` prunes before the shuffle.

Total work is |queries| x |donors| bounds, unless tiles can be skipped.

A search that fills missing values and has more donors than fit a task cuts them
into ranges of one column instead (``_fill_search``): a query gets a bound of its
k-th distance from some donors of its own range and then meets only the ranges
within that bound, so neither side is copied for every group of the other.
Distances sum coordinates in column order (same float result as SQL).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.session import hold

QUERY_ROWS = 32_768
DONOR_ROWS = 100_000
SLICE_CELLS = 4_000_000  # query-slice x donors per numpy temporary
BOUND_SHARE = 8  # one of so many donors of a range bounds the distances
MANY_PAIRS = 20_000_000  # of all groups: from here on a search has tasks for all cores
TILE = 2048  # donors per tile
SLICE = {"euclidean": 256, "manhattan": 64}  # queries per tile
LARGEST = 1e150  # beyond, squares leave the doubles and bounds say nothing


def _block_dist(q: np.ndarray, d: np.ndarray, metric: str, nan_aware: bool) -> np.ndarray:
    """Distances between every row of q and every row of d (coordinates in order)."""
    nq, nd = q.shape[0], d.shape[0]
    acc = np.zeros((nq, nd))
    if nan_aware:
        present = np.zeros((nq, nd))
    for j in range(q.shape[1]):
        diff = q[:, j][:, None] - d[:, j][None, :]
        term = diff * diff if metric == "euclidean" else np.abs(diff)
        if nan_aware:
            ok = ~np.isnan(term)
            acc = acc + np.where(ok, term, 0.0)
            present = present + ok
        else:
            acc = acc + term
    if nan_aware:
        with np.errstate(divide="ignore", invalid="ignore"):
            acc = np.where(present > 0, acc * (q.shape[1] / present), np.nan)
    return np.sqrt(acc) if metric == "euclidean" else acc


def _topk_rows(dist: np.ndarray, k: int, donor: np.ndarray):
    """(query index, donor index) of each query's k nearest donors at a finite distance, ties to the smaller id.

    Vectorised: one ``np.partition`` along the donor axis (NaN sorts last) bounds the candidates; of those that tie at
    the bound only as many as are missing stay, so no query returns more than k rows however many donors are equal."""
    if dist.shape[1] == 0 or dist.shape[0] == 0:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    kk = min(k, dist.shape[1])
    kth = np.partition(dist, kk - 1, axis=1)[:, kk - 1]
    kth = np.where(np.isnan(kth), np.inf, kth)
    qi, di = np.nonzero(dist < kth[:, None])  # fewer than k each; NaN compares False
    rank = np.argsort(donor, kind="stable")
    tied = dist[:, rank] == kth[:, None]  # donors in id order
    missing = kk - np.bincount(qi, minlength=dist.shape[0])
    first = tied & (np.cumsum(tied, axis=1) <= missing[:, None])
    ti, tj = np.nonzero(first)
    return np.concatenate((qi, ti)), np.concatenate((di, rank[tj]))


class _Best:
    """The k nearest donors of each query so far: distances (inf: none yet), donor ids and donor rows, in order."""

    def __init__(self, n: int, k: int, ids: np.ndarray):
        self.k, self.ids = k, ids
        self.dist = np.full((n, k), np.inf)
        self.row = np.full((n, k), -1)

    def copy(self) -> _Best:
        other = _Best(len(self.dist), self.k, self.ids)
        other.dist, other.row = self.dist.copy(), self.row.copy()
        return other

    def offer(self, q: np.ndarray, row: np.ndarray, dist: np.ndarray) -> None:
        """Pairs (query, donor row) with their distances; a donor is offered once to a query."""
        last, held = self.dist[q, -1], self.row[q, -1]
        keep = (dist < last) | ((dist == last) & (self.ids[row] < self.ids[held]) & (held >= 0))
        q, row, dist = q[keep], row[keep], dist[keep]
        if not len(q):
            return
        at, q = np.unique(q, return_inverse=True)
        old = self.row[at].ravel()
        q = np.concatenate((np.repeat(np.arange(len(at)), self.k)[old >= 0], q))
        dist = np.concatenate((self.dist[at].ravel()[old >= 0], dist))
        row = np.concatenate((old[old >= 0], row))
        order = np.lexsort((self.ids[row], dist, q))
        q, row, dist = q[order], row[order], dist[order]
        place = np.arange(len(q)) - np.searchsorted(q, np.arange(len(at)))[q]
        keep = place < self.k
        self.dist[at[q[keep]], place[keep]] = dist[keep]
        self.row[at[q[keep]], place[keep]] = row[keep]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        qi, place = np.nonzero(self.row >= 0)
        return qi, self.row[qi, place], self.dist[qi, place]


def _search(q: np.ndarray, d: np.ndarray, rows: np.ndarray, best: _Best, metric: str, scale: float) -> None:
    """Offer ``best`` every donor (rows of d, numbered ``rows``) that may be among a query's k nearest; no value is missing.

    The distance is sqrt(scale x sum of squares), or scale x sum of absolute differences."""
    if not len(q) or not len(d):
        return
    euclidean = metric == "euclidean"
    widest = int(np.argmax(d.std(axis=0)))
    order = np.argsort(d[:, widest], kind="stable")
    d, rows = np.ascontiguousarray(d[order]), rows[order]
    columns = np.ascontiguousarray(d.T)
    starts = np.arange(0, len(d), TILE)
    low, high = d[starts, widest], d[np.minimum(starts + TILE, len(d)) - 1, widest]
    squares = np.einsum("ij,ij->i", d, d)
    off = 8 * np.finfo(float).eps * (q.shape[1] + 8)  # of a squared distance from squares and products, in their sum
    at = np.argsort(q[:, widest], kind="stable")
    for s in range(0, len(q), SLICE[metric]):
        mine = at[s:s + SLICE[metric]]
        x = q[mine]
        own = np.einsum("ij,ij->i", x, x)
        gap = np.maximum(0.0, np.maximum(low - x[-1, widest], x[0, widest] - high))
        reach = gap * (math.sqrt(scale) if euclidean else scale) * (1 - 1e-9)
        for t in np.argsort(reach, kind="stable"):
            last = best.dist[mine, -1]
            if reach[t] > last.max():
                break
            a, b = starts[t], min(starts[t] + TILE, len(d))
            if euclidean:
                part = x @ columns[:, a:b]
                part *= -2.0
                part += squares[a:b] * (1 - off)
                bound = last * last / scale * (1 + 1e-12) - own * (1 - off)
            else:
                part = np.zeros((len(x), b - a))
                diff = np.empty_like(part)
                for j in range(x.shape[1]):
                    np.subtract(x[:, j, None], columns[j, a:b], out=diff)
                    np.abs(diff, out=diff)
                    part += diff
                part *= scale
                bound = last
            few = np.isinf(last)
            if few.any() and b - a > best.k:
                first = np.argpartition(part, best.k - 1, axis=1)[:, :best.k]
                up = np.take_along_axis(part, first, 1)
                if euclidean:
                    up = up + 2 * off * squares[a:b][first] + 2 * off * own[:, None]
                bound = np.where(few, up.max(axis=1), bound)
            found = np.flatnonzero(part <= bound[:, None])
            if not len(found):
                continue
            qi, di = np.divmod(found, b - a)
            if euclidean:
                dist = _pair_dist(x, d[a:b], qi, di, scale)
            else:
                dist = part[qi, di]
            best.offer(mine[qi], rows[a + di], dist)


def _pair_dist(q: np.ndarray, d: np.ndarray, qi: np.ndarray, di: np.ndarray, scale: float) -> np.ndarray:
    """Euclidean distances of pairs, coordinates in order."""
    acc = np.zeros(len(qi))
    for j in range(q.shape[1]):
        diff = q[qi, j] - d[di, j]
        acc += diff * diff
    return np.sqrt(acc * scale if scale != 1.0 else acc)


def _patterns(present: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(columns present, rows) of each pattern of missing values."""
    if present.all():
        return [(np.ones(present.shape[1], bool), np.arange(len(present)))]
    kinds, which = np.unique(present, axis=0, return_inverse=True)
    which = which.ravel()
    return [(kind, np.flatnonzero(which == i)) for i, kind in enumerate(kinds)]


def _fills(q: np.ndarray, d: np.ndarray, did: np.ndarray, k: int, metric: str, wanted: list[int]):
    """Per wanted column (its position in ``wanted``, query rows, donor rows, distances) of the queries that miss it."""
    ncols = q.shape[1]
    donors = _patterns(~np.isnan(d))
    for has, mine in _patterns(~np.isnan(q)):
        needed = [j for j in wanted if not has[j]]
        shared = _Best(len(mine), k, did) if needed else None  # of the donors that have all needed columns, searched once

        def offer(best, chosen):
            for there, rows in donors:
                both = has & there
                if chosen(there) and both.any():
                    _search(q[np.ix_(mine, both)], d[np.ix_(rows, both)], rows, best, metric, ncols / both.sum())

        if needed:
            offer(shared, lambda there: there[needed].all())
        for j in needed:
            best = shared.copy()
            offer(best, lambda there: there[j] and not there[needed].all())
            qi, di, dist = best.pairs()
            yield wanted.index(j), mine[qi], di, dist


def _fills_by_pair(q: np.ndarray, d: np.ndarray, did: np.ndarray, k: int, metric: str, wanted: list[int]):
    """As ``_fills``, through the distance of every pair: for rows with hardly a pattern in common, or huge values."""
    step = max(1, SLICE_CELLS // max(1, d.shape[0] * max(1, q.shape[1] // 8)))
    for s in range(0, q.shape[0], step):
        qs = q[s:s + step]
        dist = _block_dist(qs, d, metric, True)
        for ci, j in enumerate(wanted):
            need, have = np.flatnonzero(np.isnan(qs[:, j])), np.flatnonzero(~np.isnan(d[:, j]))
            if len(need) and len(have):
                sub = dist[np.ix_(need, have)]
                qi, di = _topk_rows(sub, k, did[have])
                yield ci, s + need[qi], have[di], sub[qi, di]


def _filled(q: np.ndarray, d: np.ndarray, did: np.ndarray, k: int, metric: str, wanted: list[int]):
    """``_fills`` in the way that suits the rows."""
    kinds = len(_patterns(~np.isnan(q))) * len(_patterns(~np.isnan(d)))
    big = max(np.nanmax(np.abs(q), initial=0), np.nanmax(np.abs(d), initial=0)) > LARGEST
    run = _fills_by_pair if big or (kinds > 64 and len(q) * len(d) < kinds * 50_000) else _fills
    return run(q, d, did, k, metric, wanted)


def _nearest(q: np.ndarray, d: np.ndarray, did: np.ndarray, k: int, metric: str, step_of: np.ndarray, n_steps: int):
    """Per step (step, query rows, donor rows, distances) of the k nearest among the donors of that and earlier steps."""
    if np.isinf(q).any() or np.isinf(d).any() or max(np.nanmax(np.abs(q), initial=0), np.nanmax(np.abs(d), initial=0)) > LARGEST:
        for step in range(n_steps):
            there = np.flatnonzero(step_of <= step)
            size = max(1, SLICE_CELLS // max(1, len(there) * max(1, q.shape[1] // 8)))
            for s in range(0, len(q), size):
                dist = _block_dist(q[s:s + size], d[there], metric, False)
                qi, di = _topk_rows(dist, k, did[there])
                yield step, s + qi, there[di], dist[qi, di]
        return
    whole = np.flatnonzero(~np.isnan(q).any(axis=1))
    usable = ~np.isnan(d).any(axis=1)
    best = _Best(len(whole), k, did)
    for step in range(n_steps):
        there = np.flatnonzero(usable & (step_of == step))
        _search(q[whole], d[there], there, best, metric, 1.0)
        qi, di, dist = best.pairs()
        yield step, whole[qi], di, dist


def _make_kernel(cols: list[str], k: int, metric: str, by: list[str], impute_cols: list[str] | None, n_steps: int = 0,
                 metrics: tuple[str, ...] = ()):
    def kernel(qdf: pd.DataFrame, ddf: pd.DataFrame) -> pd.DataFrame:
        empty = _empty(by, impute_cols is not None, n_steps > 0, bool(metrics))
        if qdf.empty or ddf.empty:
            return empty
        q = qdf[cols].to_numpy(dtype=float, na_value=np.nan)
        d = ddf[cols].to_numpy(dtype=float, na_value=np.nan)
        qid = qdf["_qid"].to_numpy()
        did = ddf["_did"].to_numpy()
        parts = []
        if impute_cols is None:
            step_of = ddf["_step"].to_numpy() if n_steps else np.zeros(len(d), int)
            first = qdf["_step"].to_numpy() if n_steps else np.zeros(len(q), int)
            for name in metrics or (metric,):
                for step, qi, di, dist in _nearest(q, d, did, k, name, step_of, max(1, n_steps)):
                    own = first[qi] <= step
                    part = pd.DataFrame({"_qid": qid[qi[own]], "_did": did[di[own]], "dist": dist[own]})
                    part = part.assign(step=step) if n_steps else part
                    parts.append(part.assign(metric=name) if metrics else part)
        else:  # per missing column, candidates are donors that have it
            wanted = [cols.index(c) for c in impute_cols]
            for ci, qi, di, dist in _filled(q, d, did, k, metric, wanted):
                if "_far" in qdf:
                    near = dist <= qdf["_far"].to_numpy()[qi]
                    qi, di, dist = qi[near], di[near], dist[near]
                parts.append(pd.DataFrame({"_qid": qid[qi], "col": np.full(len(qi), ci), "_did": did[di], "dist": dist,
                                           "val": d[di, wanted[ci]]}))
        if not parts:
            return empty
        out = pd.concat(parts, ignore_index=True)
        for b in by:
            out[b] = qdf[b].iloc[0]
        return out[empty.columns]

    return kernel


def _empty(by: list[str], impute: bool, steps: bool = False, metrics: bool = False) -> pd.DataFrame:
    cols = {b: pd.Series(dtype=object) for b in [*by, *(["metric"] if metrics else [])]}
    if steps:
        cols["step"] = pd.Series(dtype="int32")
    cols["_qid"] = pd.Series(dtype="int64")
    if impute:
        cols["col"] = pd.Series(dtype="int32")
    cols["_did"] = pd.Series(dtype="int64")
    cols["dist"] = pd.Series(dtype="float64")
    if impute:
        cols["val"] = pd.Series(dtype="float64")
    return pd.DataFrame(cols)


def _group_sizes(df: DataFrame, by: list[str]) -> tuple[int, int]:
    """(groups, rows of the largest)."""
    if not by:
        return 1, df.count()
    r = df.groupBy(*by).count().agg(F.count("*").alias("groups"), F.coalesce(F.max("count"), F.lit(0)).alias("most")).first()
    return r.groups, r.most


def knn_search(queries: DataFrame, donors: DataFrame, key: str, cols: list[str], k: int,
               by: list[str] | None = None, metric: str = "euclidean", impute_cols: list[str] | None = None,
               query_rows: int = QUERY_ROWS, donor_rows: int = DONOR_ROWS, step: str | None = None, n_steps: int = 0,
               metrics: tuple[str, ...] = ()) -> DataFrame:
    """Top-k donors per query → (by..., [metric,] [step,] qid, [col,] did, dist, rn), rn = 1..k.

    ``impute_cols`` switches to NaN-aware distances and per-column candidate sets
    (donors that have the column); the output then carries the donor value.
    ``step`` names an int column of both tables, 0 to ``n_steps`` - 1: a donor is there
    from its step on, and a query is answered at its step and every later one, all
    from one pass over the pairs. With ``metrics`` the rows meet once for all of them.
    """
    by = list(by or [])
    for name in metrics or (metric,):
        if name not in ("euclidean", "manhattan"):
            raise ValueError(f"unknown metric {name!r}")
    if metrics and impute_cols:
        raise ValueError("imputation takes one metric")
    (groups, nq), (_, nd) = _group_sizes(queries, by), _group_sizes(donors, by)  # of the largest group
    if impute_cols and not by and nd > donor_rows:
        return _fill_search(queries, donors, key, cols, k, metric, impute_cols, query_rows, donor_rows, nd)
    n_blocks = max(1, math.ceil(nq / query_rows))
    n_buckets = max(1, math.ceil(nd / donor_rows))
    # big searches get at least ~2 tasks per core (extra donor buckets only
    # replicate the small query block); small ones stay in few groups
    target = math.ceil(2 * queries.sparkSession.sparkContext.defaultParallelism / max(1, groups))
    if n_blocks * n_buckets < target and nq * nd * groups > MANY_PAIRS:
        n_buckets = max(n_buckets, min(math.ceil(target / n_blocks), max(1, nd // 64)))
    h = F.xxhash64(F.col(key))
    steps = [F.col(step).cast("int").alias("_step")] if step else []
    # fresh column ids on both sides: queries and donors may share a lineage
    q = queries.select(*[F.col(b).alias(b) for b in by], F.col(key).alias("_qid"), *steps,
                       *[F.col(c).cast("double").alias(c) for c in cols],
                       F.pmod(h, F.lit(n_blocks)).cast("int").alias("_blk"))
    # group keys must have the same type on both sides (int vs long hash differently)
    q = q.withColumn("_bkt", F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1))))
    d = donors.select(*[F.col(b).alias(b) for b in by], F.col(key).alias("_did"), *steps,
                      *[F.col(c).cast("double").alias(c) for c in cols],
                      F.pmod(h, F.lit(n_buckets)).cast("int").alias("_bkt"))
    d = d.withColumn("_blk", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    by_types = {f.name: f.dataType.simpleString() for f in queries.schema.fields if f.name in by}
    schema = ", ".join([f"{b} {by_types[b]}" for b in by] + (["metric string"] if metrics else []) + (["step int"] if step else []) + ["_qid long"]
                       + (["col int"] if impute_cols else []) + ["_did long", "dist double"] + (["val double"] if impute_cols else []))
    kernel = _make_kernel(cols, k, metric, by, impute_cols, n_steps if step else 0, tuple(metrics))
    pairs = (q.groupBy(*by, "_blk", "_bkt").cogroup(d.groupBy(*by, "_blk", "_bkt"))
             .applyInPandas(kernel, schema))
    part = by + (["metric"] if metrics else []) + (["step"] if step else []) + ["_qid"] + (["col"] if impute_cols else [])
    w = Window.partitionBy(*part).orderBy("dist", "_did")
    ranked = pairs.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    return ranked.withColumnRenamed("_qid", "qid").withColumnRenamed("_did", "did")


def _pivot(donors: DataFrame, cols: list[str]) -> tuple[str, dict[str, int]]:
    """(the column that ranges are cut from: a wide one that few donors miss; donors that have each column)."""
    usable = {c: F.when(F.abs(F.col(c)) <= LARGEST, F.col(c)) for c in cols}  # neither null nor NaN nor huge
    r = donors.agg(*[F.count(x).alias(f"n_{c}") for c, x in usable.items()], *[F.stddev_pop(x).alias(f"s_{c}") for c, x in usable.items()],
                   *[F.count(F.when(~F.isnan(c), F.col(c))).alias(f"h_{c}") for c in cols]).first()
    most = max(r[f"n_{c}"] for c in cols)
    return max((c for c in cols if r[f"n_{c}"] >= 0.9 * most), key=lambda c: r[f"s_{c}"] or 0.0), {c: r[f"h_{c}"] for c in cols}


def _bound_kernel(cols: list[str], k: int, metric: str, impute_cols: list[str]):
    """Queries with ``_far``: the largest distance of a k-th donor, over the columns that they miss, among the donors here."""
    def kernel(qdf: pd.DataFrame, ddf: pd.DataFrame) -> pd.DataFrame:
        q, d = (df[cols].to_numpy(dtype=float, na_value=np.nan) for df in (qdf, ddf))
        wanted = [cols.index(c) for c in impute_cols]
        n, far = np.zeros((len(wanted), len(q)), int), np.zeros((len(wanted), len(q)))
        if len(q) and len(d):
            for ci, qi, _, dist in _filled(q, d, ddf["_did"].to_numpy(), k, metric, wanted):
                n[ci] += np.bincount(qi, minlength=len(q))
                np.maximum.at(far[ci], qi, dist)
        far[n < k] = np.inf
        far[~np.isnan(q[:, wanted]).T] = 0.0
        return qdf[["_qid", *cols]].assign(_far=far.max(axis=0, initial=0.0) * (1 + 1e-9) + 1e-150)

    return kernel


def _fill_search(queries: DataFrame, donors: DataFrame, key: str, cols: list[str], k: int, metric: str, impute_cols: list[str],
                 query_rows: int, donor_rows: int, nd: int) -> DataFrame:
    """``knn_search`` for missing values over ranges of one column, as the distance is at least the difference in any column
    that both rows have. Ranges with too many donors are dealt to several tasks, those with too many queries as well. Donors
    that miss the column are ranges of their own, which every query meets; a query that misses it meets every range."""
    doubles = [F.col(c).cast("double").alias(c) for c in cols]
    d = donors.select(F.col(key).alias("_did"), *doubles)
    q = queries.select(F.col(key).alias("_qid"), *doubles)
    pivot, have = _pivot(d, cols)
    impute_cols = list(impute_cols)
    sought = [c for c in impute_cols if have[c]]
    cores = d.sparkSession.sparkContext.defaultParallelism
    n_ranges = max(math.ceil(nd / donor_rows), min(2 * cores, nd // 64))
    at = F.when(F.abs(F.col(pivot)) <= LARGEST, F.col(pivot)).otherwise(F.lit(float("nan")))
    cuts = d.select(at.alias("_at")).where("NOT isnan(_at)").approxQuantile("_at", [i / n_ranges for i in range(1, n_ranges)], 1 / (4 * n_ranges))
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    no_range = len(splits) - 1  # of rows that miss the column

    def placed(df: DataFrame, **names: Column) -> DataFrame:
        for name, x in names.items():
            df = df.withColumn(f"{name}_x", F.coalesce(x, F.lit(float("nan"))))
            df = Bucketizer(splits=splits, inputCol=f"{name}_x", outputCol=f"{name}_b", handleInvalid="keep").transform(df)
            df = df.withColumn(name, F.col(f"{name}_b").cast("int")).drop(f"{name}_x", f"{name}_b")
        return df

    def tasks(df: DataFrame, rows: int, name: str) -> DataFrame:
        """A row per range (a few more than ``n_ranges``): among how many tasks its rows of ``df`` are dealt."""
        return df.groupBy("_range").agg(F.ceil(F.count("*") / rows).cast("int").alias(name))

    def dealt(df: DataFrame, by: str, out: str) -> DataFrame:
        """Each row to one of the tasks of its range."""
        return df.withColumn(out, F.pmod(F.xxhash64(*df.columns), F.coalesce(by, F.lit(1))).cast("int"))

    def every(df: DataFrame, by: str, out: str) -> DataFrame:
        """Each row to all tasks of its range."""
        return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.coalesce(by, F.lit(1)) - 1)))

    d = placed(d, _range=at)
    buckets = hold(tasks(d, donor_rows, "_buckets"))
    d = dealt(d.join(F.broadcast(buckets), "_range"), "_buckets", "_bkt").drop("_buckets")
    first = placed(q, _range=at)
    first = dealt(first.join(F.broadcast(hold(tasks(first, query_rows, "_blocks"))), "_range"), "_blocks", "_blk")
    blocks = first.groupBy("_range").agg(F.max("_blocks").alias("_blocks"))
    share = max(1, min(BOUND_SHARE, nd // n_ranges // 1000))
    some = d.where((F.col("_range") < no_range) & (F.col("_bkt") == 0) & (F.pmod(F.xxhash64("_did", *cols), F.lit(share)) == 0))
    some = every(some.join(F.broadcast(hold(blocks)), "_range"), "_blocks", "_blk")
    types = ", ".join(f"{c} double" for c in cols)
    far = hold(first.groupBy("_range", "_blk").cogroup(some.groupBy("_range", "_blk")).applyInPandas(
        _bound_kernel(cols, k, metric, sought or impute_cols), f"_qid long, {types}, _far double"))
    meets = placed(far, _own=at, _lo=at - F.col("_far"), _hi=at + F.col("_far"))
    ranges = F.when(F.col("_own") == no_range, F.sequence(F.lit(0), F.lit(no_range))).otherwise(
        F.array_union(F.sequence("_lo", "_hi"), F.array(F.lit(no_range))))
    meets = meets.withColumn("_range", F.explode(ranges)).select("_qid", *cols, "_far", "_range")
    meets = meets.join(F.broadcast(buckets), "_range")  # ranges without donors end here
    blocks = hold(tasks(meets, query_rows, "_blocks"))
    meets = every(dealt(meets.join(F.broadcast(blocks), "_range"), "_blocks", "_blk"), "_buckets", "_bkt")
    d = every(d.join(F.broadcast(blocks), "_range"), "_blocks", "_blk")
    group = ("_range", "_blk", "_bkt")
    pairs = meets.select("_qid", *cols, "_far", *group).groupBy(*group).cogroup(d.select("_did", *cols, *group).groupBy(*group)).applyInPandas(
        _make_kernel(cols, k, metric, [], impute_cols), "_qid long, col int, _did long, dist double, val double")
    w = Window.partitionBy("_qid", "col").orderBy("dist", "_did")
    ranked = pairs.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    return ranked.withColumnRenamed("_qid", "qid").withColumnRenamed("_did", "did")


def knn_classify(train: DataFrame, test: DataFrame, key: str, cols: list[str], label: str, k: int = 5,
                 metric: str = "euclidean", weights: str | list[str] = "distance", ks: list[int] | None = None,
                 by: list[str] | None = None, n_classes: int | None = None,
                 neighbours: DataFrame | None = None) -> DataFrame:
    """Vote of the k nearest training rows → (by..., k, row_id, predicted, proba).

    weights='distance': weight 1/d; when any neighbour is at distance 0, those
    neighbours alone vote (weight 1). weights='uniform': weight 1. Vote ties go
    to the lowest class index. ``ks`` scores several k from one top-max(k) search.
    ``by`` runs independent problems (folds, noise settings) in the same job:
    a query only meets donors of its own group. ``neighbours`` (a ``knn_search``
    of at least max(k)) lets several votes share one search; it may carry its
    donors' labels as ``nlabel``. A list of ``weights`` votes with each of them, named
    in a column ``weights`` before ``k``.

    A query's neighbours lie in one partition before they are copied for each k and
    weighting, so the copies are neither shuffled nor sorted.
    """
    by = list(by or [])
    ks = ks or [k]
    kmax = max(ks)
    nb = neighbours if neighbours is not None else knn_search(test, train, key, cols, kmax, by=by, metric=metric)
    if "nlabel" not in nb.columns:
        labels = train.select(*[b for b in by if b in train.columns], F.col(key).alias("did"), F.col(label).cast("int").alias("nlabel"))
        nb = nb.join(labels, [c for c in labels.columns if c != "nlabel"])
    several = not isinstance(weights, str)
    first_zero = F.min(F.when(F.col("dist") == 0, F.col("rn"))).over(Window.partitionBy(*by, "qid"))
    nb = nb.select(*by, "qid", "dist", "rn", "nlabel").repartition("qid").withColumn("_zero", first_zero)
    asked = [(x, w) for x in ks for w in (weights if several else [weights])]
    j = nb.crossJoin(F.broadcast(test.sparkSession.createDataFrame(asked, "k int, weights string"))).where(F.col("rn") <= F.col("k"))
    grp = by + (["weights"] if several else []) + ["k", "qid"]
    wq = Window.partitionBy(*grp)
    w = F.when(F.col("weights") != "distance", 1.0).when(
        F.col("_zero") <= F.col("k"), F.when(F.col("dist") == 0, 1.0).otherwise(0.0)).otherwise(1.0 / F.col("dist"))
    votes = j.withColumn("w", w).groupBy(*grp, "nlabel").agg(F.sum("w").alias("score"))
    if n_classes is None:
        n_classes = train.agg(F.max(F.col(label).cast("int"))).first()[0] + 1
    tot = F.sum("score").over(wq)
    rank = Window.partitionBy(*grp).orderBy(F.desc("score"), F.asc("nlabel"))
    scored = votes.withColumn("p", F.col("score") / tot).withColumn("r", F.row_number().over(rank))
    # at most k (label, p) pairs per query
    out = scored.groupBy(*grp).agg(
        F.max(F.when(F.col("r") == 1, F.col("nlabel"))).alias("predicted"),
        F.map_from_entries(F.collect_list(F.struct("nlabel", "p"))).alias("_pm"))
    proba = F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)),
                        lambda c: F.coalesce(F.try_element_at(F.col("_pm"), c), F.lit(0.0)))
    return out.select(*grp[:-1], F.col("qid").alias("row_id"), F.col("predicted").cast("int").alias("predicted"),
                      proba.alias("proba"))
