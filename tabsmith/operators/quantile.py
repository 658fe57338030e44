"""Exact, distributed quantiles (linear interpolation, pandas/DuckDB definition).

Spark's ``percentile`` aggregate is exact but keeps every distinct value of a
group in one task's memory: a global quantile over 10^12 doubles cannot work.
``quantiles(method="exact")`` instead selects order statistics:

1. one aggregate pass: n, min, max per (group, feature);
2. groups with n <= ``window_rows``: Spark's exact ``percentile`` (its per-group
   value map is then bounded by ``window_rows``);
3. larger groups: refinement. A quantile sketch of the current range proposes two
   values around each wanted rank; the rows below, at, between and above them are
   counted exactly (map-side partial aggregation); the cell that holds the rank is
   the next range, until it is one value or has <= ``window_rows`` rows to rank.

The two values come from the data's own order, so the range shrinks by some
``buckets`` / 3 a round however widely the magnitudes spread. Both leave the open
cells, so every round removes a distinct value and the loop ends for any input.
Every pass is a shuffle of small aggregates; no task ever holds more than
``window_rows`` values of one group, whatever the skew between groups.
``method="inmemory"`` uses Spark's ``percentile`` (one pass, fine when groups
hold few distinct values); ``method="approx"`` uses ``percentile_approx``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tabsmith.session import cut_lineage, hold

WINDOW_ROWS = 2_000_000
BUCKETS = 1000
SKETCH_ACCURACY = 10_000
BROADCAST_ROWS = 200_000


def to_long(df: DataFrame, cols: list[str], by: list[str] | None = None,
            feature_col: str = "feature", value_col: str = "value", dropna: bool = True) -> DataFrame:
    """Unpivot numeric columns to (by..., feature, value)."""
    by = list(by or [])
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        by, cols, feature_col, value_col)
    if dropna:
        long = long.where(F.col(value_col).isNotNull() & ~F.isnan(value_col))
    return long


def _rank_targets(stats: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """(keys, prob, r_lo, r_hi, frac) for each wanted probability."""
    p = F.explode(F.array(*[F.lit(float(x)) for x in probs])).alias("prob")
    t = stats.select(*keys, "n", p)
    h = (F.col("n") - 1).cast("double") * F.col("prob")
    return t.select(*keys, "n", "prob", F.floor(h).cast("long").alias("r_lo"),
                    F.ceil(h).cast("long").alias("r_hi"), (h - F.floor(h)).alias("frac"))


def _meet(left: DataFrame, right: DataFrame, keys: list[str], how: str | int = "inner") -> DataFrame:
    """Join on equal ``keys``, where NULL equals NULL: a group may have a NULL key.

    ``how`` may be the most rows that ``right`` has: an inner join, with ``right`` broadcast if that is few."""
    own = [f"_key_{i}" for i in range(len(keys))]
    right = right.select(*[F.col(k).alias(o) for k, o in zip(keys, own)], *[c for c in right.columns if c not in keys])
    if isinstance(how, int):
        right, how = bounded_broadcast(right, how), "inner"
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own)])
    return left.join(right, same, how).drop(*own)


def quantiles(long: DataFrame, probs: list[float], keys: list[str], value_col: str = "value",
              method: str = "exact", window_rows: int = WINDOW_ROWS, buckets: int = BUCKETS,
              accuracy: int = 10000) -> DataFrame:
    """Quantiles of ``value_col`` per ``keys`` → (keys..., prob, q).

    ``long`` must already exclude NULL values (``to_long`` does).
    """
    if method == "inmemory":
        arr = F.percentile(value_col, F.array(*[F.lit(float(p)) for p in probs]))
        agg = long.groupBy(*keys).agg(arr.alias("_q"))
        return agg.select(*keys, F.posexplode("_q").alias("_i", "q")).select(
            *keys, F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i") + 1).alias("prob"), "q")
    if method == "approx":
        arr = F.percentile_approx(value_col, [float(p) for p in probs], accuracy)
        agg = long.groupBy(*keys).agg(arr.alias("_q"))
        return agg.select(*keys, F.posexplode("_q").alias("_i", "q")).select(
            *keys, F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i") + 1).alias("prob"),
            F.col("q").cast("double").alias("q"))
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")

    v = F.col(value_col)
    stats = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
    stats = hold(stats)
    big = stats.where(F.col("n") > window_rows)
    n_big = big.count()
    if n_big == 0:
        # Every group is small enough for Spark's exact in-memory percentile.
        return quantiles(long, probs, keys, value_col, method="inmemory")

    small_keys = stats.where(F.col("n") <= window_rows).select(*keys)
    small = quantiles(_meet(long, small_keys, keys, "left_semi"), probs, keys, value_col, method="inmemory")
    targets = _rank_targets(big, keys, probs)
    ranks = (targets.select(*keys, F.col("r_lo").alias("rank"))
             .unionByName(targets.select(*keys, F.col("r_hi").alias("rank"))).distinct())
    picked = _refine(long, big, ranks, keys, value_col, window_rows, buckets, n_big * 2 * len(probs))
    j = _meet(targets, picked, keys).where((F.col("rank") == F.col("r_lo")) | (F.col("rank") == F.col("r_hi")))
    both = j.groupBy(*keys, "prob", "frac").agg(F.max(F.when(F.col("rank") == F.col("r_lo"), F.col("v"))).alias("v_lo"),
                                                F.max(F.when(F.col("rank") == F.col("r_hi"), F.col("v"))).alias("v_hi"))
    big_q = both.select(*keys, "prob", (F.col("v_lo") + F.col("frac") * (F.col("v_hi") - F.col("v_lo"))).alias("q"))
    return small.unionByName(big_q)


def bounded_broadcast(df: DataFrame, max_rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the row count is known to be under ``limit``."""
    return F.broadcast(df) if max_rows <= limit else df


def _refine(long: DataFrame, big: DataFrame, ranks: DataFrame, keys: list[str], value_col: str,
            window_rows: int, buckets: int, max_targets: int) -> DataFrame:
    """Sketch-guided refinement for groups larger than ``window_rows``."""
    v = F.col(value_col)
    inside = (v >= F.col("lo")) & (v <= F.col("hi"))
    grid = [i / buckets for i in range(buckets + 1)]
    tgt = (_meet(big, ranks, keys).select(*keys, "rank", "lo", "hi", F.lit(0).cast("long").alias("below"),
                                        F.col("n").alias("cnt")))
    resolved = []
    while True:
        tgt = cut_lineage(tgt)  # a few rows; kept as a plan, a round's plan would hold the one before several times
        # Finished: a single distinct value in range, or few enough rows to rank.
        resolved.append(tgt.where(F.col("lo") == F.col("hi")).select(*keys, "rank", F.col("lo").alias("v")))
        open_t = tgt.where(F.col("lo") < F.col("hi"))
        work = open_t.where(F.col("cnt") > window_rows)
        if work.isEmpty():
            break
        keep = open_t.where(F.col("cnt") <= window_rows)
        ranges = work.select(*keys, "lo", "hi").distinct()
        cuts = (_meet(long, ranges, keys, max_targets).where(inside).groupBy(*keys, "lo", "hi")
                .agg(F.percentile_approx(v, grid, max(SKETCH_ACCURACY, 8 * buckets)).alias("cuts")))
        # a sketch may differ when merged in another order: written once, so that a lost executor changes no range
        cuts = cut_lineage(cuts)
        at = F.floor((F.col("rank") - F.col("below")) * F.lit(float(buckets)) / F.col("cnt")).cast("int")
        lower = F.element_at("cuts", F.greatest(at - 1, F.lit(0)) + 1)
        upper = F.element_at("cuts", F.least(at + 2, F.lit(buckets)) + 1)
        aim = _meet(work, cuts, [*keys, "lo", "hi"]).select(*keys, "rank", "lo", "hi", "below",
                                                          lower.alias("a"), upper.alias("b"))
        rows = _meet(long, aim, keys, max_targets).where(inside)
        cell = (F.when(v < F.col("a"), 0).when(v == F.col("a"), 1).when(v < F.col("b"), 2)
                .when(v == F.col("b"), 3).otherwise(4))
        hist = (rows.groupBy(*keys, "rank", "below", cell.alias("cell"))
                .agg(F.count(F.lit(1)).alias("c"), F.min(v).alias("bmin"), F.max(v).alias("bmax")))
        cw = Window.partitionBy(*keys, "rank").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("cum", F.sum("c").over(cw))
        chosen = hist.where((F.col("below") + F.col("cum") - F.col("c") <= F.col("rank"))
                            & (F.col("rank") < F.col("below") + F.col("cum")))
        nxt = chosen.select(*keys, "rank", F.col("bmin").alias("lo"), F.col("bmax").alias("hi"),
                            (F.col("below") + F.col("cum") - F.col("c")).alias("below"), F.col("c").alias("cnt"))
        tgt = keep.unionByName(nxt)
    final_t = tgt.where(F.col("lo") < F.col("hi"))
    rows = _meet(long, final_t, keys, max_targets).where(inside)
    w = Window.partitionBy(*keys, "rank").orderBy(v)
    ranked = rows.select(*keys, "rank", v.alias("v"), (F.col("below") + F.row_number().over(w) - 1).alias("_r"))
    last = ranked.where(F.col("_r") == F.col("rank")).select(*keys, "rank", "v")
    return reduce(lambda a, b: a.unionByName(b), resolved, last)


def quantile_wide(long_q: DataFrame, keys: list[str], probs: list[float], names: list[str]) -> DataFrame:
    """(keys, feature, prob, q) → (keys, feature, name_1, name_2, ...)."""
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("q"))).alias(n) for p, n in zip(probs, names)]
    return long_q.groupBy(*keys).agg(*aggs)
