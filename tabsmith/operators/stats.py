"""Fitted-statistics pattern: one aggregate pass → small table → broadcast join.

Statistics are computed in long form (keys..., feature, stat...) and pivoted to
one row per group with columns ``<stat>__<feature>``. The global case is one
row (size bound: 1); grouped cases are counted before they are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.session import hold

BROADCAST_ROWS = 100_000


def wide_stats(stats_long: DataFrame, by: list[str], cols: list[str], stat_cols: list[str]) -> DataFrame:
    aggs = [F.max(F.when(F.col("feature") == c, F.col(s))).alias(f"{s}__{c}") for c in cols for s in stat_cols]
    if by:
        return stats_long.groupBy(*by).agg(*aggs)
    return stats_long.agg(*aggs)


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def attach(df: DataFrame, wide: DataFrame, by: list[str]) -> tuple[DataFrame, Callable[[str, str], Column]]:
    """Join a statistics table onto every row; returns (joined, stat) with stat(name, column) → Column.

    The statistics travel in one struct column whose name no column of ``df`` has, so select ``df.columns`` to be rid
    of them. A grouped table is broadcast only if its counted rows are few.
    """
    name = free_name(df.columns, "_stats")
    side = wide.select(*by, F.struct(*[F.col(c) for c in wide.columns if c not in by]).alias(name))
    if by:
        side = hold(side)
        joined = df.join(F.broadcast(side) if side.count() <= BROADCAST_ROWS else side, by, "left")
    else:
        joined = df.crossJoin(F.broadcast(side))  # exactly one row
    return joined, lambda stat, col: F.col(name).getField(f"{stat}__{col}")


def moments(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """(by..., feature, n, mean, std_pop, min, max) in one aggregate over the wide table."""
    by = list(by or [])
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n__{c}"), F.avg(x).alias(f"mean__{c}"),
                 F.stddev_pop(x).alias(f"std__{c}"), F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
