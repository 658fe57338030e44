"""IQR winsorizing (W1 global, W2 per class) and outlier counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.presets import IQR_FACTOR
from tabsmith.operators.quantile import quantiles, to_long
from tabsmith.operators.stats import attach, wide_stats


def iqr_bounds(df: DataFrame, cols: list[str], by: list[str] | None = None, factor: float = IQR_FACTOR,
               method: str = "exact") -> DataFrame:
    """(by..., feature, q1, q3, lo, hi) with lo/hi = Q1 ∓ factor·IQR (NULLs ignored)."""
    by = list(by or [])
    long = to_long(df, cols, by)
    q = quantiles(long, [0.25, 0.75], by + ["feature"], method=method)
    w = q.groupBy(*by, "feature").agg(F.max(F.when(F.col("prob") == 0.25, F.col("q"))).alias("q1"),
                                      F.max(F.when(F.col("prob") == 0.75, F.col("q"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return w.select(*by, "feature", "q1", "q3", (F.col("q1") - factor * iqr).alias("lo"),
                    (F.col("q3") + factor * iqr).alias("hi"))


def _clip(c: str, stat) -> F.Column:
    x = F.col(c)
    return F.when(x.isNull(), x).otherwise(F.least(F.greatest(x, stat("lo", c)), stat("hi", c)))


def winsorize(df: DataFrame, cols: list[str], by: list[str] | None = None, factor: float = IQR_FACTOR,
              method: str = "exact", bounds: DataFrame | None = None) -> DataFrame:
    """Clip each column to its (per-group) IQR fences; NULL stays NULL."""
    by = list(by or [])
    b = bounds if bounds is not None else iqr_bounds(df, cols, by, factor, method)
    wide = wide_stats(b, by, cols, ["lo", "hi"])
    j, stat = attach(df, wide, by)
    return j.select(*[(_clip(c, stat).alias(c) if c in cols else F.col(c)) for c in df.columns])


def outlier_counts(df: DataFrame, cols: list[str], by: list[str] | None = None, factor: float = IQR_FACTOR,
                   method: str = "exact") -> DataFrame:
    """W2 audit: (by..., column, n_outliers) for cells outside the fences, only where > 0."""
    by = list(by or [])
    b = iqr_bounds(df, cols, by, factor, method)
    wide = wide_stats(b, by, cols, ["lo", "hi"])
    j, stat = attach(df, wide, by)
    aggs = [F.count_if((F.col(c) < stat("lo", c)) | (F.col(c) > stat("hi", c))).alias(c) for c in cols]
    agg = j.groupBy(*by).agg(*aggs) if by else j.agg(*aggs)
    long = agg.unpivot(by, cols, "column", "n_outliers")
    return long.where(F.col("n_outliers") > 0).select(*by, "column", F.col("n_outliers").cast("long").alias("n_outliers"))
