"""Missing-value imputation: median (I2, I3) and k-nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.presets import KNN_IMPUTE_K
from tabsmith.operators.knn import knn_search
from tabsmith.operators.quantile import quantiles, to_long
from tabsmith.operators.stats import attach, free_name, wide_stats
from tabsmith.session import hold

STRATEGIES = ("median", "knn")


def median_stats(df: DataFrame, cols: list[str], by: list[str] | None = None, method: str = "exact") -> DataFrame:
    by = list(by or [])
    q = quantiles(to_long(df, cols, by), [0.5], by + ["feature"], method=method)
    return q.select(*by, "feature", F.col("q").alias("median"))


def impute_median(df: DataFrame, cols: list[str], by: list[str] | None = None, method: str = "exact",
                  stats: DataFrame | None = None) -> DataFrame:
    """NULL → column median (per ``by`` group); an all-NULL column stays NULL."""
    by = list(by or [])
    st = stats if stats is not None else median_stats(df, cols, by, method)
    j, stat = attach(df, wide_stats(st, by, cols, ["median"]), by)
    return j.select(*[(F.coalesce(F.col(c), stat("median", c)).alias(c) if c in cols else F.col(c)) for c in df.columns])


def impute(df: DataFrame, cols: list[str], strategy: str = "median", **kw) -> DataFrame:
    """Dispatch; unknown names are rejected (no silent fallback)."""
    if strategy == "median":
        return impute_median(df, cols, **kw)
    if strategy == "knn":
        return impute_knn(df, cols, **kw)
    raise ValueError(f"unknown imputation strategy {strategy!r}; use one of {STRATEGIES}")


def impute_knn(df: DataFrame, cols: list[str], key: str, by: list[str] | None = None, k: int = KNN_IMPUTE_K,
               **search_kw) -> DataFrame:
    """Each missing cell = mean of that column over the k nearest rows having it.

    Distance: NaN-aware Euclidean on the given (unscaled) columns,
    sqrt(n_cols / n_present * sum over shared coordinates). Only rows with a
    missing value are queries; every row of the same ``by`` group is a donor.
    A cell with no donor at a finite distance takes the column mean.
    """
    by = list(by or [])
    # read by the counts, the search (queries and donors), the means and the final join
    df = hold(df)
    any_null = None
    for c in cols:
        cond = F.col(c).isNull()
        any_null = cond if any_null is None else (any_null | cond)
    queries = df.where(any_null)
    nb = knn_search(queries, df, key, cols, k, by=by, impute_cols=cols, **search_kw)
    name = free_name(df.columns, "_fills")
    fills = nb.groupBy(*by, "qid").agg(F.struct(
        *[F.avg(F.when(F.col("col") == i, F.col("val"))).alias(c) for i, c in enumerate(cols)]).alias(name))
    means = df.groupBy(*by).agg(*[F.avg(c).alias(f"mean__{c}") for c in cols]) if by else \
        df.agg(*[F.avg(c).alias(f"mean__{c}") for c in cols])
    # rows that miss nothing are not joined, so they are not shuffled either
    j = queries.join(fills.withColumnRenamed("qid", key), by + [key], "left").unionByName(df.where(~any_null), allowMissingColumns=True)
    j, stat = attach(j, means, by)
    sel = [(F.coalesce(F.col(c), F.col(name).getField(c), stat("mean", c)).alias(c) if c in cols else F.col(c))
           for c in df.columns]
    return j.select(*sel)
