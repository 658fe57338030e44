"""Stratified splits (P9), stratified folds (P10) and exact per-class ranks.

A per-class ``row_number()`` window would put a whole class (possibly a third
of all rows) into one task. ``class_rank`` numbers rows inside hash buckets of
the class instead and adds each bucket's offset from a small count table:
bounded window partitions, exact ranks, independent of partitioning and of
adaptive re-planning (no partition ids involved).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.keyed import keyed_uniform
from tabsmith.functions.presets import CV_FOLDS, SEED, TEST_FRACTION, VAL_FRACTION


def class_rank(df: DataFrame, label: str, key: str, tag: str = "order", seed: int = SEED,
               out: str = "rank", rows_per_bucket: int = 50_000) -> DataFrame:
    """0-based rank of each row inside its class, ordered by (u(key, tag, seed), key).

    The keyed uniform u is split into B equal buckets (B from the row count, so a
    bucket holds ~``rows_per_bucket`` rows of a class at most, a hash being uniform
    whatever the skew between classes). Counts per (class, bucket) give each
    bucket its offset (small table, cumulative window); a window partitioned by
    (class, bucket) numbers the rows inside it.
    """
    n = df.count()
    if n <= rows_per_bucket:  # one bucket: its offset is 0
        w = Window.partitionBy(label).orderBy("_u", key)
        return df.withColumn("_u", keyed_uniform(key, tag, seed)).withColumn(out, (F.row_number().over(w) - 1).cast("long")).drop("_u")
    n_buckets = int(max(1, -(-n // rows_per_bucket)))
    t = df.withColumn("_u", keyed_uniform(key, tag, seed)).withColumn(
        "_b", F.least(F.floor(F.col("_u") * n_buckets), F.lit(n_buckets - 1)).cast("long"))
    counts = t.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(label, "_b", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    # (classes x buckets) rows grow with the data: Spark broadcasts them if their measured size allows
    j = t.join(offsets, [label, "_b"])
    wr = Window.partitionBy(label, "_b").orderBy("_u", key)
    return j.withColumn(out, (F.col("_off") + F.row_number().over(wr) - 1).cast("long")).drop("_u", "_b", "_off")


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("_class_n"))


def stratified_split(df: DataFrame, label: str, key: str, val_fraction: float = VAL_FRACTION,
                     test_fraction: float = TEST_FRACTION, seed: int = SEED, out: str = "split") -> DataFrame:
    """Per class, round(n·val) rows → 'val', then round(rest·test) → 'test', rest 'train'.

    Deterministic (keyed order), exact counts per class, partition-independent.
    """
    r = class_rank(df, label, key, "split", seed)
    sizes = class_sizes(df, label)
    j = r.join(sizes, label)
    n_val = F.round(F.col("_class_n") * val_fraction)
    n_test = F.round((F.col("_class_n") - n_val) * test_fraction)
    s = (F.when(F.col("rank") < n_val, F.lit("val"))
         .when(F.col("rank") < n_val + n_test, F.lit("test")).otherwise(F.lit("train")))
    return j.withColumn(out, s).drop("rank", "_class_n")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = CV_FOLDS, seed: int = SEED,
                     out: str = "fold") -> DataFrame:
    """P10: fold = rank inside class (keyed order) modulo k — balanced per class."""
    r = class_rank(df, label, key, "fold", seed)
    return r.withColumn(out, (F.col("rank") % k).cast("int")).drop("rank")
