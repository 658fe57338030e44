"""Dataset profile (S3) and missing-value audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.functions.keyed import keyed_uniform
from tabsmith.functions.parse import NULL_TOKENS


def _is_missing(c: str, dtype) -> F.Column:
    col = F.col(c)
    if isinstance(dtype, T.StringType):
        return col.isNull() | col.isin(*NULL_TOKENS)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def summary(df: DataFrame, target: str) -> DataFrame:
    """S3: one row — n_samples, n_features (columns - 1), n_classes, total missing.

    One aggregate pass; NULL, '' and '?' count once each (not twice).
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    miss = [F.sum(F.when(_is_missing(c, t), 1).otherwise(0)).alias(f"m_{i}")
            for i, (c, t) in enumerate(fields.items())]
    agg = df.agg(F.count(F.lit(1)).alias("n_samples"),
                 F.count_distinct(F.col(target)).alias("n_classes"), *miss)
    total = sum((F.coalesce(F.col(f"m_{i}"), F.lit(0)) for i in range(len(fields))), F.lit(0))
    return agg.select(F.col("n_samples").cast("long").alias("n_samples"),
                      F.lit(len(fields) - 1).cast("long").alias("n_features"),
                      F.col("n_classes").cast("long").alias("n_classes"),
                      total.cast("long").alias("n_missing"))


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """S3 / V1: (class, n, share); share = n / total via a global window over k rows."""
    counts = df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    return counts.select("class", "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_missing) for every column, computed in one aggregate."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = cols or list(fields)
    agg = df.agg(*[F.sum(F.when(_is_missing(c, fields[c]), 1).otherwise(0)).cast("long").alias(c) for c in cols])
    return agg.unpivot([], cols, "column", "n_missing").select(
        "column", F.coalesce("n_missing", F.lit(0)).cast("long").alias("n_missing"))


def dtype_info(df: DataFrame) -> DataFrame:
    """S3: (column, dtype) — schema metadata, no data pass."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, dtype string")


def missing_map(df: DataFrame, key: str, cols: list[str], n_rows: int = 200, seed: int = 42) -> DataFrame:
    """V2: 0/1 missing matrix for a keyed sample of ``n_rows`` rows (long form).

    The sample is the ``n_rows`` smallest keyed hashes: deterministic and
    partition-independent; ``orderBy.limit`` runs as a top-k per partition.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    sample = (df.withColumn("_u", keyed_uniform(key, "sample", seed))
              .orderBy("_u", key).limit(n_rows))
    flags = sample.select(F.col(key).alias("_rid"),
                          *[F.when(_is_missing(c, fields[c]), 1).otherwise(0).alias(c) for c in cols])
    return flags.unpivot(["_rid"], cols, "column", "missing").select(
        F.col("_rid").alias("row_id"), "column", F.col("missing").cast("int").alias("missing"))
