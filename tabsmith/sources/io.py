"""Sources and sinks.

* CSV splits are read with an explicit all-string schema: never inferSchema
  (an extra pass, and a dirty numeric column would flip type between files).
* Intermediate results are written as Parquet partitioned by ``split`` and read
  back, which cuts lineage and survives executor loss.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLITS = ("train", "test", "val")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def clean_header(name: str) -> str:
    return name.strip().lstrip("﻿").strip()


def read_csv_split(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with header, UTF-8 (BOM tolerated), every column read as STRING.

    ``columns`` gives the header when it is known; otherwise Spark's CSV reader takes the names from the first line, so
    quoted commas are no separators. Names are freed of blanks and a BOM. Data fields keep their blanks.
    """
    how = {"header": True, "encoding": "UTF-8", "escape": '"'}
    if columns is None:
        columns = spark.read.options(**how).csv(path).columns  # without inferSchema only the first line is read
    names = [clean_header(c) for c in columns]
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(len(names))])
    return spark.read.schema(schema).options(**how, enforceSchema=True).csv(path).toDF(*names)


def load_splits(spark: SparkSession, paths: dict[str, str], columns: list[str] | None = None) -> DataFrame:
    """The named splits as one DataFrame with a ``split`` column."""
    out = None
    for split, path in paths.items():
        part = read_csv_split(spark, path, columns).withColumn("split", F.lit(split))
        out = part if out is None else out.unionByName(part)
    return out


def tag_splits(frames: dict[str, DataFrame]) -> DataFrame:
    """S2 for already-loaded frames: union by name with a ``split`` tag."""
    out = None
    for split, df in frames.items():
        part = df.withColumn("split", F.lit(split))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def write_csv_report(df: DataFrame, path: str) -> None:
    """Small report table as one CSV file with header (no BOM)."""
    write_csv(df.coalesce(1), path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with header that ``read_csv_split`` reads back as they were: blanks kept, quotes doubled."""
    df.write.mode("overwrite").options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def persist_table(df: DataFrame, path: str, partition_by: str | None = "split") -> DataFrame:
    """Write Parquet (partitioned by split when present) and read it back."""
    w = df.write.mode("overwrite")
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def save_stats(stats: DataFrame, path: str) -> None:
    """Fitted statistics (scaler centre/scale, selected features, ...) are tables."""
    stats.coalesce(1).write.mode("overwrite").parquet(path)


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> None:
    """MLlib models and pipelines use their own writer."""
    model.write().overwrite().save(path)
