"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.session import cut_lineage, ensure_checkpoint_dir

# fixed values: white space and words as the query contracts define them
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# A key with more than 1/HOT_SHARE of all rows is "hot": there are fewer than HOT_SHARE such keys, whatever the size.
HOT_SHARE = 1000
HOT_LEAST = 100  # rows of a key that no task minds


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def q(name: str) -> str:
    """Column name quoted for F.col (dots and backticks are part of the name)."""
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct, so that no working column can clash with them."""
    return F.struct(*[F.col(q(c)) for c in df.columns])


def unpacked(df: DataFrame, columns: list[str], outs: list[str], row: str = "_row") -> DataFrame:
    """Fields of the packed row, then ``outs``; an input column with the name of an output gives way to it."""
    taken = {o.lower() for o in outs}
    return df.select(*[F.col(row).getField(c).alias(c) for c in columns if c.lower() not in taken],
                     *[F.col(q(o)) for o in outs])


def text_or_empty(col: str | Column) -> Column:
    c = F.col(q(col)) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def crc32_of(col: str) -> Column:
    """Unsigned CRC-32 of the column's text form (null: null)."""
    return F.crc32(F.col(q(col)).cast("string").cast("binary"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder once and go on from the written rows."""
    return cut_lineage(df)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, as a URI that pyarrow.fs opens on every executor."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:/") and not base.startswith("file://"):
        base = "file://" + base[len("file:"):]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def open_fs(uri: str):
    """(pyarrow filesystem, path) of a URI or absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def attach(rows: DataFrame, groups: DataFrame, key: str, count_col: str, n_rows: int) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row per ``key``, ``count_col`` = its rows) that no hot key can skew.

    Keys with more than n_rows / HOT_SHARE rows (and more than HOT_LEAST) are fewer than HOT_SHARE, so they are joined by
    broadcast (a proven bound); each of the others has few rows and is joined by shuffling both sides, as all are if no
    key is hot. ``groups`` should be materialised: it is read several times.
    """
    limit = max(n_rows // HOT_SHARE, HOT_LEAST)
    hot = groups.filter(F.col(count_col) > limit)
    if not hot.limit(1).count():
        return rows.join(groups, key)
    cold = groups.filter(F.col(count_col) <= limit)
    flagged = rows.join(F.broadcast(hot.select(F.col(key).alias("_hot_key"))), F.col(key) == F.col("_hot_key"), "left")
    in_hot = flagged.filter(F.col("_hot_key").isNotNull()).drop("_hot_key").join(F.broadcast(hot), key)
    in_cold = flagged.filter(F.col("_hot_key").isNull()).drop("_hot_key").join(cold, key)
    return in_hot.unionByName(in_cold)


def numbered(df: DataFrame, *order: Column, name: str = "_no") -> DataFrame:
    """Add the 0-based position of each row in the given order, without a window over the whole table.

    Rows are range-partitioned and written; a row's number is its place in its partition plus the sizes of the
    partitions before it (one row per partition, so a broadcast of a known size).
    """
    from pyspark.sql import Window

    placed = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at")))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    out = placed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_at"))
    return out.drop("_part", "_at", "_start")
