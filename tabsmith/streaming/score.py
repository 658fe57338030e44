"""Apply the fitted cleaning / scaling steps to a stream of raw CSV splits.

The original pipeline has no stream. Every fitted step here is stateless per
row (label repair, suffix parsing, guarded casts, joining a fitted statistics
table), so the same functions run unchanged on a streaming DataFrame: the
statistics are a static table joined to each micro-batch. Imputation and
clipping statistics come from a batch fit (a stream cannot refit medians).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.operators.clean import parse_suffix, repair_labels, to_numeric
from tabsmith.operators.stats import attach, wide_stats


def read_raw_stream(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.readStream.schema(schema).option("header", True).csv(path)


def clean_stream(raw: DataFrame, label: str, features: list[str], canonical: list[str],
                 medians: DataFrame, bounds: DataFrame, suffix_cols: list[str] = ()) -> DataFrame:
    """Stateless part of C11 with batch-fitted medians (feature, median) and IQR
    bounds (feature, lo, hi); invalid labels are dropped."""
    out = repair_labels(raw, label, canonical)
    for c in suffix_cols:
        out = parse_suffix(out, c)
    out = to_numeric(out, features)
    j, median = attach(out, wide_stats(medians, [], features, ["median"]), [])
    j, fence = attach(j, wide_stats(bounds, [], features, ["lo", "hi"]), [])
    sel = []
    for c in out.columns:
        if c in features:
            x = F.coalesce(F.col(c), median("median", c))
            sel.append(F.least(F.greatest(x, fence("lo", c)), fence("hi", c)).alias(c))
        else:
            sel.append(F.col(c))
    return j.select(*sel).where(F.col("valid"))


def start(cleaned: DataFrame, out_path: str, checkpoint: str, once: bool = True):
    """Append to Parquet with a reliable checkpoint location (exactly-once file sink)."""
    w = cleaned.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w
    return w.outputMode("append").start()
