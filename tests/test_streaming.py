"""The fitted stateless steps run unchanged on a stream (file source → parquet sink)."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SMALL
from tabsmith.plans.q_prep import EVENT_CLASSES
from tabsmith.sources.fixtures import dirty_events
from tabsmith.streaming.score import clean_stream, read_raw_stream, start


def test_clean_stream(spark):
    root = tempfile.mkdtemp(prefix="tabsmith-stream-", dir="/tmp")
    src, out, ck = (os.path.join(root, x) for x in ("src", "out", "ck"))
    raw = dirty_events(spark, SMALL).select(F.col("row_id").cast("string"), "label_raw", "num_raw",
                                            F.col("user_id").cast("string"))
    raw.write.option("header", True).csv(src)
    cols = ["num_raw", "user_id"]
    med = spark.createDataFrame([("num_raw", 100.0), ("user_id", 50.0)], "feature string, median double")
    bounds = spark.createDataFrame([("num_raw", 0.0, 400.0), ("user_id", 0.0, 1e9)],
                                   "feature string, lo double, hi double")
    stream = read_raw_stream(spark, src, raw.columns)
    q = start(clean_stream(stream, "label_raw", cols, EVENT_CLASSES, med, bounds, suffix_cols=["num_raw"]), out, ck)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    n_valid = raw.where(F.upper(F.regexp_replace("label_raw", r"^\s+|\s+$", "")).isin(*EVENT_CLASSES)).count()
    assert got.count() > 0 and got.count() <= n_valid
    assert got.where(F.col("num_raw").isNull() | (F.col("num_raw") > 400)).count() == 0
