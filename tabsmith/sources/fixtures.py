"""Test fixtures derived by Spark from the driver's tables.

Each builder reads the given parquet tables and derives a DataFrame whose size
grows with them. The DuckDB text of each fixture lives in
``tabsmith.plans.oracle_fixtures``; both must produce the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions.keyed import keyed_uniform
from tabsmith.sources.io import read_table

ORDER_FEATURES = ["total_price", "n_lines", "sum_qty", "avg_qty", "sum_price", "avg_price",
                  "avg_discount", "avg_tax"]
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
N_DIMS = 64
VECTOR_FEATURES = [f"x{i}" for i in range(N_DIMS)]
PRED_MODELS = [("model_a", 0.10), ("model_b", 0.20), ("model_c", 0.30)]
N_PRIORITIES = 5


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with dirty labels and dirty numbers (keyed, not positional)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    up = F.upper("event_type")
    lb = F.floor(keyed_uniform("event_id", "lab") * 23)
    nb = F.floor(keyed_uniform("event_id", "num") * 29)
    txt = F.col("value").cast("decimal(12,2)").cast("string")
    label = (F.when(lb == 0, F.concat(up, F.lit(" ")))
             .when(lb == 1, F.lower("event_type"))
             .when(lb == 2, F.translate(up, "EO", "30"))
             .when(lb == 3, F.concat(F.lit(" "), up, F.lit("\t")))
             .when(lb == 4, F.lit("N/A"))
             .when(lb == 5, F.lit(None).cast("string"))
             .when(lb == 6, F.concat(F.upper(F.substring("event_type", 1, 1)), F.substring("event_type", 2, 100)))
             .otherwise(up))
    num = (F.when(nb == 0, F.concat(txt, F.lit(" cm")))
           .when(nb == 1, F.concat(txt, F.lit("cm")))
           .when(nb == 2, F.lit("?"))
           .when(nb == 3, F.lit(""))
           .when(nb == 4, F.lit(None).cast("string"))
           .otherwise(txt))
    return ev.select(F.col("event_id").alias("row_id"), label.alias("label_raw"), num.alias("num_raw"),
                     F.col("user_id"))


def _amt(c: str):
    return F.col(c).cast("double") / F.lit(100.0)


def order_features(spark: SparkSession, sf_dir: str, holes: bool = True) -> DataFrame:
    """per-order features from orders LEFT JOIN aggregated lineitem.

    lineitem is aggregated per order first (partial aggregation map-side), so
    the join shuffles one row per order, not one per line.
    """
    def cents(c):
        # Exact sum of 2-decimal amounts as integer cents (same value as a DECIMAL(18,2) sum).
        return F.sum(F.round(F.col(c) * 100).cast("long"))

    li = (read_table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.count(F.lit(1)).alias("n"), cents("l_quantity").alias("sq"), cents("l_extendedprice").alias("sp"),
               cents("l_discount").alias("sd"), cents("l_tax").alias("st")))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    n = F.col("n").cast("double")
    df = j.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderpriority").alias("class"),
        F.col("o_totalprice").cast("double").alias("total_price"),
        n.alias("n_lines"),
        _amt("sq").alias("sum_qty"),
        (_amt("sq") / n).alias("avg_qty"),
        _amt("sp").alias("sum_price"),
        (_amt("sp") / n).alias("avg_price"),
        (_amt("sd") / n).alias("avg_discount"),
        (_amt("st") / n).alias("avg_tax"),
    )
    if holes:
        df = (df.withColumn("sum_price", F.when(keyed_uniform("row_id", "h1") >= 0.005, F.col("sum_price")))
                .withColumn("avg_qty", F.when(keyed_uniform("row_id", "h2") >= 0.005, F.col("avg_qty"))))
    return df


def line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem measures with a 6-value class (no unique key: set-level use only)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.concat("l_returnflag", "l_linestatus").alias("class"),
                     *[F.col(c).cast("double").alias(c) for c in LINE_FEATURES])


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings unpacked to 64 DOUBLE columns, label 0-9."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("row_id"), F.col("label").cast("int").alias("label"),
                    *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(N_DIMS)])


N_FORMS = 5


def learnable_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the vectors of F4 with label = the largest of five fixed linear forms (x_c + x_c+10 + x_c+20, the first of
    equal ones), so that a classifier has something to learn and its quality means something."""
    v = vectors(spark, sf_dir)
    forms = F.array(*[F.col(f"x{c}") + F.col(f"x{c + 10}") + F.col(f"x{c + 20}") for c in range(N_FORMS)])
    return v.withColumn("label", (F.array_position(forms, F.array_max(forms)) - 1).cast("int"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, split, row_id, actual, predicted, proba) for three pretend models.

    actual = priority index 0-4; a keyed share of rows is mispredicted (half as
    often on the train split); proba puts extra mass on the predicted class.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    models = spark.createDataFrame(PRED_MODELS, "model string, err_rate double")
    base = o.select(F.col("o_orderkey").alias("row_id"),
                    (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("actual"))
    df = base.crossJoin(F.broadcast(models))  # 3-row configuration table
    split = F.when(keyed_uniform("row_id", "split") < 0.7, F.lit("train")).otherwise(F.lit("test"))
    df = df.withColumn("split", split)
    rate = F.when(F.col("split") == "train", F.col("err_rate") / 2).otherwise(F.col("err_rate"))
    wrong = keyed_uniform("row_id", F.concat(F.lit("err"), F.col("model"))) < rate
    alt = (F.col("actual") + 1 + F.floor(keyed_uniform("row_id", F.concat(F.lit("alt"), F.col("model"))) * 4)) % 5
    df = df.withColumn("predicted", F.when(wrong, alt).otherwise(F.col("actual")).cast("int"))
    us = [keyed_uniform("row_id", F.concat(F.lit(f"p{j}"), F.col("model"))) +
          F.when(F.col("predicted") == j, F.lit(2.0)).otherwise(F.lit(0.0)) for j in range(N_PRIORITIES)]
    df = df.withColumn("_u", F.array(*us))
    total = F.col("_u")[0]
    for j in range(1, N_PRIORITIES):
        total = total + F.col("_u")[j]
    df = df.withColumn("proba", F.transform("_u", lambda x: x / total))
    return df.select("model", "split", "row_id", F.col("actual").cast("int").alias("actual"),
                     "predicted", "proba")
