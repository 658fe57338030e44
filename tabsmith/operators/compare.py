"""Model comparison, rank test, overfitting, robustness and speed summaries.

All inputs are small result tables (one row per model, per model x class,
per model x noise setting, ...) produced by Spark aggregates; every operator
here is itself a DataFrame expression over them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.presets import OVERFIT_THRESHOLDS, OVERFIT_TOP
from tabsmith.operators import metrics as M


def comparison_table(pred: DataFrame, model: str = "model", split: str = "split") -> DataFrame:
    """A3: one row per model — test scores and train accuracy (numbers, not text)."""
    both = M.metrics_wide(pred.where(F.col(split).isin("test", "train")), [model, split])
    test = lambda c: F.max(F.when(F.col(split) == "test", F.col(c))).alias(c)
    rows = both.groupBy(model).agg(
        *[test(c) for c in ("accuracy", "balanced_accuracy", "f1_macro", "f1_weighted", "cohen_kappa")],
        F.max(F.when(F.col(split) == "train", F.col("accuracy"))).alias("train_accuracy"))
    return rows.where(F.col("accuracy").isNotNull())  # a model without test rows has no line


def per_class_table(pred: DataFrame, model: str = "model", split: str = "split") -> DataFrame:
    """A4: model x class precision / recall / F1 / support on the test split."""
    return M.per_class(pred.where(F.col(split) == "test"), [model])


def overfit_level(gap: Column) -> Column:
    """Gap < .02 Low, < .05 Moderate, < .10 High, else Severe."""
    expr = None
    for t, name in OVERFIT_THRESHOLDS:
        expr = F.when(gap < t, F.lit(name)) if expr is None else expr.when(gap < t, F.lit(name))
    return expr.otherwise(F.lit(OVERFIT_TOP))


def overfitting(scores: DataFrame, train: str = "train_accuracy", test: str = "test_accuracy") -> DataFrame:
    """Gap, gap / (test + 1e-8), level for every row of ``scores``."""
    gap = F.col(train) - F.col(test)
    return scores.select("*", gap.alias("gap"), (gap / (F.col(test) + F.lit(1e-8))).alias("gap_ratio"),
                         overfit_level(gap).alias("level"))


def _ln_gamma_half(a2: Column) -> Column:
    """ln Γ(a2 / 2) for a positive integer a2: ln Γ(1) = 0 or ln Γ(1/2) = ln √π, then the recurrence in logarithms."""
    even = a2 % 2 == 0
    start = F.when(even, F.lit(2)).otherwise(F.lit(1)).cast("int")
    steps = F.when(a2 - 2 >= start, F.sequence(start, (a2 - 2).cast("int"), F.lit(2))).otherwise(F.array().cast("array<int>"))
    first = F.when(even, F.lit(0.0)).otherwise(F.lit(0.5 * math.log(math.pi)))
    return F.aggregate(steps, first, lambda acc, j: acc + F.ln(j / F.lit(2.0)))


def chi2_sf(x: Column, df: Column) -> Column:
    """Upper tail of the χ² distribution with ``df`` degrees of freedom.

    Beyond x = df + 2 by the continued fraction of the upper incomplete gamma function (no cancellation, so tiny tails
    stay exact), below by one minus its power series. The number of terms grows with √df, which both need near x = df.
    """
    a, h = df.cast("double") / 2, x / 2
    n = (F.lit(200) + F.ceil(F.sqrt(df.cast("double")) * 20)).cast("int")
    front = F.exp(a * F.ln(h) - h - _ln_gamma_half(df))
    tiny = F.lit(1e-300)
    safe = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)

    def fraction(acc, i):
        num = -i * (i - a)
        b = acc["b"] + 2.0
        d = F.lit(1.0) / safe(b + num * acc["d"])
        c = safe(b + num / acc["c"])
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (acc["f"] * c * d).alias("f"))

    b0 = h + 1.0 - a
    d0 = F.lit(1.0) / safe(b0)
    upper = F.aggregate(F.sequence(F.lit(1), n), F.struct(b0.alias("b"), F.lit(1e300).alias("c"), d0.alias("d"), d0.alias("f")),
                        fraction)["f"]

    def series(acc, i):
        t = acc["t"] * h / (a + i)
        return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

    lower = F.aggregate(F.sequence(F.lit(1), n), F.struct((F.lit(1.0) / a).alias("t"), (F.lit(1.0) / a).alias("s")), series)["s"]
    return F.when(x <= 0, F.lit(1.0)).when(x > df + 2, front * upper).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - front * lower))


def friedman(per_class_scores: DataFrame, model: str = "model", block: str = "class",
             score: str = "recall") -> DataFrame:
    """A5: Friedman χ² over blocks (classes) x treatments (models), average ranks for
    ties, tie-corrected; p from the χ² tail with k - 1 df; fewer than 3 models → NULL."""
    wb = Window.partitionBy(block)
    wr = Window.partitionBy(block).orderBy(score)
    r = per_class_scores.select(model, block, score,
                                F.rank().over(wr).alias("_r"),
                                F.count(F.lit(1)).over(Window.partitionBy(block, score)).alias("_t"))
    r = r.withColumn("rank", F.col("_r") + (F.col("_t") - 1) / 2.0)
    ties = r.groupBy(block, score).agg(F.count(F.lit(1)).alias("t")).agg(
        F.sum(F.col("t").cast("double") * (F.col("t").cast("double") * F.col("t") - 1)).alias("ties"))
    rs = r.groupBy(model).agg(F.sum("rank").alias("R"))
    k_n = per_class_scores.agg(F.count_distinct(model).alias("k"), F.count_distinct(block).alias("n"))
    s = rs.agg(F.sum(F.col("R") * F.col("R")).alias("ssbn")).crossJoin(ties).crossJoin(k_n)
    k, n = F.col("k").cast("double"), F.col("n").cast("double")
    c = 1 - F.col("ties") / (k * (k * k - 1) * n)
    stat = (F.lit(12.0) / (k * n * (k + 1)) * F.col("ssbn") - 3 * n * (k + 1)) / c
    out = s.select(F.col("k").cast("long").alias("n_models"), F.col("n").cast("long").alias("n_blocks"),
                   F.when(F.col("k") >= 3, stat).alias("statistic"))
    out = out.withColumn("p_value", F.when(F.col("statistic").isNotNull(),
                                           chi2_sf(F.col("statistic"), F.col("n_models") - 1)))
    return out.withColumn("significant", F.col("p_value") < 0.05)


def mean_ranks(per_class_scores: DataFrame, model: str = "model", block: str = "class",
               score: str = "recall") -> DataFrame:
    """Average Friedman rank per model (ties averaged)."""
    wr = Window.partitionBy(block).orderBy(score)
    r = per_class_scores.select(model, block, F.rank().over(wr).alias("_r"),
                                F.count(F.lit(1)).over(Window.partitionBy(block, score)).alias("_t"))
    return r.groupBy(model).agg(F.avg(F.col("_r") + (F.col("_t") - 1) / 2.0).alias("mean_rank"))


def rank_differences(per_class_scores: DataFrame, model: str = "model", **kw) -> DataFrame:
    """V24 (re-aimed): pairwise mean-rank differences, a.model < b.model."""
    mr = mean_ranks(per_class_scores, model, **kw)
    a = mr.select(F.col(model).alias("model_a"), F.col("mean_rank").alias("rank_a"))
    b = mr.select(F.col(model).alias("model_b"), F.col("mean_rank").alias("rank_b"))
    return a.join(b, F.col("model_a") < F.col("model_b")).select(
        "model_a", "model_b", (F.col("rank_a") - F.col("rank_b")).alias("rank_diff"))


def degradation(acc: DataFrame, model: str = "model", condition: str = "noise_id",
                clean_value=0) -> DataFrame:
    """A10: clean accuracy - noisy accuracy per (model, condition); NULL accuracies skipped."""
    clean = F.max(F.when(F.col(condition) == clean_value, F.col("accuracy"))).over(Window.partitionBy(model))
    d = acc.withColumn("_clean", clean)
    return d.where((F.col(condition) != clean_value) & F.col("accuracy").isNotNull()).select(
        model, condition, (F.col("_clean") - F.col("accuracy")).alias("drop"))


def mean_drop(deg: DataFrame, model: str = "model") -> DataFrame:
    """A11."""
    return deg.groupBy(model).agg(F.avg("drop").alias("mean_drop"))


def robustness_table(acc: DataFrame, model: str = "model", condition: str = "noise_id") -> DataFrame:
    """Absolute accuracy and drop side by side."""
    d = degradation(acc, model, condition)
    return acc.join(d, [model, condition], "left").select(model, condition, "accuracy", "drop")


def timing_summary(timings: DataFrame) -> DataFrame:
    """Per (model, requested batch) the rows really scored, median seconds, rows/s and whether rows were too few."""
    med = timings.groupBy("model", "batch").agg(F.max("n_rows").alias("n_rows"), F.percentile("seconds", 0.5).alias("median_seconds"))
    return med.withColumn("rows_per_sec", F.col("n_rows") / F.col("median_seconds")).withColumn(
        "short", F.col("n_rows") < F.col("batch"))


def best_model(scores: DataFrame, model: str = "model", score: str = "accuracy") -> DataFrame:
    """Arg-max (ties: first model name)."""
    w = Window.orderBy(F.desc(score), F.asc(model))
    return scores.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select(
        F.col(model).alias("best_model"), F.col(score).alias(score))
