"""Classification metrics (E0-E11) from ONE aggregate.

Input: predictions ``(grp..., row_id, actual, predicted[, proba])``. Everything
derives from ``groupBy(grp, actual, predicted).count()`` (partial aggregation
map-side, so at most groups x k^2 rows are shuffled), then works on that tiny
table. Definitions follow scikit-learn: labels = union of those seen in actual
or predicted; zero division → 0; balanced accuracy averages recall over the
classes present in ``actual``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tabsmith.session import hold

EPS = 2.220446049250313e-16


def confusion_counts(pred: DataFrame, grp: list[str]) -> DataFrame:
    return pred.groupBy(*grp, "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(pred: DataFrame, grp: list[str], counts: DataFrame | None = None) -> DataFrame:
    """(grp..., actual, predicted, n) including zero cells over the label union."""
    # ≤ groups x k² rows: computed once, reused by the label grid and the join
    c = hold(counts if counts is not None else confusion_counts(pred, grp))
    labels = (c.select(*grp, F.col("actual").alias("l")).unionByName(c.select(*grp, F.col("predicted").alias("l")))
              .distinct())
    grid = labels.withColumnRenamed("l", "actual").join(labels.withColumnRenamed("l", "predicted"), grp)
    return grid.join(c, grp + ["actual", "predicted"], "left").select(
        *grp, "actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def confusion_normalised(pred: DataFrame, grp: list[str]) -> DataFrame:
    """N / row sum (rows of absent actual classes have no row sum and are dropped)."""
    cm = confusion_matrix(pred, grp)
    rs = F.sum("n").over(Window.partitionBy(*grp, "actual"))
    return cm.withColumn("row_n", rs).where(F.col("row_n") > 0).select(
        *grp, "actual", "predicted", "n", (F.col("n") / F.col("row_n")).alias("share"))


def _div0(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def class_totals(pred: DataFrame, grp: list[str]) -> DataFrame:
    """(grp..., class, support, pred_n, tp) for every label seen in actual or predicted, from the confusion counts.

    Each count goes to its row's and its column's class, so no zero cells and no joins are needed.
    """
    n, zero = F.col("n"), F.lit(0).cast("long")
    tp = F.when(F.col("actual") == F.col("predicted"), n).otherwise(zero)
    sides = F.explode(F.array(F.struct(F.col("actual").alias("class"), n.alias("support"), zero.alias("pred_n"), tp.alias("tp")),
                              F.struct(F.col("predicted").alias("class"), zero.alias("support"), n.alias("pred_n"), zero.alias("tp"))))
    return confusion_counts(pred, grp).select(*grp, sides.alias("_s")).groupBy(*grp, F.col("_s.class").alias("class")).agg(
        *[F.sum(f"_s.{c}").cast("long").alias(c) for c in ("support", "pred_n", "tp")])


def per_class(pred: DataFrame, grp: list[str]) -> DataFrame:
    """(grp..., class, precision, recall, f1, support)."""
    p = _div0(F.col("tp"), F.col("pred_n"))
    r = _div0(F.col("tp"), F.col("support"))
    j = class_totals(pred, grp).select(*grp, "class", p.alias("precision"), r.alias("recall"), "support")
    f1 = _div0(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return j.select(*grp, "class", "precision", "recall", f1.alias("f1"), "support")


def metrics_wide(pred: DataFrame, grp: list[str]) -> DataFrame:
    """One row per group with every scalar metric, two small aggregates over the confusion counts."""
    p = _div0(F.col("tp"), F.col("pred_n"))
    r = _div0(F.col("tp"), F.col("support"))
    pc = class_totals(pred, grp).withColumns({"precision": p, "recall": r})
    pc = pc.withColumn("f1", _div0(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    t, q = F.col("support").cast("double"), F.col("pred_n").cast("double")  # squares of counts leave 64 bits
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    j = pc.groupBy(*grp).agg(
        F.sum(t).alias("s"), F.sum(F.col("tp").cast("double")).alias("c"), F.sum(t * q).alias("sum_tp"), F.sum(t * t).alias("sum_tt"),
        F.sum(q * q).alias("sum_pp"), F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"), F.avg("f1").alias("f1_macro"),
        weighted("precision").alias("precision_weighted"), weighted("recall").alias("recall_weighted"), weighted("f1").alias("f1_weighted"))
    po = F.col("c") / F.col("s")
    pe = F.col("sum_tp") / (F.col("s") * F.col("s"))
    kappa = _div0(po - pe, 1 - pe)
    den = F.sqrt((F.col("s") * F.col("s") - F.col("sum_pp")) * (F.col("s") * F.col("s") - F.col("sum_tt")))
    mcc = _div0(F.col("c") * F.col("s") - F.col("sum_tp"), den)
    return j.select(*grp, po.alias("accuracy"), "balanced_accuracy", "precision_macro", "recall_macro", "f1_macro",
                    "precision_weighted", "recall_weighted", "f1_weighted", kappa.alias("cohen_kappa"),
                    mcc.alias("matthews_corrcoef"))


def classification_report(pred: DataFrame, grp: list[str]) -> DataFrame:
    """Per class + accuracy + macro avg + weighted avg → (grp..., row, precision, recall, f1, support)."""
    pc = per_class(pred, grp)
    per = pc.select(*grp, F.col("class").cast("string").alias("row"), "precision", "recall", "f1", "support")
    macro = pc.groupBy(*grp).agg(F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
                                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                                 F.sum("support").cast("long").alias("support"))
    wavg = pc.groupBy(*grp).agg(
        F.lit("weighted avg").alias("row"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
        F.sum("support").cast("long").alias("support"))
    acc = pred.groupBy(*grp).agg(
        F.lit("accuracy").alias("row"),
        F.avg(F.when(F.col("actual") == F.col("predicted"), 1.0).otherwise(0.0)).alias("precision"))
    acc = acc.select(*grp, "row", "precision", F.col("precision").alias("recall"), F.col("precision").alias("f1"),
                     F.lit(None).cast("long").alias("support"))
    return per.unionByName(acc).unionByName(macro).unionByName(wavg)


def log_loss(pred: DataFrame, grp: list[str]) -> DataFrame:
    """-mean ln p[actual], p clipped to [eps, 1 - eps]."""
    p = F.element_at(F.col("proba"), F.col("actual") + 1)
    clipped = F.least(F.greatest(p, F.lit(EPS)), F.lit(1 - EPS))
    return pred.groupBy(*grp).agg((-F.avg(F.ln(clipped))).alias("log_loss"))


def accuracy(pred: DataFrame, grp: list[str]) -> DataFrame:
    """E1 alone (e.g. train accuracy per model)."""
    return pred.groupBy(*grp).agg(F.avg(F.when(F.col("actual") == F.col("predicted"), 1.0).otherwise(0.0))
                                  .alias("accuracy"))
