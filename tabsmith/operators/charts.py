"""Tables behind the charts (V1-V27): small DataFrames computed by Spark jobs.

Drawing is out of scope; each function returns exactly the data a chart needs.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.presets import (BOX_TOP_N, CONFUSION_LABEL_MIN, CURVE_TAIL, CURVE_TAIL_WHEN, HIST_BINS,
                                        IMPORTANCE_TOP, IMPORTANCE_TOP_PER_MODEL, KDE_GRID)
from tabsmith.operators.quantile import quantiles, to_long
from tabsmith.session import cut_lineage, hold

CURVE_RANGE_ROWS = 500_000


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """V3: Pearson r for the lower triangle incl. diagonal, one aggregate → (a, b, r)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[: i + 1]]
    agg = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = agg.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                                   F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs])).alias("s"))
    return long.select("s.a", "s.b", "s.r")


def histograms(df: DataFrame, cols: list[str], bins: int = HIST_BINS) -> DataFrame:
    """V4: equal-width bins over [min, max] per feature (NULLs dropped) → (feature, bin, lo, hi, n)."""
    long = to_long(df, cols)
    mm = long.groupBy("feature").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    j = long.join(F.broadcast(mm), "feature")  # one row per feature
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    h = j.groupBy("feature", b.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    return h.select("feature", "bin", (F.col("_lo") + F.col("bin") * width).alias("lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("hi"), "n")


def box_stats(df: DataFrame, cols: list[str], label: str, top_n: int = BOX_TOP_N,
              method: str = "exact") -> DataFrame:
    """V5: per (feature, class) for the first ``top_n`` features: quartiles, whiskers
    (extreme values inside Q1 - 1.5 IQR .. Q3 + 1.5 IQR) and outlier count."""
    cols = cols[:top_n]
    long = to_long(df, cols, [label])
    q = quantiles(long, [0.25, 0.5, 0.75], [label, "feature"], method=method)
    qw = q.groupBy(label, "feature").agg(*[F.max(F.when(F.col("prob") == p, F.col("q"))).alias(n)
                                           for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    iqr = F.col("q3") - F.col("q1")
    qw = qw.select("*", (F.col("q1") - 1.5 * iqr).alias("_lo"), (F.col("q3") + 1.5 * iqr).alias("_hi"))
    j = long.join(qw, [label, "feature"])
    inside = (F.col("value") >= F.col("_lo")) & (F.col("value") <= F.col("_hi"))
    return j.groupBy(label, "feature", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))


def density_grid(df: DataFrame, col: str, grid: int = KDE_GRID, bins: int = 1024, tag: str = "") -> DataFrame:
    """V8: Gaussian KDE on a ``grid``-point grid over [min, max], Scott bandwidth
    std_samp · n^(-1/5). Values are first binned (``bins`` centres, one aggregate),
    so the grid x centres cross join is grid x bins rows whatever n is."""
    x = F.col(col)
    v = df.where(x.isNotNull()).select(x.cast("double").alias("x"))
    st = v.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
               F.stddev_samp("x").alias("sd"))
    j = v.crossJoin(F.broadcast(st))  # one row
    w = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / w), F.lit(bins - 1))).cast("int")
    hist = j.groupBy(b.alias("bin"), "n", "lo", "hi", "sd").agg(F.count(F.lit(1)).alias("c"))
    hist = hist.withColumn("centre", F.col("lo") + (F.col("bin") + 0.5) * w)
    g = df.sparkSession.range(grid).select(F.col("id").cast("int").alias("gi"))
    pts = hist.crossJoin(F.broadcast(g))  # bins x grid rows
    gx = F.col("lo") + F.col("gi") * (F.col("hi") - F.col("lo")) / (grid - 1)
    h = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    z = (gx - F.col("centre")) / h
    dens = pts.groupBy("gi", gx.alias("x"), "n", h.alias("h")).agg(F.sum(F.col("c") * F.exp(-0.5 * z * z)).alias("s"))
    out = dens.select(F.lit(tag).alias("series"), "gi", "x",
                      (F.col("s") / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))
    return out


def top_k(df: DataFrame, score: str, k: int = IMPORTANCE_TOP, name: str = "feature") -> DataFrame:
    """K best rows by score (ties: name) → (rank, name, score)."""
    w = Window.orderBy(F.desc(score), F.asc(name))
    return df.select(name, score, F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)


def top_k_per_group(df: DataFrame, grp: str, score: str, k: int = IMPORTANCE_TOP_PER_MODEL,
                    name: str = "feature") -> DataFrame:
    """K best per group (window top-k; WindowGroupLimit prunes before the shuffle)."""
    w = Window.partitionBy(grp).orderBy(F.desc(score), F.asc(name))
    return df.select(grp, name, score, F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)


def score_bars(comp: DataFrame, metrics=("accuracy", "balanced_accuracy", "f1_weighted")) -> DataFrame:
    """(model, metric, value)."""
    return comp.unpivot(["model"], list(metrics), "metric", "value")


def curve_tail(curve: DataFrame, grp: list[str], order: str, n: int = CURVE_TAIL,
               when_over: int = CURVE_TAIL_WHEN) -> DataFrame:
    """Keep the last ``n`` points of each curve that has more than ``when_over``.

    The rank filter comes first, so Spark keeps at most that many rows of a curve per task before the shuffle;
    a curve is long when the kept rows already exceed ``when_over``."""
    wd = Window.partitionBy(*grp).orderBy(F.desc(order))
    ends = curve.withColumn("_rd", F.row_number().over(wd)).where(F.col("_rd") <= max(n, when_over + 1))
    c = ends.withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy(*grp)))
    return c.where((F.col("_cnt") <= when_over) | (F.col("_rd") <= n)).drop("_cnt", "_rd")


def confusion_grid(norm: DataFrame, min_share: float = CONFUSION_LABEL_MIN) -> DataFrame:
    """Row-normalised cells with the 'labelled' flag (share > 0.05)."""
    return norm.withColumn("labelled", F.col("share") > min_share)


def f1_heatmap(per_class: DataFrame, classes: list) -> DataFrame:
    """Model x class F1 grid, absent → 0."""
    p = per_class.groupBy("model").pivot("class", classes).agg(F.first("f1"))
    return p.select("model", *[F.coalesce(F.col(str(c)), F.lit(0.0)).alias(f"f1_{c}") for c in classes])


def robustness_heatmap(rob: DataFrame, noise_ids: list[int]) -> DataFrame:
    """Model x noise accuracy grid (no clean column), absent → 0."""
    p = rob.where(F.col("noise_id") != 0).groupBy("model").pivot("noise_id", noise_ids).agg(F.first("accuracy"))
    return p.select("model", *[F.coalesce(F.col(str(i)), F.lit(0.0)).alias(f"noise_{i}") for i in noise_ids])


def radar(comp: DataFrame, over: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Accuracy, balanced, weighted F1, kappa, speed min(1, .01/max(t, 1e-6)) (t absent → .01),
    anti-overfit max(0, 1 - 10 · gap)."""
    j = comp.join(over.select("model", "gap"), "model", "left")
    if times is not None:
        j = j.join(times.select("model", "seconds"), "model", "left")
    else:
        j = j.withColumn("seconds", F.lit(None).cast("double"))
    t = F.when(F.col("seconds").isNull() | (F.col("seconds") == 0), F.lit(0.01)).otherwise(F.col("seconds"))
    return j.select("model", "accuracy", "balanced_accuracy", "f1_weighted", "cohen_kappa",
                    F.least(F.lit(1.0), F.lit(0.01) / F.greatest(t, F.lit(1e-6))).alias("speed"),
                    F.greatest(F.lit(0.0), 1 - 10 * F.col("gap")).alias("anti_overfit"))


def learning_bands(curve: DataFrame) -> DataFrame:
    """Mean ± std bands."""
    return curve.select("train_size", "train_mean", (F.col("train_mean") - F.col("train_std")).alias("train_lo"),
                        (F.col("train_mean") + F.col("train_std")).alias("train_hi"), "val_mean",
                        (F.col("val_mean") - F.col("val_std")).alias("val_lo"),
                        (F.col("val_mean") + F.col("val_std")).alias("val_hi"))


def cv_box(scores: DataFrame, grp: str = "model", score: str = "accuracy") -> DataFrame:
    """Fold-score quartiles per model."""
    long = scores.select(grp, F.col(score).alias("value"))
    q = quantiles(long, [0.0, 0.25, 0.5, 0.75, 1.0], [grp], method="inmemory")
    return q.groupBy(grp).agg(*[F.max(F.when(F.col("prob") == p, F.col("q"))).alias(n) for p, n in
                                ((0.0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "max"))])


def _ovr_counts(pred: DataFrame, grp: list[str], n_classes: int, digits: int | None) -> DataFrame:
    """(grp..., class, score, pos, neg): one-vs-rest counts per distinct score."""
    cls = pred.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("class"))
    j = pred.crossJoin(F.broadcast(cls))
    s = F.element_at(F.col("proba"), F.col("class") + 1)
    if digits is not None:
        s = F.round(s, digits)
    return j.groupBy(*grp, "class", s.alias("score")).agg(
        F.sum(F.when(F.col("actual") == F.col("class"), 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("actual") != F.col("class"), 1).otherwise(0)).alias("neg"))


def _score_ranges(c: DataFrame, part: list[str], rows_per_range: int) -> DataFrame:
    """``c`` with ``_range``: a number that rises with the score and splits each (part) into bounded ranges.

    Range bounds are a quantile sketch of each part's scores. A row is placed in two steps (a head, then the bounds
    behind it), so its cost grows with the root of the number of ranges. NULL scores form range -1."""
    n = c.count()
    if n <= rows_per_range:
        return c.withColumn("_range", F.lit(0))
    n_cuts = -(-n // rows_per_range)
    step = max(2, round(n_cuts ** 0.5))
    sketch = F.percentile_approx("score", [i / n_cuts for i in range(1, n_cuts)] or [0.5], max(10_000, 8 * n_cuts))
    # a sketch may differ when merged in another order: written once, so that a lost executor changes no range
    bounds = cut_lineage(c.groupBy(*part).agg(F.array_distinct(sketch).alias("_cuts")))
    heads = F.filter("_cuts", lambda x, i: i % step == 0)
    bounds = bounds.select(*[F.col(p).alias(f"_k_{p}") for p in part], "_cuts", heads.alias("_heads"))
    on = [F.col(p).eqNullSafe(F.col(f"_k_{p}")) for p in part]
    j = c.join(bounds, on, "left").drop(*[f"_k_{p}" for p in part])
    head = F.size(F.filter("_heads", lambda x: x <= F.col("score")))
    first = F.greatest(F.col("_h") - 1, F.lit(0)) * step
    behind = F.size(F.filter(F.slice("_cuts", first + 1, step), lambda x: x <= F.col("score")))
    return (j.withColumn("_h", head)
            .withColumn("_range", F.when(F.col("score").isNull() | F.col("_cuts").isNull(), -1)
                        .otherwise(first + behind))
            .drop("_h", "_cuts", "_heads"))


def roc_points(pred: DataFrame, grp: list[str], n_classes: int, digits: int | None = None,
               rows_per_range: int = CURVE_RANGE_ROWS) -> DataFrame:
    """One-vs-rest ROC points per distinct threshold
    → (grp..., class, threshold, fpr, tpr, precision, fpr_before, tpr_before).

    Counts are aggregated per (class, score) first. A curve's distinct scores are cut into ranges of about
    ``rows_per_range``; sums per range give each its offset, and the running sum stays within a range, so a single
    (model, class) is spread over tasks like any other. ``*_before`` is the point before (0 at the start).
    ``digits`` rounds scores when they are too many."""
    part = grp + ["class"]
    c = _score_ranges(hold(_ovr_counts(pred, grp, n_classes, digits)), part, rows_per_range)
    sums = c.groupBy(*part, "_range").agg(F.sum("pos").alias("_rp"), F.sum("neg").alias("_rn"))
    above = Window.partitionBy(*part).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*part)
    sums = sums.select(*[F.col(x).alias(f"_k_{x}") for x in [*part, "_range"]],
                       F.coalesce(F.sum("_rp").over(above), F.lit(0)).alias("_tp0"),
                       F.coalesce(F.sum("_rn").over(above), F.lit(0)).alias("_fp0"),
                       F.sum("_rp").over(whole).alias("P"), F.sum("_rn").over(whole).alias("N"))
    c = c.join(sums, [F.col(x).eqNullSafe(F.col(f"_k_{x}")) for x in [*part, "_range"]])
    w = (Window.partitionBy(*part, "_range").orderBy(F.desc("score"))
         .rowsBetween(Window.unboundedPreceding, 0))
    c = c.select(*part, "score", "pos", "neg", "P", "N", (F.col("_tp0") + F.sum("pos").over(w)).alias("tp"),
                 (F.col("_fp0") + F.sum("neg").over(w)).alias("fp"))
    return c.select(*part, F.col("score").alias("threshold"),
                    F.when(F.col("N") > 0, F.col("fp") / F.col("N")).alias("fpr"),
                    F.when(F.col("P") > 0, F.col("tp") / F.col("P")).alias("tpr"),
                    F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    F.when(F.col("N") > 0, (F.col("fp") - F.col("neg")) / F.col("N")).alias("fpr_before"),
                    F.when(F.col("P") > 0, (F.col("tp") - F.col("pos")) / F.col("P")).alias("tpr_before"))


def roc_auc(points: DataFrame, grp: list[str]) -> DataFrame:
    """Trapezoid area under (fpr, tpr) of ``roc_points``, starting from (0, 0). One aggregate, no window."""
    strip = (F.col("fpr") - F.col("fpr_before")) * (F.col("tpr") + F.col("tpr_before")) / 2
    return points.groupBy(*grp, "class").agg(F.sum(strip).alias("auc"))


def average_precision(points: DataFrame, grp: list[str]) -> DataFrame:
    """AP = Σ (R_n - R_{n-1}) · P_n over decreasing thresholds of ``roc_points``, R_0 = 0. One aggregate."""
    step = (F.col("tpr") - F.col("tpr_before")) * F.col("precision")
    return points.groupBy(*grp, "class").agg(F.sum(step).alias("average_precision"))
