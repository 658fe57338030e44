"""Cross-validation, learning curves and fold scoring (T2, T3) for the KNN path,
plus summaries shared with the MLlib models.

Several independent KNN problems (5 folds, 10 train sizes x 5 folds, 15 noise
settings) run as ONE Spark job: donors are replicated into their problem
group and ``knn_classify(by=[group])`` only pairs rows of the same group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tabsmith.session import hold


from tabsmith.functions.presets import CV_FOLDS
from tabsmith.operators.knn import knn_classify, knn_search
from tabsmith.operators.split import class_rank, stratified_folds


def accuracy_by(pred: DataFrame, truth: DataFrame, key: str, label: str, grp: list[str]) -> DataFrame:
    j = pred.join(truth.select(F.col(key).alias("row_id"), F.col(label).alias("_y")), "row_id")
    return j.groupBy(*grp).agg(F.avg(F.when(F.col("predicted") == F.col("_y"), 1.0).otherwise(0.0)).alias("accuracy"))


def knn_cv_scores(train: DataFrame, key: str, cols: list[str], label: str, k: int = 5,
                  folds: int = CV_FOLDS) -> DataFrame:
    """T2 (KNN): per-fold accuracy → (fold, accuracy)."""
    f = hold(stratified_folds(train, label, key, k=folds))
    cv = train.sparkSession.range(folds).select(F.col("id").cast("int").alias("cv"))
    q = f.withColumn("cv", F.col("fold"))
    d = f.crossJoin(F.broadcast(cv)).where(F.col("fold") != F.col("cv"))  # folds-1 copies of each row
    p = knn_classify(d, q, key, cols, label, k=k, by=["cv"])
    return accuracy_by(p, q.select(key, label).distinct(), key, label, ["cv"]).withColumnRenamed("cv", "fold")


def cv_summary(scores: DataFrame, score: str = "accuracy") -> DataFrame:
    """T2 summary: each fold score with mean, population std, min and max over folds."""
    from pyspark.sql import Window
    w = Window.partitionBy()
    return scores.select("fold", score, F.avg(score).over(w).alias("mean"), F.stddev_pop(score).over(w).alias("std"),
                         F.min(score).over(w).alias("min"), F.max(score).over(w).alias("max"))


def knn_learning_curve(train: DataFrame, key: str, cols: list[str], label: str, sizes: list[float], k: int = 5,
                       folds: int = CV_FOLDS) -> DataFrame:
    """T3 (KNN): for each train fraction and fold, fit on the first rows (keyed order)
    of the fold's training part; score those rows and the held-out fold.
    → (train_size, train_mean, train_std, val_mean, val_std)."""
    spark = train.sparkSession
    f = hold(stratified_folds(train, label, key, k=folds))
    cv = spark.range(folds).select(F.col("id").cast("int").alias("cvf"))
    tpos = class_rank(f.crossJoin(F.broadcast(cv)).where(F.col("fold") != F.col("cvf")), "cvf", key, "lc", out="pos")
    ntr = tpos.groupBy("cvf").agg(F.count(F.lit(1)).alias("ntr"))
    # prefixes hold the shorter ones, so a row is a donor from its first size on and one search per fold serves all sizes
    sizes = sorted(float(x) for x in sizes)
    sz = spark.createDataFrame(list(enumerate(sizes)), "si int, frac double")
    n_train = F.floor(F.col("frac") * F.col("ntr")).cast("long")
    too_short = F.lit(0)
    for x in sizes:
        too_short = too_short + (F.floor(F.lit(x) * F.col("ntr")) <= F.col("pos")).cast("int")
    pref = hold(tpos.join(F.broadcast(ntr), "cvf").withColumn("step", too_short).where(F.col("step") < len(sizes)).select(
        "cvf", "step", key, label, *cols))
    val_q = f.select(F.col("fold").alias("cvf"), F.lit(0).alias("step"), key, *cols)
    grp = ["si", "cvf"]
    # same rows as queries: fresh column ids keep the self-join unambiguous
    train_q = pref.select(*[F.col(c).alias(c) for c in pref.columns])
    labels = pref.select("cvf", F.col(key).alias("did"), F.col("step").alias("_from"), F.col(label).cast("int").alias("nlabel"))

    def classified(queries):
        near = knn_search(queries, pref, key, cols, k, by=["cvf"], step="step", n_steps=len(sizes)).withColumnRenamed("step", "si")
        near = near.join(labels, ["cvf", "did"]).where(F.col("_from") <= F.col("si")).drop("_from")
        return knn_classify(pref, queries, key, cols, label, k=k, by=grp, neighbours=near)

    pv, pt = classified(val_q), classified(train_q)
    truth = f.select(key, label)
    va = accuracy_by(pv, truth, key, label, grp).withColumnRenamed("accuracy", "va")
    ta = accuracy_by(pt, truth, key, label, grp).withColumnRenamed("accuracy", "ta")
    ns = ntr.crossJoin(F.broadcast(sz)).where(n_train > 0).groupBy("si").agg(F.max(n_train).alias("train_size"))
    j = va.join(ta, grp).join(ns, "si")
    return j.groupBy("si", "train_size").agg(
        F.avg("ta").alias("train_mean"), F.stddev_pop("ta").alias("train_std"),
        F.avg("va").alias("val_mean"), F.stddev_pop("va").alias("val_std")).drop("si")


def balanced_accuracy_by(pred: DataFrame, truth: DataFrame, key: str, label: str, grp: list[str]) -> DataFrame:
    """Balanced accuracy (mean recall over classes present) per group, one aggregate."""
    j = pred.join(truth.select(F.col(key).alias("row_id"), F.col(label).alias("_y")), "row_id")
    rec = j.groupBy(*grp, "_y").agg(F.avg(F.when(F.col("predicted") == F.col("_y"), 1.0).otherwise(0.0)).alias("r"))
    return rec.groupBy(*grp).agg(F.avg("r").alias("score"))


def knn_grid_scores(train: DataFrame, key: str, cols: list[str], label: str, ks: list[int], weights: list[str],
                    folds: int = CV_FOLDS, metrics: tuple[str, ...] = ("euclidean", "manhattan")) -> DataFrame:
    """T4 (KNN): 5-fold balanced accuracy for every (k, weights, metric) → (k, weights, metric, fold, score).

    One top-max(k) search covers every k and weighting (no refits) and every metric: rows meet once for both distances."""
    f = hold(stratified_folds(train, label, key, k=folds))
    cv = train.sparkSession.range(folds).select(F.col("id").cast("int").alias("cv"))
    q = f.withColumn("cv", F.col("fold"))
    d = f.crossJoin(F.broadcast(cv)).where(F.col("fold") != F.col("cv"))
    near = knn_search(q, d, key, cols, max(ks), by=["cv"], metrics=tuple(metrics))
    labels = d.select("cv", F.col(key).alias("did"), F.col(label).cast("int").alias("nlabel"))
    p = knn_classify(d, q, key, cols, label, ks=ks, by=["metric", "cv"], weights=list(weights), neighbours=near.join(labels, ["cv", "did"]))
    return balanced_accuracy_by(p, f, key, label, ["metric", "weights", "cv", "k"]).select(
        F.col("k").cast("int").alias("k"), "weights", "metric", F.col("cv").cast("int").alias("fold"), "score")


def tuning_best(scores: DataFrame, params: list[str], score: str = "score") -> DataFrame:
    """Mean / population std per parameter set; the best by mean (ties: parameter order)."""
    from pyspark.sql import Window
    m = scores.groupBy(*params).agg(F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"))
    # equal means can differ in their last bits with the order of the folds
    w = Window.orderBy(F.desc(F.round("mean_score", 12)), *[F.asc(p) for p in params])
    return m.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def param_sensitivity(scores: DataFrame, params: list[str], score: str = "score") -> DataFrame:
    """Mean score per (parameter, value)."""
    out = None
    for p in params:
        s = scores.groupBy(F.lit(p).alias("param"), F.col(p).cast("string").alias("value")).agg(
            F.avg(score).alias("mean_score"))
        out = s if out is None else out.unionByName(s)
    return out


def knn_random_scores(train: DataFrame, key: str, cols: list[str], label: str, ks: list[int], weights: list[str],
                      n_iter: int, folds: int = CV_FOLDS, seed: int = 42) -> DataFrame:
    """T5 (KNN): n_iter candidates drawn by keyed hash from k x weights, scored like T4."""
    from tabsmith.functions.keyed import keyed_uniform

    spark = train.sparkSession
    space = spark.createDataFrame([(k, w) for k in ks for w in weights], "k int, weights string")
    u = keyed_uniform(F.concat(F.col("k").cast("string"), F.lit("|"), F.col("weights")), "rs", seed)
    # n_iter rows (bounded) choose which searches to run
    chosen = space.orderBy(u, "k", "weights").limit(n_iter).collect()
    picked = spark.createDataFrame([(r.k, r.weights) for r in chosen], "k int, weights string")
    scores = knn_grid_scores(train, key, cols, label, sorted({r.k for r in chosen}),
                             sorted({r.weights for r in chosen}), folds, ("euclidean",))
    return scores.join(F.broadcast(picked), ["k", "weights"], "left_semi")
