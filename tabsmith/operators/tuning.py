"""Hyper-parameter search for every model (T4, T5, T7) through one score table.

``search`` gives one row per (model, parameter set, fold) with the balanced accuracy of E2; ``operators.modeling``'s
``tuning_best`` (T6) picks from it. MLlib models are fitted per fold and parameter set from a thread pool, each fit
being a Spark job; all boosted candidates of a search are problems of one boosting run, all forests grow in one run; all
KNN candidates share one search per metric.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions.keyed import keyed_uniform
from tabsmith.functions.presets import CV_FOLDS, PARAM_GRIDS, SEED
from tabsmith.operators import boosting as BO
from tabsmith.operators import forest as FO
from tabsmith.operators import models as ML
from tabsmith.operators.modeling import knn_grid_scores
from tabsmith.operators.split import stratified_folds
from tabsmith.session import hold, in_threads

SCORES = "model string, params map<string,string>, fold int, n int, score double"


class BalancedAccuracy(Evaluator):
    """E2 as an MLlib evaluator: mean recall over the labels present, from one aggregate (MLlib has no such metric)."""

    def __init__(self, labelCol: str = "label_d", predictionCol: str = "prediction"):
        super().__init__()
        self.labelCol, self.predictionCol = labelCol, predictionCol

    def _evaluate(self, dataset: DataFrame) -> float:
        right = (F.col(self.predictionCol) == F.col(self.labelCol)).cast("double")
        rows = dataset.groupBy(self.labelCol).agg(F.avg(right).alias("recall"))
        found = rows.agg(F.avg("recall")).first()[0]
        return float("nan") if found is None else float(found)

    def isLargerBetter(self) -> bool:
        return True


def grid(space: dict[str, list]) -> list[dict]:
    """Every parameter set of a space, in the order of its lists."""
    return [dict(zip(space, values)) for values in product(*space.values())]


def draw_table(spark: SparkSession, space: dict[str, list], n_iter: int, seed: int = SEED) -> DataFrame:
    """T5: (draw, one string column per parameter): ``n_iter`` keyed draws from a space that is never listed.

    Each parameter's value comes from a uniform keyed by draw number and parameter name, so a space of any size costs the
    same. Draws may repeat a set, as independent draws do.
    """
    pick = lambda name, values: F.element_at(
        F.array(*[F.lit(str(v)) for v in values]),
        (F.floor(keyed_uniform(F.col("id"), F.lit(f"draw|{name}"), seed) * len(values)) + 1).cast("int"))
    return spark.range(n_iter).select(F.col("id").cast("int").alias("draw"), *[pick(n, v).alias(n) for n, v in space.items()])


def draws(spark: SparkSession, space: dict[str, list], n_iter: int, seed: int = SEED) -> list[dict]:
    """The drawn sets with the space's own typed values, in draw order (``n_iter`` rows come to the driver)."""
    typed = {n: {str(v): v for v in values} for n, values in space.items()}
    return [{n: typed[n][r[n]] for n in space} for r in draw_table(spark, space, n_iter, seed).orderBy("draw").collect()]


def _named(params: dict) -> dict[str, str]:
    return {k: str(v) for k, v in params.items()}


def mllib_scores(name: str, folds: DataFrame, cols: list[str], label: str, candidates: list[dict], n_folds: int,
                 n_classes: int, threads: int) -> list[tuple]:
    """Score rows of an MLlib model: every (candidate, fold) is a fit on the other folds. Candidates that differ only in
    parameters that MLlib has no use for (the solver's name) are fitted once, and so are those that differ only in a limit
    of steps that the fit with the highest one did not reach: it would have taken the same steps."""
    evaluate = BalancedAccuracy()
    spark = folds.sparkSession
    frames = {}
    for f in range(n_folds):
        part = folds.where(F.col("fold") != f)
        tr = ML.with_balanced_weight(ML.assemble(part, cols).withColumn("label_d", F.col(label).cast("double")), label)
        te = ML.assemble(folds.where(F.col("fold") == f), cols).withColumn("label_d", F.col(label).cast("double"))
        tr = ML.fit_frame(tr.select("label_d", "w", "features"), max(ML.mapped_width(name, len(cols), c) for c in candidates), threads)
        te = ML.fit_frame(te.select("label_d", "features"), len(cols), threads)
        frames[f] = (tr, tr.count(), te, te.count())
    ignored = {"solver", "penalty", "class_weight", "probability", "bootstrap", "min_samples_split"}
    work: dict = {}  # what else a fit depends on → limit of steps → candidates
    for i, params in enumerate(candidates):
        same = tuple(sorted((k, v) for k, v in _named(params).items() if k not in ignored and k != "max_iter"))
        work.setdefault(same, {}).setdefault(params.get("max_iter"), []).append(i)

    def one(task):
        limits, f = task
        tr, n_train, te, n_test = frames[f]
        rows, steps = [], None
        for limit in sorted(limits, key=lambda x: -1 if x is None else x, reverse=True):
            which = limits[limit]
            if steps is None or limit is None or steps >= limit:
                spec = ML.build(name, len(cols), float(n_train), candidates[which[0]], n_classes)
                pre = spec.pre.transform if spec.pre is not None else (lambda df: df)
                model = spec.estimator.fit(pre(tr))
                steps = model.summary.totalIterations if name == "logistic" else math.inf
                score = evaluate.evaluate(model.transform(pre(te)))
            rows += [(name, _named(candidates[i]), f, n_test, score) for i in which]
        return rows

    tasks = [(limits, f) for limits in work.values() for f in range(n_folds)]
    return [row for rows in in_threads(spark, one, tasks, threads) for row in rows]


def boosted_scores(name: str, folds: DataFrame, cols: list[str], label: str, key: str, candidates: list[dict],
                   n_folds: int, n_classes: int) -> DataFrame:
    """Score rows of a boosted model: every (candidate, fold) is a problem of one boosting run."""
    spark = folds.sparkSession
    problems = [(i * n_folds + f, i, f) for i in range(len(candidates)) for f in range(n_folds)]
    table = spark.createDataFrame(problems, "_problem int, _candidate int, _held int")
    copies = folds.crossJoin(F.broadcast(table))  # candidates x folds rows
    role = F.when(F.col("fold") == F.col("_held"), BO.OTHER).otherwise(BO.TRAIN)
    model = BO.fit(BO.problem_rows(copies, cols, label, key, role, F.col("_problem")),
                   {p: ML.boost_params(name, candidates[i]) for p, i, _ in problems}, n_classes)
    held = copies.where(F.col("fold") == F.col("_held")).select(
        F.col("_problem").alias("problem"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x"), F.col(label).cast("int").alias("y"),
        "_candidate", "_held")
    return _recalls(name, model.predict(held, ["y", "_candidate", "_held"]), candidates)


def _recalls(name: str, pred: DataFrame, candidates: list[dict]) -> DataFrame:
    """Score rows from the held-out predictions (_candidate, _held, y, predicted) of all candidates."""
    spark = pred.sparkSession
    recall = pred.groupBy("_candidate", "_held", "y").agg(F.count("*").alias("n"), F.avg((F.col("predicted") == F.col("y")).cast("double")).alias("r"))
    named = spark.createDataFrame([(i, _named(c)) for i, c in enumerate(candidates)], "_candidate int, params map<string,string>")
    return recall.groupBy("_candidate", "_held").agg(F.sum("n").cast("int").alias("n"), F.avg("r").alias("score")).join(
        F.broadcast(named), "_candidate").select(F.lit(name).alias("model"), "params", F.col("_held").alias("fold"), "n", "score")


def forest_scores(folds: DataFrame, cols: list[str], label: str, key: str, candidates: list[dict], n_folds: int,
                  n_classes: int) -> DataFrame:
    """Score rows of the forest: every (candidate, fold) is a forest of one run; those of a fold share its rows."""
    spark = folds.sparkSession
    table = spark.createDataFrame([(i * n_folds + f, i, f) for i in range(len(candidates)) for f in range(n_folds)], "forest int, _candidate int, _held int")
    held = F.broadcast(table.select("_held").distinct())  # one row per fold
    train = folds.crossJoin(held).where(F.col("fold") != F.col("_held"))
    model = FO.fit(FO.problem_rows(train, cols, label, key, F.col("_held")),
                   {i * n_folds + f: (f, ML.forest_params(c)) for i, c in enumerate(candidates) for f in range(n_folds)}, n_classes)
    rows = folds.join(F.broadcast(table), F.col("fold") == F.col("_held")).select(
        "forest", F.array(*[F.col(c).cast("double") for c in cols]).alias("x"), F.col(label).cast("int").alias("y"), "_candidate", "_held")
    return _recalls("random_forest", model.predict(rows, ["y", "_candidate", "_held"]), candidates)


def search(name: str, train: DataFrame, cols: list[str], label: str, key: str, candidates: list[dict],
           n_folds: int = CV_FOLDS, threads: int = 8, n_classes: int | None = None) -> DataFrame:
    """T4 / T5: (model, params, fold, n, score) for every candidate and stratified fold; ``n`` rows were scored."""
    n_classes = n_classes or int(train.agg(F.max(F.col(label).cast("int"))).first()[0]) + 1
    folds = hold(stratified_folds(train, label, key, k=n_folds))
    if name in ML.BOOSTED:
        return boosted_scores(name, folds, cols, label, key, candidates, n_folds, n_classes)
    if name == "random_forest":
        return forest_scores(folds, cols, label, key, candidates, n_folds, n_classes)
    if name == "knn":
        return _knn_scores(train, folds, cols, label, key, candidates, n_folds)
    rows = mllib_scores(name, folds, cols, label, candidates, n_folds, n_classes, threads)
    return train.sparkSession.createDataFrame(rows, SCORES)


def _knn_scores(train, folds, cols, label, key, candidates, n_folds) -> DataFrame:
    """The whole (k, weights, metric) table from one search per metric, joined to the candidates that ask for it."""
    spark = train.sparkSession
    metric = lambda c: {"minkowski": "euclidean" if c.get("p", 2) == 2 else "manhattan"}.get(c["metric"], c["metric"])
    table = knn_grid_scores(train, key, cols, label, sorted({c["n_neighbors"] for c in candidates}),
                            sorted({c["weights"] for c in candidates}), n_folds, tuple(sorted({metric(c) for c in candidates})))
    asked = spark.createDataFrame([(_named(c), c["n_neighbors"], c["weights"], metric(c)) for c in candidates],
                                  "params map<string,string>, k int, weights string, metric string")
    sizes = folds.groupBy("fold").agg(F.count("*").cast("int").alias("n"))
    return F.broadcast(asked).join(table, ["k", "weights", "metric"]).join(sizes, "fold").select(
        F.lit("knn").alias("model"), "params", "fold", "n", "score")


def tune_all(train: DataFrame, cols: list[str], label: str, key: str, spaces: dict[str, tuple[str, dict, int]] | None = None,
             n_folds: int = CV_FOLDS, threads: int = 8) -> DataFrame:
    """The score tables of every model that has a space; a space is (method, values, draws of a random search)."""
    out = None
    for name, (method, space, n_iter) in (spaces or PARAM_GRIDS).items():
        candidates = grid(space) if method == "grid" else draws(train.sparkSession, space, n_iter)
        part = search(name, train, cols, label, key, candidates, n_folds, threads)
        out = part if out is None else out.unionByName(part)
    return out


def best_params(scores: DataFrame) -> DataFrame:
    """T6 per model: (model, params, mean_score, std_score), the highest mean; ties go to the first set in text order."""
    from pyspark.sql import Window

    text = F.array_join(F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    m = scores.withColumn("_text", text).groupBy("model", "_text").agg(
        F.first("params").alias("params"), F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"))
    w = Window.partitionBy("model").orderBy(F.desc(F.round("mean_score", 12)), "_text")  # one row per candidate
    return m.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("model", "params", "mean_score", "std_score")
