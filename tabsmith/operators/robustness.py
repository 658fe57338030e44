"""Robustness of the models to training noise.

The training table is copied once per noise setting (clean + 14) in one projection: the row's features are an array, the
setting's type and size are columns, and the keyed noise of a cell depends on (row, setting, feature), so no cell is
shuffled and the plan has one expression whatever the number of features and settings. Label flips use the exact
per-setting rank. KNN searches all copies in one grouped search (those with flipped labels
share the clean copy's neighbours), boosting and forests grow them as problems of one run; MLlib
models fit one copy at a time from a thread pool.
"""

from __future__ import annotations

import logging

from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.keyed import keyed_normal, keyed_uniform
from tabsmith.functions.presets import OUTLIER_MAGNITUDE, SEED
from tabsmith.operators import boosting as BO
from tabsmith.operators import forest as FO
from tabsmith.operators import models as ML
from tabsmith.operators.knn import knn_classify, knn_search
from tabsmith.operators.noise import noise_configs
from tabsmith.operators.split import class_rank
from tabsmith.operators.stats import moments
from tabsmith.session import hold, in_threads

RESULT = ("model", "noise_id", "type", "param", "label", "accuracy")
ROWS_PER_TASK = 250  # at least, when noisy copies are made
ROWS_PER_SCORE = 20_000  # of a copy's test rows, by one task
CLEAN = 0  # the setting without noise
NO_FIT = (ArithmeticError, ValueError, RuntimeError, IllegalArgumentException)  # what a model says of rows it cannot be fitted to
log = logging.getLogger(__name__)


def settings(spark) -> DataFrame:
    """Clean setting (noise_id 0) + the 14 noise configurations."""
    clean = spark.createDataFrame([(0, "clean", 0.0, 0.0, "clean", "none")],
                                  "noise_id int, type string, param double, ratio double, label string, category string")
    return clean.unionByName(noise_configs(spark))


def noisy_copies(train: DataFrame, cols: list[str], label: str, key: str, n_classes: int,
                 seed: int = SEED) -> DataFrame:
    """(noise_id, key, label, cols...) — one noisy copy of ``train`` per setting, the same values as ``apply_noise``."""
    plain, labelled = _copies(train, cols, label, key, n_classes, seed)
    return plain.unionByName(labelled)


def _copies(train: DataFrame, cols: list[str], label: str, key: str, n_classes: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """``noisy_copies`` in two tables: the clean copy and those with noise in features, and those with flipped labels."""
    base = hold(train.select(F.col(key).alias("_key"), F.col(label).alias("_label"), *[F.col(c).cast("double").alias(c) for c in cols]))
    stats = moments(base, cols).select(*[F.array(*[F.col(f"{s}__{c}") for c in cols]).alias(f"_{s}") for s in ("mean", "std", "min", "max")])
    cfg = settings(train.sparkSession).select("noise_id", "type", "ratio")
    n, cores = base.count(), train.sparkSession.sparkContext.defaultParallelism
    # a fit's table has few partitions, but a noisy copy is made cell by cell
    parts = max(1, min(2 * cores, n // ROWS_PER_TASK), -(-n // ML.ROWS_PER_PARTITION))
    rows = base.select("_key", "_label", F.array(*cols).alias("_x")).repartition(parts).crossJoin(F.broadcast(stats)).crossJoin(F.broadcast(cfg))  # 1 and 15 rows
    names = F.array(*[F.lit(c) for c in cols])

    def cell(x, i):
        tag = lambda what: F.concat(F.lit(f"{what}|"), F.col("noise_id").cast("string"), F.lit("|"), F.get(names, i))
        u = lambda what: keyed_uniform(F.col("_key"), tag(what), seed)
        at = lambda s: F.get(F.col(f"_{s}"), i)
        sign = F.when(u("os") < 0.5, F.lit(1.0)).otherwise(F.lit(-1.0))
        return (F.when(F.col("type") == "gaussian", x + F.col("ratio") * at("std") * keyed_normal(F.col("_key"), tag("g"), seed))
                .when(F.col("type") == "salt_pepper",
                      F.when(u("sp") < F.col("ratio"), F.when(u("spv") < 0.5, at("min")).otherwise(at("max"))).otherwise(x))
                .when(F.col("type") == "outlier",
                      F.when(u("o") < F.col("ratio"), at("mean") + sign * F.lit(OUTLIER_MAGNITUDE) * at("std")).otherwise(x))
                .otherwise(x))

    rows = rows.select("noise_id", "type", "ratio", "_key", "_label", F.transform("_x", cell).alias("_x"))
    plain = rows.where("type <> 'label'").select("noise_id", "_key", "_label", "_x")
    ranked = class_rank(rows.where("type = 'label'"), "noise_id", "_key", F.concat(F.lit("flip|"), F.col("noise_id").cast("string")), seed, out="_r")
    shift = 1 + F.floor(keyed_uniform(F.col("_key"), F.concat(F.lit("to|"), F.col("noise_id").cast("string")), seed) * (n_classes - 1)).cast("int")
    flipped = F.when(F.col("_r") < F.floor(F.col("ratio") * n), ((F.col("_label") + shift) % n_classes)).otherwise(F.col("_label"))
    labelled = ranked.select("noise_id", "_key", flipped.cast(train.schema[label].dataType).alias("_label"), "_x")
    return tuple(t.select("noise_id", F.col("_key").alias(key), F.col("_label").alias(label),
                          *[F.col("_x")[i].alias(c) for i, c in enumerate(cols)]) for t in (plain, labelled))


def _classes(train: DataFrame, test: DataFrame, label: str) -> int:
    return int(train.select(label).unionByName(test.select(label)).agg(F.max(label)).first()[0]) + 1


def _with_settings(acc: DataFrame, name: str) -> DataFrame:
    """Every setting with its accuracy; null where the model failed on it."""
    return settings(acc.sparkSession).join(acc, "noise_id", "left").select(F.lit(name).alias("model"), *RESULT[1:])


def knn_robustness(train: DataFrame, test: DataFrame, cols: list[str], label: str, key: str, k: int = 5,
                   n_classes: int | None = None, seed: int = SEED) -> DataFrame:
    """A9 (KNN): accuracy on clean test rows after training on each noisy copy →
    (model, noise_id, type, param, label, accuracy)."""
    n_classes = n_classes or _classes(train, test, label)
    plain, labelled = _copies(train, cols, label, key, n_classes, seed)
    plain = hold(plain)
    ids = settings(train.sparkSession).select("noise_id", "type")
    q = test.crossJoin(F.broadcast(ids.where("type <> 'label'").select("noise_id")))
    near = knn_search(q, plain, key, cols, k, by=["noise_id"])
    # copies with flipped labels have the clean copy's features, so its neighbours are theirs
    near = hold(near.select("noise_id", "qid", "did", "dist", "rn"))
    flips = ids.where("type = 'label'").select("noise_id")
    near = near.unionByName(near.where("noise_id = 0").drop("noise_id").crossJoin(F.broadcast(flips)))
    labels = plain.select("noise_id", key, label).unionByName(labelled.select("noise_id", key, label))
    p = knn_classify(labels, q, key, cols, label, k=k, by=["noise_id"], n_classes=n_classes, neighbours=near)
    truth = test.select(F.col(key).alias("row_id"), F.col(label).alias("_y"))
    acc = p.join(truth, "row_id").groupBy("noise_id").agg(
        F.avg(F.when(F.col("predicted") == F.col("_y"), 1.0).otherwise(0.0)).alias("accuracy"))
    return _with_settings(acc, "knn")


def boosted_robustness(name: str, train: DataFrame, test: DataFrame, cols: list[str], label: str, key: str,
                       params: dict | None = None, seed: int = SEED) -> DataFrame:
    """A9 (boosted): the noisy copies are problems of one boosting run."""
    n_classes = _classes(train, test, label)
    noisy = noisy_copies(train, cols, label, key, n_classes, seed)
    ids = [r.noise_id for r in settings(train.sparkSession).collect()]  # fixed presets
    par = ML.boost_params(name, params)
    model = BO.fit(BO.problem_rows(noisy, cols, label, key, F.lit(BO.TRAIN), F.col("noise_id")), {i: par for i in ids}, n_classes)
    rows = test.select(F.col(label).cast("int").alias("y"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x")).crossJoin(
        F.broadcast(settings(train.sparkSession).select(F.col("noise_id").alias("problem"))))
    # a task scores one copy's model, whose trees then meet its rows together
    each = 1 + test.count() // ROWS_PER_SCORE
    place = F.col("problem") * each + F.pmod(F.xxhash64("x"), F.lit(each)).cast("int")
    rows = rows.repartitionById(len(ids) * each, place)
    acc = model.predict(rows.withColumn("noise_id", F.col("problem")), ["y", "noise_id"]).groupBy("noise_id").agg(
        F.avg((F.col("predicted") == F.col("y")).cast("double")).alias("accuracy"))
    return _with_settings(acc, name)


def forest_robustness(train: DataFrame, test: DataFrame, cols: list[str], label: str, key: str, params: dict | None = None,
                      seed: int = SEED) -> DataFrame:
    """A9 (forest): the noisy copies' forests grow in one run; if that fails, one fit per copy tells which ones do."""
    spark = train.sparkSession
    n_classes = _classes(train, test, label)
    ids = [r.noise_id for r in settings(spark).collect()]  # fixed presets
    par = ML.forest_params(params)
    try:
        noisy = noisy_copies(train, cols, label, key, n_classes, seed)
        model = FO.fit(FO.problem_rows(noisy, cols, label, key, F.col("noise_id")), {i: (i, par) for i in ids}, n_classes)
    except Exception:  # noqa: BLE001  one failed setting is a result, and the others stay
        return mllib_robustness("random_forest", train, test, cols, label, key, params, seed)
    rows = test.select(F.col(label).cast("int").alias("y"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x")).crossJoin(
        F.broadcast(settings(spark).select(F.col("noise_id").alias("forest"), "noise_id")))
    acc = model.predict(rows, ["y", "noise_id"]).groupBy("noise_id").agg(F.avg((F.col("predicted") == F.col("y")).cast("double")).alias("accuracy"))
    return _with_settings(acc, "random_forest")


def mllib_robustness(name: str, train: DataFrame, test: DataFrame, cols: list[str], label: str, key: str,
                     params: dict | None = None, seed: int = SEED, threads: int | None = None) -> DataFrame:
    """A9 (MLlib models): one fit per copy; a noisy copy that the model cannot be fitted to gets a null accuracy and a warning,
    the others stay. Without the clean fit there is nothing to compare, so its failure is an error, and so are a failed Spark
    job and a prediction that fails on any copy: they say nothing about the noise.

    The copies share the cores, so each fit has few partitions whatever the rows: every step's tasks answer the driver."""
    spark = train.sparkSession
    n_classes = _classes(train, test, label)
    noisy = hold(noisy_copies(train, cols, label, key, n_classes, seed))
    noisy.count()  # by all tasks, before the fits read it with few
    ids = sorted((r.noise_id for r in settings(spark).collect()), key=lambda i: (i == CLEAN, i))  # fixed presets
    threads = threads or max(1, min(len(ids), spark.sparkContext.defaultParallelism))

    def one(i):
        try:
            fitted = ML.fit_model(name, noisy.where(F.col("noise_id") == i).drop("noise_id"), cols, label, key, params=params, n_classes=n_classes,
                                  fits=threads)
        except NO_FIT as e:
            if i == CLEAN:
                raise
            log.warning("%s has no fit for noise setting %d: %s", name, i, e)
            return i, None
        return i, fitted.predict(test, "test").agg(F.avg((F.col("predicted") == F.col("actual")).cast("double"))).first()[0]

    rows = in_threads(spark, one, ids, threads)
    return _with_settings(spark.createDataFrame(rows, "noise_id int, accuracy double"), name)


def robustness(name: str, train: DataFrame, test: DataFrame, cols: list[str], label: str, key: str,
               params: dict | None = None, seed: int = SEED) -> DataFrame:
    """A9 for any model of the registry."""
    if name == "knn":
        return knn_robustness(train, test, cols, label, key, seed=seed, **({"k": params["n_neighbors"]} if params else {}))
    if name in ML.BOOSTED:
        return boosted_robustness(name, train, test, cols, label, key, params, seed)
    if name == "random_forest":
        return forest_robustness(train, test, cols, label, key, params, seed)
    if name not in ML.MODELS:
        raise ValueError(f"unknown model {name!r}; use one of {ML.MODELS}")
    return mllib_robustness(name, train, test, cols, label, key, params, seed)
