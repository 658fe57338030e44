"""Fitted state that outlives a session (S5, S6): scaler, feature selector and classifiers.

What a fit learned is a table and is written as Parquet; MLlib models use their own writer beside it. Everything that is
saved here loads into an object that transforms as the saved one did.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession

from tabsmith.operators.boosting import Booster
from tabsmith.operators.features import FeatureSelector
from tabsmith.operators.forest import Forests
from tabsmith.operators.models import BOOSTED, Fitted, build
from tabsmith.operators.scale import Scaler
from tabsmith.operators.svm import Machine, feature_map


def _write_facts(spark: SparkSession, path: str, facts: dict) -> None:
    spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")


def _read_facts(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(f"{path}/facts").first().facts)


def save_scaler(scaler: Scaler, spark: SparkSession, path: str) -> None:
    _write_facts(spark, path, {"method": scaler.method, "cols": scaler.cols, "by": scaler.by, "fitted": scaler.stats is not None})
    if scaler.stats is not None:
        scaler.stats.write.mode("overwrite").parquet(f"{path}/stats")


def load_scaler(spark: SparkSession, path: str) -> Scaler:
    f = _read_facts(spark, path)
    return Scaler(f["method"], f["cols"], f["by"], spark.read.parquet(f"{path}/stats") if f["fitted"] else None)


def save_selector(selector: FeatureSelector, spark: SparkSession, path: str) -> None:
    _write_facts(spark, path, {"ratio_spec": selector.ratio_spec, "top_n": selector.top_n, "k_best": selector.k_best,
                               "methods": list(selector.methods), "exclude": list(selector.exclude), "selected": selector.selected})
    if selector.scores is not None:
        selector.scores.write.mode("overwrite").parquet(f"{path}/scores")


def load_selector(spark: SparkSession, path: str) -> FeatureSelector:
    f = _read_facts(spark, path)
    return FeatureSelector([tuple(r) for r in f["ratio_spec"]], f["top_n"], f["k_best"], tuple(f["methods"]), tuple(f["exclude"]), f["selected"])


def save_model(fitted: Fitted, spark: SparkSession, path: str) -> None:
    """A fitted classifier of any kind; KNN's training rows are its model."""
    _write_facts(spark, path, {"name": fitted.name, "cols": fitted.cols, "label": fitted.label, "key": fitted.key, "seconds": fitted.seconds,
                               "params": fitted.params, "n_classes": fitted.n_classes})
    if fitted.name in (*BOOSTED, "random_forest", "svm"):
        fitted.model.save(spark, f"{path}/model")
    elif fitted.name == "knn":
        fitted.model.select(fitted.key, fitted.label, *fitted.cols).write.mode("overwrite").parquet(f"{path}/model")
    else:
        fitted.model.write().overwrite().save(f"{path}/model")


def load_model(spark: SparkSession, path: str) -> Fitted:
    f = _read_facts(spark, path)
    name, spec = f["name"], None
    if name in BOOSTED:
        model = Booster.load(spark, f"{path}/model")
    elif name == "random_forest":
        model = Forests.load(spark, f"{path}/model")
    elif name == "knn":
        model = spark.read.parquet(f"{path}/model")
    elif name == "svm":
        model = Machine.load(spark, f"{path}/model", feature_map(len(f["cols"]), f["params"]))  # its map is fixed by the seed
    else:
        model = LogisticRegressionModel.load(f"{path}/model")
        spec = build(name, len(f["cols"]), 1.0, f["params"], f["n_classes"])
    return Fitted(name, model, f["cols"], f["label"], f["key"], spec, f["seconds"], f["params"], f["n_classes"])


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows, repeats included."""
    return not a.exceptAll(b).limit(1).count() and not b.exceptAll(a).limit(1).count()
